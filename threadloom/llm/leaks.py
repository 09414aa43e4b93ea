"""Evaluation passages inside training documents.

Pigeonhole edit matching. A passage is a stretch of ``least`` letters or digits of a test item that a document
holds with at most ``edits`` edits. Items are cut into pieces so short that any such stretch covers ``edits`` + 1
whole ones, of which one at least is unchanged. Documents are searched for exact pieces with a rolling hash over
the whole batch. Around each hit, every stretch of ``least`` characters of the item that covers the piece is
compared with the document by Myers' bit-parallel distance, many at a time; what is within the budget is a passage.

Documents are scanned once, without a shuffle. Items go to the executors in blocks of ``block`` items; a task holds
one block at a time and takes its documents through all of them.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codepoints import explode, reoffset, rows_of

B1 = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash


@functools.cache
def _bare_table() -> np.ndarray:
    """Code point -> its lower-case form if it is a letter or digit, else 0."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4 or 0x20000 <= c < 0x2FA20:
            out[c] = c
        elif not 0xD800 <= c < 0xE000:
            ch = chr(c)
            if ch.isalnum():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
    return out


def bare(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits only, in lower case; blanks, punctuation and marks fall away."""
    low = _bare_table()[cp]
    keep = low > 0
    return low[keep], reoffset(np.bincount(rows_of(offsets)[keep], minlength=len(offsets) - 1))


def rolling(cp: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` code points starting at each place, by doubling; shorter at the end."""
    h, have, power = cp.astype(np.uint64) + np.uint64(1), 1, B1
    parts = []  # (hash array, length, multiplier to the length)
    with np.errstate(over="ignore"):
        levels = [(h, 1, B1)]
        while have * 2 <= width:
            nxt = h[: max(len(h) - have, 0)] * power + h[have:]
            have, power = have * 2, power * power
            h = nxt
            levels.append((h, have, power))
        out, done = levels[-1][0], levels[-1][1]
        for lv, n, p in reversed(levels[:-1]):
            if done + n <= width:
                m = min(len(out), max(len(lv) - done, 0))
                out = out[:m] * p + lv[done : done + m]
                done += n
    return out


def myers(patterns: np.ndarray, plen: np.ndarray, texts: np.ndarray, tlen: np.ndarray) -> np.ndarray:
    """Smallest edit distance of each pattern (up to 64 code points) to any stretch of its text.

    Rows are padded with 0. All rows advance together: one step per text column, a few word operations each.
    """
    n, T = texts.shape
    one = np.uint64(1)
    full = np.where(plen >= 64, ~np.uint64(0), (one << plen.astype(np.uint64)) - one)
    top = one << (np.maximum(plen, 1) - 1).astype(np.uint64)
    bit = one << np.arange(patterns.shape[1], dtype=np.uint64)
    pv, mv = full.copy(), np.zeros(n, np.uint64)
    score, best = plen.astype(np.int64).copy(), plen.astype(np.int64).copy()
    with np.errstate(over="ignore"):
        for t in range(T):
            c = texts[:, t]
            eq = ((patterns == c[:, None]) * bit).sum(1, dtype=np.uint64) & full
            eq = np.where(c == 0, np.uint64(0), eq)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv)
            mh = pv & xh
            score += (ph & top > 0).astype(np.int64) - (mh & top > 0)
            ph, mh = ph << one, mh << one  # the text may start anywhere: no carry into the first row
            pv = (mh | ~(xv | ph)) & full
            mv = ph & xv & full
            live = t < tlen
            best = np.where(live, np.minimum(best, score), best)
    return best


def _windows(flat: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    w = int(n.max()) if len(n) else 0
    at = lo[:, None] + np.arange(w)
    return np.where(np.arange(w) < n[:, None], flat[np.minimum(at, len(flat) - 1)], 0).astype(np.uint32)


class Index:
    """Pieces of one block of items."""

    def __init__(self, ids: list, texts: list, least: int, edits: int):
        cp, off, _ = explode(pa.array(texts, pa.string()))
        self.cp, self.off = bare(cp, off)
        self.ids, self.least, self.edits = ids, least, edits
        self.piece = piece = piece_length(least, edits)
        size = np.diff(self.off)
        n = np.where(size >= least, size // piece, 0)
        self.owner = np.repeat(np.arange(len(ids)), n)
        self.start = self.off[self.owner] + (np.arange(len(self.owner)) - np.repeat(np.cumsum(n) - n, n)) * piece
        h = rolling(self.cp, piece)
        key = h[self.start] if len(self.start) else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.key, self.owner, self.start = key[order], self.owner[order], self.start[order]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.key >> np.uint64(44)).astype(np.int64)] = True


def piece_length(least: int, edits: int) -> int:
    """The longest pieces of which every stretch of ``least`` characters covers ``edits`` + 1."""
    return (least + 1) // (edits + 2)


def _piece_hits(ix: Index, cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(row, item, place in the documents, place in the items)`` of every exact piece."""
    q = ix.piece
    h = rolling(cp, q)
    at = np.flatnonzero(ix.sieve[(h >> np.uint64(44)).astype(np.int64)])
    row = np.searchsorted(off, at, "right") - 1
    at, row = at[at + q <= off[row + 1]], row[at + q <= off[row + 1]]
    left, right = np.searchsorted(ix.key, h[at], "left"), np.searchsorted(ix.key, h[at], "right")
    n = right - left
    which = np.repeat(left, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    at, row, start = np.repeat(at, n), np.repeat(row, n), ix.start[which]
    same = np.ones(len(at), bool)  # equal hashes are compared, character by character
    for k in range(q):
        same &= cp[at + k] == ix.cp[start + k]
    return row[same], ix.owner[which][same], at[same], start[same]


def _runs(ix: Index, cp: np.ndarray, off: np.ndarray, row, own, at, start) -> tuple[np.ndarray, np.ndarray]:
    """How far item and document agree without a break before and after the beginning of each piece."""
    out = []
    for step, k in ((-1, -1), (1, ix.piece)):
        reach = np.zeros(len(row), np.int64) if step < 0 else np.full(len(row), ix.piece)
        live = np.arange(len(row))
        while len(live):
            x, y = at[live] + k, start[live] + k
            inside = (x >= off[row[live]]) & (x < off[row[live] + 1]) & (y >= ix.off[own[live]]) & (y < ix.off[own[live] + 1])
            live, x, y = live[inside], x[inside], y[inside]
            live = live[cp[x] == ix.cp[y]]
            reach[live] += 1
            k += step
        out.append(reach)
    return tuple(out)


def _distances(ix: Index, cp: np.ndarray, off: np.ndarray, row, at, s, chunk: int = 50_000) -> np.ndarray:
    """Edits between the stretches of the item at ``s`` and the documents around ``at``, where they would stand."""
    m, e = ix.least, ix.edits
    out = np.zeros(len(s), np.int64)
    for a in range(0, len(s), chunk):
        ss, pp, r = s[a : a + chunk], at[a : a + chunk], row[a : a + chunk]
        lo, hi = np.maximum(pp - e, off[r]), np.minimum(pp + m + e, off[r + 1])
        out[a : a + chunk] = myers(_windows(ix.cp, ss, ss + m), np.full(len(ss), m), _windows(cp, lo, hi), hi - lo)
    return out


def _promising(ix: Index, cp: np.ndarray, off: np.ndarray, row, own, at, start, chunk: int = 20_000) -> np.ndarray:
    """Which of the stretches that cover each piece, by where they begin, may be within the budget: of a stretch with
    ``edits`` edits, all but as many characters stand in the document at most that far from their place."""
    q, m, e = ix.piece, ix.least, ix.edits
    around = np.arange(q - m, m)
    out = np.zeros((len(row), m - q + 1), bool)
    for a in range(0, len(row), chunk):
        r, o, p, i = (x[a : a + chunk] for x in (row, own, at, start))
        y = i[:, None] + around
        there = (y >= ix.off[o][:, None]) & (y < ix.off[o + 1][:, None])
        want = ix.cp[np.clip(y, 0, len(ix.cp) - 1)]
        met = np.zeros(y.shape, bool)
        for d in range(-e, e + 1):
            x = p[:, None] + around + d
            met |= (x >= off[r][:, None]) & (x < off[r + 1][:, None]) & (cp[np.clip(x, 0, len(cp) - 1)] == want)
        n = np.zeros((len(r), 2, len(around) + 1), np.int16)
        np.cumsum(met & there, axis=1, out=n[:, 0, 1:])
        np.cumsum(there, axis=1, out=n[:, 1, 1:])
        within = n[:, :, m:] - n[:, :, :-m]
        out[a : a + chunk] = (within[:, 1] == m) & (within[:, 0] >= m - e)
    return out


def hits(ix: Index, cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(row, item, distance, run, pieces)``, one entry per document and item that share a passage.

    Of each pair, the stretch that the longest unbroken run covers best is measured first. Where that is no exact
    copy, all stretches that cover any of the pair's pieces are.
    """
    q, m, e, w = ix.piece, ix.least, ix.edits, max(len(ix.ids), 1)
    row, own, at, start = _piece_hits(ix, cp, off)
    z = np.zeros(0, np.int64)
    if not len(row):
        return z, z, z, z, z
    before, after = _runs(ix, cp, off, row, own, at, start)
    run = before + after
    pair = row * w + own
    order = np.lexsort((-run, pair))
    pair, row, own, at, start, before, run = (x[order] for x in (pair, row, own, at, start, before, run))
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    pieces = np.diff(np.r_[first, len(pair)])
    s = np.minimum(np.maximum(start[first] - before[first], ix.off[own[first]]), ix.off[own[first] + 1] - m)
    best = _distances(ix, cp, off, row[first], at[first] + s - start[first], s)
    rest = np.flatnonzero(best > 0)
    if len(rest):
        of_pair = np.repeat(np.arange(len(first)), pieces)
        some = np.flatnonzero((best > 0)[of_pair])
        hit, place = np.nonzero(_promising(ix, cp, off, row[some], own[some], at[some], start[some]))
        k = some[hit]
        s = start[k] + q - m + place
        span = len(ix.cp) + 1  # pieces on one diagonal share stretches
        _, once = np.unique((at[k] - start[k] + span) * span + s, return_index=True)
        k, s = k[once], s[once]
        np.minimum.at(best, of_pair[k], _distances(ix, cp, off, row[k], at[k] + s - start[k], s))
    ok = best <= e
    first = first[ok]
    return row[first], own[first], best[ok], run[first], pieces[ok]


def _chunks(batches, most: int):
    """Batches together, up to about ``most`` bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()


def find(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, least: int = 40, edits: int = 2, block: int = 20_000) -> DataFrame:
    """``(key, item, distance, run, pieces)``: documents that hold a passage of ``least`` consecutive letters or
    digits of an item with at most ``edits`` edits; ``distance`` is the least number of edits of such a passage (0
    for one that stands there as it is), ``run`` the longest unbroken stretch around one of the exact ``pieces``.

    Case, blanks and punctuation are ignored. ``least`` is at most 64, a machine word. Null and empty texts leak
    nothing and give nothing away, as do items shorter than ``least``; repeated documents each count; an empty
    table gives no rows.
    """
    if not (0 <= edits and 2 <= piece_length(least, edits) and least <= 64):
        raise ValueError("least must be at most 64, and pieces of (least + 1) // (edits + 2) at least 2 characters")
    spark = docs.sparkSession
    kind, item_kind = dict(docs.dtypes)[key], dict(items.dtypes)[item_key]
    schema = f"key {kind}, item {item_kind}, distance long, run long, pieces long"
    it = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    blocks = max(1, -(-it.count() // block))
    shared = []
    for b in range(blocks):  # one block at a time on the driver
        part = it.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).collect()
        shared.append(spark.sparkContext.broadcast(Index([r.i for r in part], [r.t for r in part], least, edits)))

    def run(batches):
        for chunk in _chunks(batches, 64 << 20) if len(shared) > 1 else ([b] for b in batches):
            for s in shared:
                ix = s.value if len(shared) == 1 else s.load_from_path(s._path)  # read anew: one block is held at a time
                ids = pa.array(ix.ids)
                for rb in chunk if len(ix.ids) else ():
                    cp, off, _ = explode(rb.column(1))
                    r, own, dist, length, n = hits(ix, *bare(cp, off))
                    columns = [rb.column(0).take(pa.array(r)), ids.take(pa.array(own)), pa.array(dist), pa.array(length), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "item", "distance", "run", "pieces"])

    return docs.select(F.col(key), F.col(text)).where(F.col(text).isNotNull()).mapInArrow(run, schema)
