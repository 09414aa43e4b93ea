"""Same or near-same records across splits.

Texts are compared without their leading tag, case and blanks. Rows with the same text form a class, and
only classes are joined. The join is exact: what it drops cannot be within ``max_edit``.

* A right text of L characters has, to any partner, at most k edits, where k follows from ``max_edit`` and the
  longest partner L allows. It is listed under k + 1 disjoint grams of L // (k + 1) characters (5 at 15 %), of
  which one at least is untouched. Which grams, decides a table of least cost: those the left side has least.
* A left text is listed under all its grams. Both lists are keyed by gram and bucket of places, and a key's left texts
  are sorted by place: of those, a right text meets only the ones at the few places that the next rule leaves.
* Of two texts with e edits, the first gram, counted j from 0, that has at most j edits up to its end is
  untouched and has exactly j edits before it: the places differ by at most j, and counted from the ends of the
  texts by at most e - j. Meetings that break this, or the lengths, are dropped.
* A text's signature has a bit for each hash of (character, how often it came before), added modulo 2: an edit
  changes two bits at most.
* An edit takes at most two pairs of neighbouring characters from a text: of n characters, n - 1 - 2e are common.
* The edit distance decides.

Grams of the left side are counted in a table of fixed size, so that what executors get does not grow with the data.
A gram that more than ``HOT`` left texts may have is cut into parts: a left text goes to one of them, a right text
to all, so boilerplate that many texts share is no single key of the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codepoints import explode
from ..session import Stage, wide
from ..operators.counting import slot_counts
from .leaks import rolling

TAG = r"(?U)^\s*\[\d+(?:-\d+)*\]"
MOST = 8
BUCKET, WIDE = 64, 256
SLOTS = 1 << 22
HOT = 5_000
MIX = np.uint64(0xFF51AFD7ED558CCD)


def untagged(text: Column) -> Column:
    """The text without one leading bracketed reply number and without outer blanks."""
    return F.regexp_replace(F.regexp_replace(text, TAG, ""), r"(?U)^\s+|\s+$", "")


def squeezed(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"(?U)\s+", ""))


def _hashes(cp: np.ndarray, n: int, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (rolling(cp, n) + np.uint64(kind)) * MIX
        h = (h ^ (h >> np.uint64(33))) * MIX
    return h ^ (h >> np.uint64(29))


def _key(h: np.ndarray, bucket: np.ndarray, part: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (bucket.astype(np.uint64) + np.uint64(1)) ^ (part.astype(np.uint64) << np.uint64(40))) * MIX
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def _parts(h: np.ndarray, counts: np.ndarray, hot: int) -> np.ndarray:
    return (counts[(h & np.uint64(SLOTS - 1)).astype(np.int64)] // hot + 1).astype(np.int64)


def _times(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place ``n`` times, and which time it is."""
    at = np.repeat(np.arange(len(n)), n)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)


class Plan:
    """By length up to ``top``: the most edits to any partner, the kind of listing (gram and bucket length), and
    the shortest and longest partner."""

    def __init__(self, top: int, share: float):
        if not 0 <= share <= 0.4:
            raise ValueError("the share of edits is from 0 to 0.4")
        far = int(top / (1 - share)) + 3
        size = np.arange(far + 1)
        more = np.arange(int(far / (1 - share)) + 3)
        spare = more - np.floor(share * more + 1e-9).astype(np.int64)
        self.high = np.searchsorted(spare, size, "right") - 1
        self.low = spare[: far + 1]
        self.edits = np.floor(share * self.high + 1e-9).astype(np.int64)
        self.gram = np.minimum(size // (self.edits + 1), MOST)
        self.bucket = BUCKET << np.maximum(np.floor(np.log2(np.maximum(size, 1) / WIDE)).astype(np.int64) + 1, 0)
        self.kind = np.where(self.edits > 0, self.bucket * 16 + self.gram, 0)  # without edits only equal texts match

    def kinds_met(self, size: np.ndarray):
        """(kind, whether a text of each of these lengths has partners of that kind)"""
        for kind in np.unique(self.kind[self.kind > 0]):
            seen = np.r_[0, np.cumsum(self.kind == kind)]
            yield int(kind), seen[np.minimum(self.high[size], len(self.kind) - 1) + 1] > seen[self.low[size]]


def all_grams(cp: np.ndarray, off: np.ndarray, share: float):
    """``(row, place, hash, bucket length)`` of every gram a partner may be listed under."""
    size = np.diff(off)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for kind, met in Plan(int(size.max(initial=0)), share).kinds_met(size):
        n = kind % 16
        if not met.any() or len(cp) < n:
            continue
        h = _hashes(cp, n, kind)
        at = np.arange(len(h))
        row = np.searchsorted(off, at, "right") - 1
        ok = (at + n <= off[row + 1]) & met[row]
        out.append((row[ok], at[ok] - off[row[ok]], h[ok], np.full(int(ok.sum()), kind // 16)))
    return tuple(np.concatenate(x) for x in zip(*out))


def cheapest(cost: np.ndarray, n: int, pieces: int) -> np.ndarray:
    """Places of ``pieces`` disjoint grams of ``n`` characters per row of ``cost`` (by place), of least total cost;
    for very long texts of least cost in each of as many equal parts."""
    rows, m = cost.shape
    size = m + n - 1
    out = np.zeros((rows, pieces), np.int64)
    if pieces * size > 1 << 17:
        cut = np.arange(pieces + 1) * size // pieces
        for j in range(pieces):
            out[:, j] = cut[j] + cost[:, cut[j] : cut[j + 1] - n + 1].argmin(axis=1)
        return out
    step = max(1, (1 << 21) // (pieces * size))
    ends = np.arange(size + 1, dtype=np.int32)
    for lo in range(0, rows, step):
        c = cost[lo : lo + step]
        best, back = np.zeros((len(c), size + 1)), []
        for j in range(pieces):
            v = np.full(best.shape, np.inf)
            v[:, n:] = best[:, :m] + c * (2 * min(j, pieces - 1 - j) + 1)  # so many places meet it
            best = np.minimum.accumulate(v, axis=1)
            back.append(np.maximum.accumulate(np.where(v == best, ends, 0), axis=1))
        x = np.full(len(c), size)
        for j in range(pieces - 1, -1, -1):
            x = back[j][np.arange(len(c)), x] - n
            out[lo : lo + step, j] = x
    return out


def picked_grams(cp: np.ndarray, off: np.ndarray, share: float, counts: np.ndarray):
    """``(row, place, order, hash, bucket length)`` of the grams that each text is listed under."""
    size = np.diff(off)
    plan = Plan(int(size.max(initial=0)), share)
    out = [(*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    hashes: dict[int, np.ndarray] = {}
    for length in np.unique(size[plan.kind[size] > 0]):
        kind, pieces = int(plan.kind[length]), int(plan.edits[length]) + 1
        n = kind % 16
        if kind not in hashes:
            hashes[kind] = _hashes(cp, n, kind)
        rows = np.flatnonzero(size == length)
        h = hashes[kind][off[rows][:, None] + np.arange(length - n + 1)]
        seen = counts[(h & np.uint64(SLOTS - 1)).astype(np.int64)]
        at = cheapest(seen + 0.01, n, pieces)
        r, j = np.repeat(np.arange(len(rows)), pieces), np.tile(np.arange(pieces), len(rows))
        at = at.reshape(-1)
        ok = seen[r, at] > 0  # a gram no left text has meets nothing
        r, j, at = r[ok], j[ok], at[ok]
        out.append((rows[r], at, j, h[r, at], np.full(len(r), kind // 16)))
    return tuple(np.concatenate(x) for x in zip(*out))


def signatures(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """256 bits per text, as four longs."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    key = (row.astype(np.uint64) << np.uint64(32)) | cp.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    before = np.arange(len(key)) - np.searchsorted(key, key, "left")
    with np.errstate(over="ignore"):
        h = ((key & np.uint64(0xFFFFFFFF)) * np.uint64(1 << 24) + before.astype(np.uint64)) * MIX
        h = (h ^ (h >> np.uint64(33))) * MIX
    bits = np.bincount(row * 256 + (h >> np.uint64(56)).astype(np.int64), minlength=n * 256) & 1
    return np.packbits(bits.reshape(n, 256).astype(np.uint8), axis=1).view(np.int64)


def _met(held: list[np.ndarray], share: float, step: int):
    """``(lcid, rcid)`` of the listed grams ``held (term, nth, len, at, cid, s0..s3)``, by term, the left side first."""
    term, nth, size, at, cid, *sig = held
    t = np.cumsum(np.r_[False, term[1:] != term[:-1]])
    left, right = np.flatnonzero(nth < 0), np.flatnonzero(nth >= 0)
    if not len(left) or not len(right):
        return
    most = np.floor(share / (1 - share) * size[right] + 1e-6).astype(np.int64)  # of edits to the longest partner
    reach = np.stack([nth[right], most - nth[right]])  # how far places differ, from the start and from the end
    base = 4 * (int(size.max()) + 1)
    place = np.stack([at, size - at]).astype(np.int64)
    nearer = np.argmin(reach, axis=0)
    for way in (0, 1):
        some = (nearer == way) & (reach[1] >= 0)
        mine, far, other = right[some], reach[way][some], reach[1 - way][some]
        code = t[left] * base + place[way][left]
        order = left[np.argsort(code, kind="stable")]
        code = np.sort(code)
        mid = t[mine] * base + place[way][mine]
        lo = np.searchsorted(code, np.maximum(mid - far, t[mine] * base))
        many = np.searchsorted(code, mid + far, "right") - lo
        ends = np.cumsum(many)
        i = 0
        while i < len(mine):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + step, "right")))
            n = many[i:j]
            y = np.repeat(mine[i:j], n)
            x = order[np.repeat(lo[i:j] - np.cumsum(n) + n, n) + np.arange(len(y))]
            off = size[x] - size[y]
            ok = np.abs(place[1 - way][x] - place[1 - way][y]) <= np.repeat(other[i:j], n)
            x, y, off = x[ok], y[ok], off[ok]
            most_xy = np.floor(share * np.maximum(size[x], size[y]) + 1e-9).astype(np.int64)
            by = at[x] - at[y]
            ok = (np.abs(off) <= most_xy) & (np.abs(by) <= nth[y]) & (np.abs(by - off) <= most_xy - nth[y]) & (cid[x] != cid[y])
            x, y, most_xy = x[ok], y[ok], most_xy[ok]
            bits = np.zeros(len(x), np.int64)
            for v in sig:
                bits += np.bitwise_count((v[x] ^ v[y]).view(np.uint64))
            ok = bits <= 2 * most_xy
            yield cid[x[ok]], cid[y[ok]]
            i = j


def meetings(batches, share: float, rows: int = 200_000, step: int = 1 << 20):
    """Pairs ``(lcid, rcid)`` that may be within ``share``, from listed grams sorted by term, the left side first.
    About ``rows`` of them are held at once, and the left side of the last term, which may go on."""
    names = ["term", "nth", "len", "at", "cid", *[f"s{i}" for i in range(4)]]
    kept = None

    def flush(parts: list[pa.RecordBatch]):
        held = [np.concatenate([b.column(k).to_numpy() for b in parts]) for k in names]
        if kept is not None:
            held = [np.concatenate(x) for x in zip(kept, held)]
        for a, b in _met(held, share, step):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["lcid", "rcid"])
        last = (held[0] == held[0][-1]) & (held[1] < 0)
        return [x[last] for x in held]

    parts, n = [], 0
    for b in batches:
        parts.append(b)
        n += b.num_rows
        if n >= rows:
            kept = yield from flush(parts)
            parts, n = [], 0
    if n:
        yield from flush(parts)


def alike(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], share: float, bins: int = 1024) -> np.ndarray:
    """Whether two texts, each of ``a`` and ``b`` code points and offsets, may be within ``share``: by their common
    pairs of neighbouring characters, counted in ``bins`` (collisions only add common ones)."""
    n = len(a[1]) - 1
    counts = []
    for cp, off in (a, b):
        row = np.repeat(np.arange(n), np.diff(off))
        both = row[1:] == row[:-1]
        with np.errstate(over="ignore"):
            h = ((cp[:-1].astype(np.uint64) << np.uint64(32)) | cp[1:].astype(np.uint64)) * MIX
            h = (h ^ (h >> np.uint64(33))) * MIX
        slot = (h[both] >> np.uint64(32)).astype(np.int64) % bins
        counts.append(np.bincount(row[1:][both] * bins + slot, minlength=n * bins).reshape(n, bins))
    size = np.maximum(np.diff(a[1]), np.diff(b[1]))
    return np.minimum(*counts).sum(axis=1) >= size - 1 - 2 * np.floor(share * size + 1e-9)


def edit_within(a: list[str], b: list[str], share: float) -> np.ndarray:
    """Whether the edit distance is at most ``share`` of the longer text; a banded table, all pairs at once."""
    out = np.zeros(len(a), bool)
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    budget = np.floor(share * np.maximum(la, lb) + 1e-9).astype(np.int64)
    todo = np.flatnonzero(np.abs(la - lb) <= budget)
    todo = todo[np.argsort(np.maximum(la, lb)[todo], kind="stable")]
    for lo in range(0, len(todo), 256):
        ix = todo[lo : lo + 256]
        k = int(budget[ix].max())
        A = [np.frombuffer(a[i].encode("utf-32-le", "surrogatepass"), np.uint32) for i in ix]
        B = [np.frombuffer(b[i].encode("utf-32-le", "surrogatepass"), np.uint32) for i in ix]
        m, n = int(la[ix].max()), int(lb[ix].max())
        P = np.zeros((len(ix), m), np.uint32)
        Q = np.full((len(ix), n + 2 * k + m + 2), 0xFFFFFFFF, np.uint32)
        for j, (x, y) in enumerate(zip(A, B)):
            P[j, : len(x)] = x
            Q[j, k : k + len(y)] = y
        width = 2 * k + 1
        d = np.arange(width) - k  # column minus row
        big = 1 << 20
        cur = np.where(d >= 0, d, big)[None, :].repeat(len(ix), 0).astype(np.int64)
        ramp = np.arange(width)
        final = np.full(len(ix), big, np.int64)
        rows = np.arange(len(ix))

        def settle(i: int) -> None:
            done = la[ix] == i
            pos = lb[ix] - i + k
            ok = done & (pos >= 0) & (pos < width)
            final[ok] = cur[rows[ok], pos[ok]]

        settle(0)
        for i in range(1, m + 1):
            same = Q[:, i - 1 : i - 1 + width] == P[:, i - 1 : i]  # column j = i + d holds Q's character j - 1
            nxt = cur + ~same
            nxt[:, :-1] = np.minimum(nxt[:, :-1], cur[:, 1:] + 1)
            col = i + d
            nxt[:, col < 0] = big
            if 0 <= k - i < width:
                nxt[:, k - i] = i
            nxt = np.minimum.accumulate(nxt - ramp, axis=1) + ramp
            cur = nxt
            settle(i)
        out[ix] = final <= budget[ix]
    return out


def links(df: DataFrame, key: str, text: str, split: str, left: str = "eval", right: str = "train", least: int = 80, max_edit: float = 0.15, hot: int = HOT):
    """``(rows, pairs)``: ``rows (row, split, cid)`` and ``pairs (lcid, rcid)`` of linked classes.

    ``lcid`` is a class with rows in split ``left``, ``rcid`` one with rows in ``right``; a class with rows in both
    is paired with itself. Null texts, keys or splits and texts below ``least`` characters are left out; rows
    that repeat a key count as they stand. Empty input gives empty tables.
    """
    spark = df.sparkSession
    st = Stage(spark, "overlap")
    rows = df.select(F.col(key).alias("row"), F.col(split).alias("split"), untagged(F.col(text)).alias("plain"))
    rows = rows.where("row is not null").where(F.col("split").isin(left, right)).where(F.length("plain") >= least)
    rows = rows.select("row", "split", squeezed(F.col("plain")).alias("body"))
    texts = rows.groupBy("body").agg(F.max(F.col("split") == left).alias("l"), F.max(F.col("split") == right).alias("r"))
    texts = st.cut(texts.withColumn("cid", F.monotonically_increasing_id()))
    rows = st.cut(rows.join(texts.select("body", "cid"), "body").select("row", "split", "cid"))

    # the counter table of the left side: SLOTS counters, whatever the input
    def count(b: pa.RecordBatch, acc: np.ndarray) -> None:
        cp, off, _ = explode(b.column(0))
        np.add.at(acc, (all_grams(cp, off, max_edit)[2] & np.uint64(SLOTS - 1)).astype(np.int64), 1)

    counts = slot_counts(texts.where("l").select("body"), SLOTS, count)
    shared = spark.sparkContext.broadcast(np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))

    def listed(side: str):
        def run(batches):
            for whole in batches:
                for lo in range(0, whole.num_rows, 2000):
                    b = whole.slice(lo, 2000)
                    cp, off, _ = explode(b.column(1))
                    if side == "l":
                        row, at, h, wide = all_grams(cp, off, max_edit)
                        spread = b.column(0).to_numpy()[row].view(np.uint64) * MIX >> np.uint64(33)
                        order, key = np.full(len(row), -1), _key(h, at // wide, spread.astype(np.int64) % _parts(h, shared.value, hot))
                    else:
                        row, at, order, h, wide = picked_grams(cp, off, max_edit, shared.value)
                        first = np.maximum(at - order, 0) // wide
                        parts = _parts(h, shared.value, hot)
                        x, nth = _times(((at + order) // wide - first + 1) * parts)
                        row, at, order, key = row[x], at[x], order[x], _key(h[x], first[x] + nth // parts[x], nth % parts[x])
                    sig = signatures(cp, off)[row]
                    ints = [order, np.diff(off)[row], at]
                    yield pa.RecordBatch.from_arrays([pa.array(key), *[pa.array(x.astype(np.int32)) for x in ints], b.column(0).take(pa.array(row)), *[pa.array(np.ascontiguousarray(sig[:, i])) for i in range(4)]], names=names)

        # nth is -1 for the left side
        fields = ["term long", "nth int", "len int", "at int", "cid long", *[f"s{i} long" for i in range(4)]]
        names = [f.split()[0] for f in fields]
        return texts.where(side).select("cid", "body").mapInArrow(run, ", ".join(fields))

    # partitions of about two million listed grams, where that is more than the session's
    both = listed("l").unionByName(listed("r"))
    keyed = wide(both, int(counts.sum()), "term")
    keyed = both.repartition("term") if keyed is both else keyed
    met = keyed.sortWithinPartitions("term", "nth").mapInArrow(lambda batches: meetings(batches, max_edit), "lcid long, rcid long")
    cand = st.cut(met.distinct())
    cand = cand.join(texts.select(F.col("cid").alias("lcid"), F.col("body").alias("a")), "lcid").join(texts.select(F.col("cid").alias("rcid"), F.col("body").alias("b")), "rcid")

    def verify(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                rb = whole.slice(lo, 1000)
                rb = rb.filter(pa.array(alike(explode(rb.column(2))[:2], explode(rb.column(3))[:2], max_edit)))
                at = pa.array(np.flatnonzero(edit_within(rb.column(2).to_pylist(), rb.column(3).to_pylist(), max_edit)))
                yield pa.RecordBatch.from_arrays([rb.column(0).take(at), rb.column(1).take(at)], names=["lcid", "rcid"])

    near = cand.select("lcid", "rcid", "a", "b").mapInArrow(verify, "lcid long, rcid long")
    same = texts.where("l and r").select(F.col("cid").alias("lcid"), F.col("cid").alias("rcid"))
    return rows, st.cut(near.unionByName(same))


def row_pairs(df: DataFrame, key: str, text: str, split: str, left: str = "eval", right: str = "train", **how) -> DataFrame:
    """``(row_a, row_b)``, row_a < row_b: every pair of one row of each split whose texts are linked."""
    rows, pairs = links(df, key, text, split, left, right, **how)
    a = rows.where(F.col("split") == left).select(F.col("cid").alias("lcid"), F.col("row").alias("x"))
    b = rows.where(F.col("split") == right).select(F.col("cid").alias("rcid"), F.col("row").alias("y"))
    out = pairs.join(a, "lcid").join(b, "rcid").where("x <> y")
    return out.select(F.least("x", "y").alias("row_a"), F.greatest("x", "y").alias("row_b")).distinct()
