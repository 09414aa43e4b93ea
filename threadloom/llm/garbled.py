"""Text decoded with the wrong character encoding, found by a hidden Markov model and decoded back.

States: one clean state, and one for each pair (encoding the bytes were written in, encoding they were
read in). A path may step from the clean state into a pair's state and back, at a price; the score of a
character in a pair's state, relative to the clean state, is

* for pairs read in a one-byte encoding: what the bytes around it spell. A complete sequence of the encoding
  it was written in scores the likelihood of the character it spells against that of the characters seen;
  other non-ASCII characters are nearly impossible there. One sequence of two bytes is never enough, so
  curly quotes, dashes and accents of genuine text, which are such bytes too, are no case by themselves;
* for the other pairs: the log ratio of its share in simulated garbling to its share in clean text. A lone
  replacement character decides nothing.

Character shares are counted over all documents, and the simulation garbles all of them, each line by itself.
Every labelled span is put through the inverse of its state, again and again while the result is labelled, which
undoes double encoding.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codepoints import explode

BMP = 0x10000
CLEAN = 0
# name, written in, read in. "sb" marks pairs read in a one-byte encoding.
PAIRS = [
    ("utf-8>cp1252", "utf-8", "cp1252"),
    ("utf-8>mac_roman", "utf-8", "mac_roman"),
    ("cp949>cp1252", "cp949", "cp1252"),
    ("shift_jis>cp1252", "shift_jis", "cp1252"),
    ("utf-8>cp949", "utf-8", "cp949"),
    ("utf-8>shift_jis", "utf-8", "cp932"),
    ("cp949>utf-8", "cp949", "utf-8"),
]
STRUCT = 4  # the first four are judged by the sequences they spell
PRICE = np.array([9.0, 9.0, 18.0, 18.0, 18.0, 18.0, 18.0])  # of entering, leaving is free
ASCII_LETTER = np.array([0.02, 0.02, 0.4, 0.2, 0.4, 0.2, 0.4])
ASCII_OTHER = np.array([0.02, 0.02, 0.02, 0.05, 0.02, 0.05, 0.02])
IMPOSSIBLE = -12.0
LOST = 8.0  # score of U+FFFD: below the price of any state, so three of them nearby are needed
MOST_OF_PAIR = 14.0  # likewise of a sequence of two bytes
# Characters genuine text may have at any time, however rare in the corpus, with the least log share
# they are taken to have: signs of typography, European letters, ASCII.
AT_LEAST = [(-11.5, [*range(0xA0, 0x180)]), (-10.0, [*range(0x2013, 0x2015), *range(0x2018, 0x201F), 0x2020, 0x2022, 0x2026, 0x20AC, 0x2122]), (-8.0, [*range(0x20, 0x7F)])]
UNSEEN, PLAIN = -24.0, -16.0  # log shares of any other character no document has: where it is spelled, where it stands


@functools.cache
def byte_of(encoding: str) -> np.ndarray:
    """Code point (BMP) -> the byte it is read from in a one-byte encoding, or -1; bytes without a
    character in cp1252 are read as the control code of the same number, as most decoders do."""
    out = np.full(BMP, -1, np.int16)
    if encoding == "cp1252":
        out[0x80:0xA0] = np.arange(0x80, 0xA0)
    for b in range(256):
        try:
            out[ord(bytes([b]).decode(encoding))] = b
        except UnicodeDecodeError:
            pass
    return out


def read_as(raw: bytes, encoding: str) -> str:
    if encoding == "cp1252":
        return "".join(_CP1252[b] for b in raw)
    return raw.decode(encoding, "replace")


_CP1252 = []
for _b in range(256):
    try:
        _CP1252.append(bytes([_b]).decode("cp1252"))
    except UnicodeDecodeError:
        _CP1252.append(chr(_b))


@dataclass
class Model:
    logp: np.ndarray  # log share of each BMP code point in clean text
    plain: np.ndarray  # the same, at least PLAIN
    ratio: np.ndarray  # (len(PAIRS), BMP) log ratios of the table states
    unsafe: np.ndarray  # code points that call for a closer look


@functools.cache
def _writable(encoding: str) -> np.ndarray:
    """Whether a code point (BMP) can be written in an encoding."""
    return np.array([not 0xD800 <= k < 0xE000 and bool(chr(k).encode(encoding, "ignore")) for k in range(BMP)] + [False])


def simulated(texts: list[str]) -> dict[int, np.ndarray]:
    """By table state: how often each code point comes where the texts' lines are garbled on purpose. Lines that hold
    U+FFFD, no character above ASCII, or more than 2 % that cannot be written in the pair's encoding are left out."""
    cp = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = np.minimum(cp, 0x10FFFF)
    line = np.cumsum(cp == 10)
    many = int(line[-1]) + 1 if len(line) else 0
    size = np.bincount(line[cp != 10], minlength=many)
    whole = np.bincount(line[cp == 0xFFFD], minlength=many) == 0
    out = {}
    for s, (_, wrote, read) in enumerate(PAIRS[STRUCT:], STRUCT):
        ok = _writable(wrote)[np.minimum(cp, BMP)] if wrote != "utf-8" else (cp < 0xD800) | (cp >= 0xE000)
        use = whole & (np.bincount(line[ok & (cp >= 0x80)], minlength=many) > 0)
        if wrote != "utf-8":
            use &= np.bincount(line[~ok], minlength=many) <= 0.02 * size
        raw = cp[ok & use[line]].tobytes().decode("utf-32-le").encode(wrote)  # line breaks end every broken sequence
        got = np.frombuffer(read_as(raw, read).encode("utf-32-le"), np.uint32)
        out[s] = np.bincount(got, minlength=0x110000)
    return out


def fit(counts: dict[int, int], texts: list[str]) -> Model:
    """``counts``: code points over all documents; ``texts``: what is garbled on purpose."""
    return _fitted(counts, {s: dict(enumerate(n.tolist())) for s, n in simulated(texts).items()})


def _fitted(counts: dict[int, int], garbled: dict[int, dict[int, int]]) -> Model:
    """``counts``: code points over all documents; ``garbled``: by table state, those of the documents garbled on purpose."""
    c = np.full(BMP + 1, 0.05)
    for k, v in counts.items():
        c[min(k, BMP)] += v
    logp = np.log(c / c.sum())[:BMP]
    logp[c[:BMP] < 1] = UNSEEN
    for least, some in AT_LEAST:
        logp[some] = np.maximum(logp[some], least)
    never = [0xFFFD, *range(0x80, 0xA0)]  # no decoder of the right encoding gives these
    logp[never] = -26.0
    ratio = np.full((len(PAIRS), BMP), -8.0, np.float32)
    for s in range(STRUCT, len(PAIRS)):
        seen = {k: v for k, v in garbled.get(s, {}).items() if k >= 0x80}
        tot = sum(seen.values()) or 1
        for k, v in seen.items():
            if k < BMP and v > 1:
                ratio[s, k] = np.log(v / tot) - logp[k]
        ratio[s] = np.clip(ratio[s], -8, 8)
        ratio[s, never] = np.where(ratio[s, never] > 0, 22.0, ratio[s, never])
    ratio[:, 0xFFFD] = np.where(ratio[:, 0xFFFD] > -8, LOST, -8.0)
    ratio[-1, 0xFFFD] = LOST  # someone's replacement character
    for s in range(len(PAIRS)):
        ratio[s, :0x80] = -ASCII_OTHER[s]
        for a in [*range(65, 91), *range(97, 123)]:
            ratio[s, a] = -ASCII_LETTER[s]
    unsafe = (ratio[STRUCT:] > 0).any(0)
    b = byte_of("mac_roman")
    unsafe |= (b >= 0xC2) & (b <= 0xF4) | (byte_of("cp1252") >= 0x81)
    unsafe[:0x80] = False
    return Model(logp, np.maximum(logp, PLAIN), ratio, unsafe)


def _utf8_scores(cp: np.ndarray, enc: str, logp: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Score per code point of one text in state utf-8>enc."""
    b = byte_of(enc)[np.minimum(cp, BMP - 1)].astype(np.int32)
    b[cp >= BMP] = -1
    n = len(cp)
    lp = plain[np.minimum(cp, BMP - 1)]  # control codes alone prove no UTF-8
    score = np.where((b >= 0) & (b < 0x80), -0.02, IMPOSSIBLE)
    pad = np.r_[b, -1, -1, -1]
    cont = (pad >= 0x80) & (pad < 0xC0)
    for size, lo, hi, mask in ((2, 0xC2, 0xDF, 0x1F), (3, 0xE0, 0xEF, 0x0F), (4, 0xF0, 0xF4, 0x07)):
        ok = (b >= lo) & (b <= hi)
        for k in range(1, size):
            ok &= cont[k : k + n]
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        code = b[at] & mask
        seen = lp[at].copy()
        for k in range(1, size):
            code = (code << 6) | (pad[at + k] & 0x3F)
            seen += lp[at + k]
        fine = (code >= {2: 0x80, 3: 0x800, 4: 0x10000}[size]) & (code < 0x110000) & ~((code >= 0xD800) & (code < 0xE000))
        at, code, seen = at[fine], code[fine], seen[fine]
        spelled = np.where(code < BMP, logp[np.minimum(code, BMP - 1)], -14.0)
        spelled = np.where((code >= 0x80) & (code < 0xA0), -14.0, spelled)  # a double round leaves controls
        each = np.clip(spelled - seen, -12, 30) / size
        for k in range(size):
            score[at + k] = each
    return score


@functools.cache
def _two_bytes(encoding: str) -> np.ndarray:
    """Lead * 256 + trail -> the code point the two spell, or -1."""
    out = np.full(1 << 16, -1, np.int32)
    for lead in range(0x81, 0xFF):
        for trail in range(0x30, 0xFF):
            try:
                c = bytes([lead, trail]).decode(encoding)
            except UnicodeDecodeError:
                continue
            if len(c) == 1:
                out[lead << 8 | trail] = ord(c)
    return out


def _two_byte_scores(cp: np.ndarray, state: int, logp: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Score per code point of one text in the state of an East Asian encoding read as cp1252.

    A run of bytes above ASCII is read from its beginning, as a decoder would: a lead byte takes the byte after
    it, which may be ASCII. What is left over is as unlikely as any other character."""
    b = byte_of("cp1252")[np.minimum(cp, BMP - 1)].astype(np.int32)
    b[cp >= BMP] = -1
    n = len(cp)
    ascii_ = (b >= 0) & (b < 0x80)
    letter = ascii_ & ((b | 32) >= 97) & ((b | 32) <= 122)
    score = np.where(letter, -ASCII_LETTER[state], np.where(ascii_, -ASCII_OTHER[state], -8.0))
    high = b >= 0x80
    if not high.any():
        return score
    lp = plain[np.minimum(cp, BMP - 1)]
    nxt = np.r_[b[1:], -1]
    spelled = np.where(high & (nxt >= 0), _two_bytes(PAIRS[state][1])[(np.maximum(b, 0) << 8 | np.maximum(nxt, 0)) & 0xFFFF], -1)
    before = np.r_[False, high[:-1]]
    heads = []
    cur = np.flatnonzero(high & ~before)
    while len(cur):
        ok = spelled[cur] >= 0
        heads.append(cur[ok])
        cur = cur + 1 + ok
        cur = cur[cur < n]
        cur = cur[high[cur] & before[cur]]
    at = np.concatenate(heads)
    each = np.clip(logp[spelled[at]] - lp[at] - lp[at + 1], -16.0, MOST_OF_PAIR) / 2
    score[at] = score[at + 1] = each
    return score


def scores(cp: np.ndarray, m: Model) -> np.ndarray:
    """(len(PAIRS), n) scores of a text, or of several with line breaks between, which no sequence crosses."""
    r = m.ratio[:, np.minimum(cp, BMP - 1)].astype(np.float64)
    r[:, cp >= BMP] = -8.0
    r[0] = _utf8_scores(cp, "cp1252", m.logp, m.plain)
    r[1] = _utf8_scores(cp, "mac_roman", m.logp, m.plain)
    r[2] = _two_byte_scores(cp, 2, m.logp, m.plain)
    r[3] = _two_byte_scores(cp, 3, m.logp, m.plain)
    return r


_BREAK = np.array([10], np.uint32)


def _chunks(sizes: np.ndarray, most: int):
    """Stretches of rows of about ``most`` characters, a row at least each."""
    lo, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n + 1
    if held:
        yield lo, len(sizes)


def label(texts: list[np.ndarray], m: Model) -> list[np.ndarray]:
    """The best path of every text: 0 is clean, s + 1 the pair's state. Texts of similar length run together."""
    out: list[np.ndarray] = [np.zeros(len(t), np.int8) for t in texts]
    live = []
    for lo, hi in _chunks(np.array([len(t) for t in texts], np.int64), 500_000):
        flat = np.concatenate([x for t in texts[lo:hi] for x in (t, _BREAK)])
        r = scores(flat, m)
        at = np.r_[0, np.cumsum([len(t) + 1 for t in texts[lo:hi]])]
        for k in np.flatnonzero(np.logical_or.reduceat((r > 0).any(0), at[:-1])):
            live.append((len(texts[lo + k]), lo + int(k), r[:, at[k] : at[k + 1] - 1].copy()))
    live.sort(key=lambda x: x[0])
    S = len(PAIRS)
    while live:
        many = 256
        while many > 1 and live[min(many, len(live)) - 1][0] * many > 1_500_000:
            many //= 2  # of long texts fewer at once
        part, live = live[:many], live[many:]
        T, B = part[-1][0], len(part)
        R = np.full((T, B, S), -1e-3)
        for b, (n, _, r) in enumerate(part):
            R[:n, b] = r.T
        clean, g = np.zeros(B), np.full((B, S), -1e18)
        from_state = np.zeros((T, B), np.int8)  # where the clean state at t came from
        stay = np.zeros((T, B, S), bool)
        for t in range(T):
            best = g.argmax(1)
            top = g[np.arange(B), best]
            leave = top > clean
            new_clean = np.where(leave, top, clean)
            from_state[t] = np.where(leave, best + 1, 0)
            enter = clean[:, None] - PRICE
            stay[t] = g >= enter
            g = np.where(stay[t], g, enter) + R[t]
            clean = new_clean
        best = g.argmax(1)
        state = np.where(g[np.arange(B), best] > clean, best + 1, 0)
        path = np.zeros((T, B), np.int8)
        idx = np.arange(B)
        for t in range(T - 1, -1, -1):
            path[t] = state
            inside = state > 0
            keep = stay[t, idx, np.maximum(state - 1, 0)]
            state = np.where(inside, np.where(keep, state, 0), from_state[t])
        for b, (n, i, _) in enumerate(part):
            out[i] = path[:n, b]
    return out


def _restore_span(s: str, pair: int) -> tuple[str, bool]:
    _, wrote, read = PAIRS[pair]
    if read == "cp1252":
        table = byte_of("cp1252")
        raw = bytes(int(table[ord(c)]) if ord(c) < BMP and table[ord(c)] >= 0 else 0x3F for c in s)
    else:
        raw = s.encode(read, "replace")
    try:
        if "�" in s or "?" in s and b"?" in raw and raw.count(b"?") > s.count("?"):
            raise UnicodeError
        return raw.decode(wrote), True
    except UnicodeError:
        return raw.decode(wrote, "replace") if wrote != "cp949" or read != "utf-8" else s, False


def _decode_spans(text: str, path: np.ndarray) -> tuple[str, bool, bool, list[str]]:
    """``(text, whole, changed, pairs)`` after one round over the labelled spans."""
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(text)]
    parts, whole, changed, pairs = [], True, False, []
    for a, b in zip(cuts, cuts[1:]):
        s = text[a:b]
        if path[a]:
            pairs.append(PAIRS[path[a] - 1][0])
            fixed, ok = _restore_span(s, path[a] - 1)
            whole &= ok
            changed |= ok and fixed != s
            s = fixed if ok else s
        parts.append(s)
    return "".join(parts), whole, changed, pairs


def restore(texts: list[str], paths: list[np.ndarray], m: Model, rounds: int = 3) -> list[tuple[str, bool, list[str]]]:
    """``(text, whole, pairs)`` of every text: spans decoded back; ``whole`` if every one could be. What changed is
    labelled again, all texts together, up to ``rounds`` rounds of wrong decoding."""
    out: list[tuple[str, bool, list[str]]] = [(t, True, []) for t in texts]
    now = {i: p for i, p in enumerate(paths) if p.any()}  # texts with something garbled left
    for _ in range(rounds):
        again = []
        for i, path in now.items():
            text, ok, changed, more = _decode_spans(out[i][0], path)
            out[i] = (text, out[i][1] and ok and changed, out[i][2] + more)
            if changed:
                again.append(i)
        if not again:
            return out
        fresh = label([np.array([ord(c) for c in out[i][0]], np.uint32) for i in again], m)
        now = {i: p for i, p in zip(again, fresh) if p.any()}
    for i in now:
        out[i] = (out[i][0], False, out[i][2])
    return out


def model(docs: DataFrame, key: str, text: str) -> Model:
    """Counts every character of every document, as it stands and garbled on purpose, in one pass; whatever their keys."""

    def count(batches):
        flat = np.zeros((len(PAIRS) + 1, 0x110000), np.int64)  # the last row as it stands
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                column = whole.column(0).slice(lo, 2000)
                flat[-1] += np.bincount(explode(column)[0], minlength=0x110000)
                for s, n in simulated(column.drop_null().to_pylist()).items():
                    flat[s] += n
        state, at = np.nonzero(flat)
        yield pa.record_batch([pa.array(state, pa.int64()), pa.array(at, pa.int64()), pa.array(flat[state, at], pa.int64())], names=["state", "cp", "n"])

    rows = docs.select(text).mapInArrow(count, "state long, cp long, n long").groupBy("state", "cp").agg(F.sum("n").alias("n")).toArrow()
    by: dict[int, dict[int, int]] = {s: {} for s in range(len(PAIRS) + 1)}
    for s, k, n in zip(*(rows.column(x).to_pylist() for x in ("state", "cp", "n"))):
        by[s][k] = n
    return _fitted(by.pop(len(PAIRS)), by)


def find(docs: DataFrame, key: str, text: str, fitted: Model | None = None) -> DataFrame:
    """One row per garbled document: ``key, restored, whole, pairs, spans``.

    ``restored`` has every span that could be decoded back replaced; ``whole`` tells that nothing garbled is
    left. Null and empty texts are never garbled; keys may repeat, each row is judged by itself. An empty
    table gives no rows. Other columns are ignored.
    """
    m = fitted or model(docs, key, text)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(m)  # 65,536 code points by eight tables, whatever the input
    kind = dict(docs.dtypes)[key]

    def run(batches):
        m = shared.value
        for b in batches:
            cp, off, _ = explode(b.column(1))
            look = np.zeros(len(cp) + 1, np.int64)
            np.cumsum(m.unsafe[np.minimum(cp, BMP - 1)], out=look[1:])
            rows = np.flatnonzero(look[off[1:]] > look[off[:-1]])
            keys, fixed, whole, pairs, spans = [], [], [], [], []
            texts = [cp[off[i] : off[i + 1]] for i in rows]
            found = [(int(i), t.tobytes().decode("utf-32-le"), path) for i, t, path in zip(rows, texts, label(texts, m)) if path.any()]
            for (i, _, path), (s, ok, ps) in zip(found, restore([t for _, t, _ in found], [p for _, _, p in found], m)):
                keys.append(i)
                fixed.append(s)
                whole.append(bool(ok))
                pairs.append(",".join(sorted(set(ps))))
                spans.append(int(((path != 0) & (path != np.r_[0, path[:-1]])).sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keys, pa.int64())), pa.array(fixed, pa.string()), pa.array(whole, pa.bool_()), pa.array(pairs, pa.string()), pa.array(spans, pa.int64())],
                names=["key", "restored", "whole", "pairs", "spans"],
            )

    out = docs.select(F.col(key), F.col(text)).where(F.col(text).isNotNull())
    return out.mapInArrow(run, f"key {kind}, restored string, whole boolean, pairs string, spans long")
