"""Arrow string columns as numpy arrays of code points, without touching single rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def explode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(cp, offsets, valid)``: all code points (uint32), n + 1 row offsets, and a mask of non-null rows.

    Null rows have no code points. The column's UTF-8 buffer is decoded in one call.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    valid = np.ones(n, bool) if texts.null_count == 0 else np.asarray(texts.is_valid())
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64), valid
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64, n + 1, texts.offset * 8)
    raw = memoryview(bufs[2] or b"")[off[0] : off[-1]]
    if not valid.all():  # null slots may point at bytes: take them out
        texts = texts.fill_null("")
        bufs = texts.buffers()
        off = np.frombuffer(bufs[1], np.int64, n + 1, texts.offset * 8)
        raw = memoryview(bufs[2] or b"")[off[0] : off[-1]]
    byte = np.frombuffer(raw, np.uint8)
    heads = np.zeros(len(byte) + 1, np.int64)
    np.cumsum((byte & 0xC0) != 0x80, out=heads[1:])
    cp = np.frombuffer(bytes(raw).decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return cp, heads[off - off[0]], valid


def implode(cp: np.ndarray, offsets: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """The inverse of ``explode``: one UTF-8 buffer, with byte offsets from the code points' widths."""
    cp = np.ascontiguousarray(cp, np.uint32)
    width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    ends = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(width, out=ends[1:])
    raw = cp.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    off = np.ascontiguousarray(ends[offsets], np.int64)
    mask = None
    if valid is not None and not valid.all():
        mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    out = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [mask, pa.py_buffer(off.tobytes()), pa.py_buffer(raw)])
    return out.cast(pa.string()) if off[-1] < 2**31 else out


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of every code point."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def reoffset(kept_per_row: np.ndarray) -> np.ndarray:
    out = np.zeros(len(kept_per_row) + 1, np.int64)
    np.cumsum(kept_per_row, out=out[1:])
    return out


def gram_hashes(cp: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the ``n`` code points from every place on; the last n - 1 places have none."""
    m = max(len(cp) - n + 1, 0)
    h = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + cp[k : k + m] + np.uint64(1)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def grams(cp: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, hash)`` of every n-gram that lies within one row."""
    h = gram_hashes(cp, n)
    row = rows_of(offsets)[: len(h)]
    at = np.arange(len(h))
    ok = at + n <= offsets[row + 1] if len(h) else np.zeros(0, bool)
    return row[ok], at[ok], h[ok]
