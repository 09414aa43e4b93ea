"""A character-level bidirectional LSTM with CRF transitions, in numpy: training and fast decoding.

Gates of all steps of all windows are computed together. Texts are laid end to end in one stream, which is
cut into windows that overlap; the emissions of a place in two windows are averaged, so spans across window
borders come out whole, and the CRF is then decoded over each whole text. Texts in which no tag can outweigh
the outside tag, whatever the transitions, need no decoding.
"""

from __future__ import annotations

import numpy as np


def _sig(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * 0.5) * 0.5 + 0.5


class Params:
    """``table``: (2, V, 4H) input contributions, ``u``: (2, H, 4H), ``out``: (2H, K), ``bias``: K, ``trans``: (K, K),
    ``start``: K. Gates in the order input, forget, output, candidate."""

    def __init__(self, vocab: int, hidden: int, tags: int, seed: int):
        r = np.random.default_rng(seed)
        h = hidden
        self.v = {
            "table": (r.standard_normal((2, vocab, 4 * h)) * 0.3).astype(np.float32),
            "u": (r.standard_normal((2, h, 4 * h)) / np.sqrt(h)).astype(np.float32),
            "out": (r.standard_normal((2 * h, tags)) / np.sqrt(2 * h)).astype(np.float32),
            "bias": np.zeros(tags, np.float32),
            "trans": np.zeros((tags, tags), np.float32),
            "start": np.zeros(tags, np.float32),
        }
        self.v["table"][:, :, h : 2 * h] += 1.0
        self.hidden = hidden


def _run(table: np.ndarray, u: np.ndarray, x: np.ndarray, keep: bool):
    """One direction over ``x`` (T, B): hidden states (T, B, H), and what the backward pass needs."""
    T, B = x.shape
    H = u.shape[0]
    h, c = np.zeros((B, H), np.float32), np.zeros((B, H), np.float32)
    hs = np.zeros((T, B, H), np.float32)
    saved = []
    for t in range(T):
        z = table[x[t]]
        z += h @ u
        s = z[:, : 3 * H]
        s *= 0.5
        np.tanh(z, out=z)
        s *= 0.5
        s += 0.5
        i, f, o, g = z[:, :H], z[:, H : 2 * H], z[:, 2 * H : 3 * H], z[:, 3 * H :]
        if keep:
            prev_c, prev_h = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        hs[t] = h
        if keep:
            saved.append((z, prev_c, prev_h, tc))
    return hs, saved


def _back(dh_all: np.ndarray, saved: list, u: np.ndarray, x: np.ndarray, dtable: np.ndarray, du: np.ndarray) -> None:
    T, B = x.shape
    H = u.shape[0]
    dh, dc = np.zeros((B, H), np.float32), np.zeros((B, H), np.float32)
    dzs = np.zeros((T, B, 4 * H), np.float32)
    for t in range(T - 1, -1, -1):
        z, prev_c, prev_h, tc = saved[t]
        i, f, o, g = z[:, :H], z[:, H : 2 * H], z[:, 2 * H : 3 * H], z[:, 3 * H :]
        dh = dh + dh_all[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = dzs[t]
        dz[:, :H] = dc * g * i * (1 - i)
        dz[:, H : 2 * H] = dc * prev_c * f * (1 - f)
        dz[:, 2 * H : 3 * H] = dh * tc * o * (1 - o)
        dz[:, 3 * H :] = dc * i * (1 - g * g)
        du += prev_h.T @ dz
        dh = dz @ u.T
        dc = dc * f
    flat = x.reshape(-1)
    order = np.argsort(flat, kind="stable")
    ids, first = np.unique(flat[order], return_index=True)
    dtable[ids] += np.add.reduceat(dzs.reshape(T * B, -1)[order], first, axis=0)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis))


def loss_and_grads(p: Params, x: np.ndarray, y: np.ndarray, mask: np.ndarray):
    """Mean negative log likelihood of a batch ``x, y`` (T, B); ``mask`` marks real places."""
    v, H = p.v, p.hidden
    T, B = x.shape
    K = len(v["bias"])
    hf, sf = _run(v["table"][0], v["u"][0], x, True)
    hb, sb = _run(v["table"][1], v["u"][1], x[::-1], True)
    hid = np.concatenate([hf, hb[::-1]], 2)
    e = hid @ v["out"] + v["bias"]
    tr = v["trans"]
    a = np.zeros((T, B, K), np.float64)
    a[0] = v["start"] + e[0]
    for t in range(1, T):
        n = _lse(a[t - 1][:, :, None] + tr, 1) + e[t]
        a[t] = np.where(mask[t][:, None], n, a[t - 1])
    logz = _lse(a[-1], 1)
    b = np.zeros((T, B, K), np.float64)
    for t in range(T - 2, -1, -1):
        n = _lse(tr[None] + (e[t + 1] + b[t + 1])[:, None, :], 2)
        b[t] = np.where(mask[t + 1][:, None], n, 0.0)
    bi = np.arange(B)
    gold = v["start"][y[0]] + e[0, bi, y[0]]
    for t in range(1, T):
        gold = gold + mask[t] * (tr[y[t - 1], y[t]] + e[t, bi, y[t]])
    marg = np.exp(a + b - logz[None, :, None]) * mask[:, :, None]
    de = marg.copy()
    for t in range(T):
        de[t, bi, y[t]] -= mask[t]
    dtr = np.zeros((K, K))
    for t in range(1, T):
        m = mask[t]
        pair = np.exp(a[t - 1][:, :, None] + tr + (e[t] + b[t])[:, None, :] - logz[:, None, None]) * m[:, None, None]
        dtr += pair.sum(0)
        np.add.at(dtr, (y[t - 1], y[t]), -m.astype(float))
    dstart = de[0].sum(0)
    de = (de / B).astype(np.float32)
    g = {k: np.zeros_like(w) for k, w in v.items()}
    g["trans"], g["start"] = (dtr / B).astype(np.float32), (dstart / B).astype(np.float32)
    g["bias"] = de.sum((0, 1))
    g["out"] = np.tensordot(hid, de, ([0, 1], [0, 1]))
    dhid = de @ v["out"].T
    _back(dhid[:, :, :H], sf, v["u"][0], x, g["table"][0], g["u"][0])
    _back(np.ascontiguousarray(dhid[::-1, :, H:]), sb, v["u"][1], x[::-1], g["table"][1], g["u"][1])
    return float((logz - gold).mean()), g


def train(x: list[np.ndarray], y: list[np.ndarray], vocab: int, tags: int, hidden: int, epochs: int, batch: int, seed: int, rate: float = 0.02) -> Params:
    p = Params(vocab, hidden, tags, seed)
    r = np.random.default_rng(seed)
    m = {k: np.zeros_like(w) for k, w in p.v.items()}
    s = {k: np.zeros_like(w) for k, w in p.v.items()}
    step, total = 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        # batches of similar length, in random order
        order = np.argsort(np.array([len(q) for q in x]) + r.random(len(x)) * 8)
        cuts = [order[i : i + batch] for i in range(0, len(order), batch)]
        for j in r.permutation(len(cuts)):
            ix = cuts[j]
            T = max(len(x[i]) for i in ix)
            X, Y, M = np.zeros((T, len(ix)), np.int64), np.zeros((T, len(ix)), np.int64), np.zeros((T, len(ix)), bool)
            for b, i in enumerate(ix):
                n = len(x[i])
                X[:n, b], Y[:n, b], M[:n, b] = x[i], y[i], True
            _, g = loss_and_grads(p, X, Y, M)
            norm = np.sqrt(sum(float((q.astype(np.float64) ** 2).sum()) for q in g.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            step += 1
            lr = rate * min(1.0, step / 20) * (1 - 0.95 * step / total)
            for k, w in p.v.items():
                q = g[k] * scale
                m[k] = 0.9 * m[k] + 0.1 * q
                s[k] = 0.99 * s[k] + 0.01 * q * q
                w -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return p


def emissions(p: Params, stream: np.ndarray, window: int = 128, margin: int = 16, lanes: int = 2048) -> np.ndarray:
    """(n, K) emissions of a stream of symbols; windows of ``window`` overlap by twice ``margin``."""
    v, n = p.v, len(stream)
    K = len(v["bias"])
    out = np.zeros((n, K), np.float32)
    seen = np.zeros(n, np.uint8)
    stride = window - 2 * margin
    starts = np.arange(0, max(n - 2 * margin, 1), stride)
    pad = np.concatenate([stream, np.zeros(window, stream.dtype)])
    H = p.hidden
    for lo in range(0, len(starts), lanes):
        st = starts[lo : lo + lanes]
        x = np.ascontiguousarray(pad[st[None, :] + np.arange(window)[:, None]])
        hf, _ = _run(v["table"][0], v["u"][0], x, False)
        hb, _ = _run(v["table"][1], v["u"][1], np.ascontiguousarray(x[::-1]), False)
        e = hf @ v["out"][:H]
        e += hb[::-1] @ v["out"][H:]
        # places near a window's edge know one side only: half a margin is left to the neighbour
        skip, k = margin // 2, np.arange(window)[:, None]
        at = st[None, :] + k
        ok = (at < n) & ((k >= skip) | (st[None, :] == 0)) & ((k < window - skip) | (st[None, :] + window >= n))
        for par in (0, 1):  # every other window: no two of them overlap
            sel = ok[:, par::2]
            a = at[:, par::2][sel]
            out[a] += e[:, par::2][sel]
            seen[a] += 1
    out /= np.maximum(seen, 1)[:, None]
    out += v["bias"]
    return out


def decode(p: Params, em: np.ndarray, offsets: np.ndarray, outside: int = 0) -> np.ndarray:
    """The best tag of every place, text by text (``offsets``: n + 1 starts into ``em``)."""
    tr, start = p.v["trans"], p.v["start"]
    K = em.shape[1]
    tags = np.zeros(len(em), np.int8)
    if not len(em):
        return tags
    # no path with other tags can win where every place prefers the outside tag by more than transitions give
    others = np.delete(np.arange(K), outside)
    lead = em[:, outside] - em[:, others].max(1)
    gain = 2 * max(float((tr - tr[outside, outside]).max()), float((start - start[outside]).max()), 0.0)
    size = np.diff(offsets)
    low = np.full(len(size), np.inf)
    some = np.flatnonzero(size > 0)
    low[some] = np.minimum.reduceat(lead, offsets[:-1][some])
    todo = np.flatnonzero(low <= gain)
    todo = todo[np.argsort(size[todo], kind="stable")]
    for lo in range(0, len(todo), 512):
        ix = todo[lo : lo + 512]
        T, B = int(size[ix].max()), len(ix)
        at = np.minimum(offsets[ix][None, :] + np.arange(T)[:, None], len(em) - 1)
        live = np.arange(T)[:, None] < size[ix][None, :]
        back = np.zeros((T, B, K), np.int8)
        score = start + em[at[0]]
        keep = np.arange(K, dtype=np.int8)
        for t in range(1, T):
            cand = score[:, :, None] + tr
            best = cand.argmax(1)
            new = np.take_along_axis(cand, best[:, None, :], 1)[:, 0] + em[at[t]]
            on = live[t][:, None]
            back[t] = np.where(on, best, keep)
            score = np.where(on, new, score)
        tag = score.argmax(1)
        for t in range(T - 1, -1, -1):
            ok = live[t]
            tags[at[t][ok]] = tag[ok]
            tag = back[t, np.arange(B), tag]
    return tags
