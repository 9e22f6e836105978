"""A small causal self-attention model in numpy: forward over windows, training by back-propagation.

One head reads a window of token buckets and predicts the class of the next token; the logits start
from the log counts of (bucket of the previous token, class), so the attention learns what those
counts don't say.  A token's probability is that of its class times its share in the class.

Products of two weights (queries times keys, values times outputs) are taken once, before they meet the windows,
divisions and weights of tokens go to the narrow side of a product, and rows' maxima are subtracted only where
exponentials could leave float32: the same function of the same weights in fewer passes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Window and stride: a window scores the positions that the window before it has not.
WINDOW, STRIDE = 48, 32
WIDTH, BUCKETS, CLASSES = 16, 1024, 128
#: Tokens whose logits of classes are held at once.
ROWS = 2304


@dataclass
class Net:
    """Weights, and the bucket and class of each token id."""

    weights: dict[str, np.ndarray]
    bucket: np.ndarray
    cls: np.ndarray


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and class of each id: frequent ids have their own, the others share by rank."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    own, many = CLASSES // 2, CLASSES - CLASSES // 2
    spread = own + (np.log2(np.maximum(rank - own, 0) + 1) / np.log2(len(counts) + 1) * many).astype(np.int64)
    cls = np.where(rank < own, rank, np.minimum(spread, CLASSES - 1))
    keep = BUCKETS - 64
    return np.where(rank < keep, rank, keep + rank % 64).astype(np.int32), cls.astype(np.int32)


def fresh(counts: np.ndarray, seed: int = 11) -> Net:
    r = np.random.default_rng(seed)
    g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    bucket, cls = classes_of(counts)
    w = {"emb": 0.3 * g(BUCKETS, WIDTH) * np.sqrt(BUCKETS).astype(np.float32), "pos": 0.1 * r.standard_normal((WINDOW, WIDTH)).astype(np.float32)}
    w |= {k: g(WIDTH, WIDTH) for k in ("q", "k", "v", "o")} | {"out": 0.1 * g(WIDTH, CLASSES)}
    return Net(w, bucket, cls)


_LIVE = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def flat(m: np.ndarray) -> np.ndarray:
    return m.reshape(-1, m.shape[-1])


def embed(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Embeddings of windows of buckets with their positions."""
    e = w["emb"].take(x, 0)
    e += w["pos"][: x.shape[1]]
    return e


def tanh(x: np.ndarray) -> np.ndarray:
    """By numpy's exponential, which is faster than its tanh; ``x`` is overwritten."""
    np.minimum(x, 40, out=x)
    x *= 2
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


def attend(w: dict[str, np.ndarray], e: np.ndarray, first: int = 0, q: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(hidden states, queries, attention, mean embeddings attended to) after positions ``first``.. of embedded windows.

    Where the queries times the keys' weights are given as ``q``, nothing is learnt: the attention stays undivided by its sums.
    """
    t, own, learns = e.shape[1], e[:, first:] if first else e, q is None
    if learns:
        q = (flat(own) @ queries(w)).reshape(own.shape)
    a = q @ e.transpose(0, 2, 1)
    if max(a.max(initial=0), -a.min(initial=0)) > SAFE:
        a += (_LIVE[first:t, :t] - 1) * a.dtype.type(1e9)
        a -= a.max(-1, keepdims=True)
    np.exp(a, out=a)
    a *= _LIVE[first:t, :t]
    share = (1 / (flat(a) @ np.ones(t, a.dtype))).reshape(*a.shape[:2], 1)
    if learns:
        a *= share
    r = a @ e
    if not learns:
        r *= share
    h = tanh(flat(r) @ (w["v"] @ w["o"])).reshape(r.shape)
    h += own
    return h, q, a, r


def queries(w: dict[str, np.ndarray]) -> np.ndarray:
    """Weights of queries times those of keys, scaled."""
    return (w["q"] @ w["k"].T) * w["q"].dtype.type(WIDTH**-0.5)


def forward(w: dict[str, np.ndarray], x: np.ndarray, first: int = 0) -> tuple[np.ndarray, ...]:
    """Hidden states after positions ``first``.. of windows ``x`` (n, length) of buckets, each from itself and what is before it; then what attend gives."""
    return attend(w, embed(w, x), first)


def reach(bias: np.ndarray) -> float:
    """How far the largest entries of the rows are from 0, at most: small for log shares, however rare their classes are."""
    return float(max(bias.max(initial=0), -bias.max(1).min(initial=0)))


def log_shares(h: np.ndarray, out: np.ndarray, x: np.ndarray, y: np.ndarray, bias: np.ndarray, far: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(log P of class ``y``, exponentials of all classes' logits, their sums, places of ``y`` in them) after hidden states ``h`` and buckets ``x``; ``far``: the rows' maxima are to be subtracted."""
    z = h @ out
    z += bias.take(x, 0)
    if far:
        z -= z.max(1, keepdims=True)
    hit = np.arange(0, z.size, z.shape[1]) + y
    lp = z.reshape(-1).take(hit)
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    lp -= np.log(total)
    return lp, z, total, hit


_CELLS = np.arange(BUCKETS * WIDTH).reshape(BUCKETS, WIDTH)


#: Largest absolute logit whose exponential is taken without subtracting the row's largest first (float32 holds e^88).
SAFE = 60.0


def longest(x: np.ndarray) -> float:
    """Largest Euclidean length of the vectors on the last axis."""
    return float(np.sqrt(np.einsum("...d,...d->...", x, x).max(initial=0)))


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(-1, keepdims=True)
    return z - np.log(np.exp(z).sum(-1, keepdims=True))


def n_windows(sizes: np.ndarray) -> np.ndarray:
    return np.maximum(1, -(-(sizes - 1) // WINDOW))


def windows_of(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Windows (n, WINDOW + 1) that hold each pair of neighbours of texts laid end to end once, -1 where a text has ended; ``order``: which of them."""
    n = n_windows(sizes)
    text = np.repeat(np.arange(len(sizes)), n)
    at = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    begin, left = at + (np.cumsum(sizes) - sizes)[text], sizes[text] - at
    if order is not None:
        begin, left = begin[order], left[order]
    out = ids.take(begin[:, None] + np.arange(WINDOW + 1), mode="clip").astype(np.int32)
    short = np.flatnonzero(left <= WINDOW)
    out[short] = np.where(np.arange(WINDOW + 1) < left[short, None], out[short], -1)
    return out


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, live: np.ndarray, bias: np.ndarray, wide: float | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of live tokens (nats) and its gradients; ``x`` buckets, ``y`` classes that follow; ``wide``: the ``reach`` of ``bias``, where it is known."""
    e, t = embed(w, x), x.shape[1]
    h, q, a, r = attend(w, e)
    hs, xs, ys, on = flat(h), x.ravel(), y.ravel(), live.ravel()
    count, loss = max(1, int(np.count_nonzero(on))), 0.0
    far = longest(hs) * longest(w["out"].T) + (reach(bias) if wide is None else wide) > SAFE
    dh, g = np.empty_like(hs), {"out": np.zeros_like(w["out"])}
    for i in range(0, len(hs), ROWS):
        part = slice(i, i + ROWS)
        lp, d, total, hit = log_shares(hs[part], w["out"], xs[part], ys[part], bias, far)
        loss -= float((lp * on[part]).sum(dtype=float)) / count
        d.reshape(-1)[hit] -= total
        share = (on[part] / (total * count)).astype(d.dtype)[:, None]  # goes to the narrow side of both products
        g["out"] += (hs[part] * share).T @ d
        np.multiply(d @ w["out"].T, share, out=dh[part])
    h -= e
    du = flat(h)  # of the tanh
    du *= du
    np.subtract(1, du, out=du)
    du *= dh
    vo = flat(r).T @ du
    g["v"], g["o"] = vo @ w["o"].T, w["v"].T @ vo
    dr = (du @ (w["v"] @ w["o"]).T).reshape(r.shape)
    ds = dr @ e.transpose(0, 2, 1)
    ds -= np.einsum("btd,btd->bt", dr, r)[..., None]  # the sum of a times the gradient of a on each row
    ds *= a
    dq = flat(ds @ e)
    qk = (flat(e).T @ dq) * e.dtype.type(WIDTH**-0.5)
    g["q"], g["k"] = qk @ w["k"], qk.T @ w["q"]
    dh += dq @ queries(w).T
    dh += flat(a.transpose(0, 2, 1) @ dr)
    dh += flat(ds.transpose(0, 2, 1) @ q)
    g["pos"] = np.zeros_like(w["pos"])
    g["pos"][:t] = dh.reshape(e.shape).sum(0)
    g["emb"] = np.bincount(_CELLS.take(x.ravel(), 0).ravel(), dh.ravel(), minlength=w["emb"].size).reshape(w["emb"].shape).astype(w["emb"].dtype)
    return loss, g


def train(net: Net, windows: np.ndarray, bias: np.ndarray, steps: int = 300, batch: int = 48, rate: float = 0.01, seed: int = 5, order: np.ndarray | None = None, part: tuple[float, float] = (0, 1)) -> list[float]:
    """Adam on windows (n, WINDOW + 1) of ids, -1 where a text has ended; returns the losses (nats per token).

    ``order`` says which windows are taken, one after the other (else ``steps`` random batches); ``part``, what part of a
    training this is, as the rate falls from its begin to its end.
    """
    r, names, losses, wide = np.random.default_rng(seed), list(net.weights), [], reach(bias)
    p = np.concatenate([net.weights[k].ravel() for k in names])
    ends = np.cumsum([net.weights[k].size for k in names])
    w = {k: v.reshape(net.weights[k].shape) for k, v in zip(names, np.split(p, ends[:-1]))}  # views of p
    m, s = np.zeros_like(p), np.zeros_like(p)
    steps = steps if order is None else -(-len(order) // batch)
    for step in range(1, steps + 1 if len(windows) else 1):
        ids = windows[r.integers(0, len(windows), batch) if order is None else order[(step - 1) * batch : step * batch]]
        live = (ids[:, 1:] >= 0) & (ids[:, :-1] >= 0)
        loss, g = gradients(w, net.bucket[ids[:, :-1]], net.cls[ids[:, 1:]], live, bias, wide)
        losses.append(loss)
        lr = rate * (1 - part[0] - (part[1] - part[0]) * step / (steps + 1))
        d = np.concatenate([g[k].ravel() for k in names])
        m *= 0.9
        m += 0.1 * d
        s *= 0.99
        d *= d
        d *= 0.01
        s += d
        np.sqrt(s, out=d)
        d *= (1 - 0.99**step) ** -0.5
        d += 1e-6
        np.divide(m, d, out=d)
        d *= lr / (1 - 0.9**step)
        p -= d
    net.weights.update(w)
    return losses


def class_scores(net: Net, bias: np.ndarray, texts: list[np.ndarray], batch: int = 128) -> np.ndarray:
    """log P(class of ids[1:]) of each text (each begins with its start id), summed by text: every token once."""
    out = np.zeros(len(texts))
    size = np.array([len(x) - 1 for x in texts])  # tokens that are predicted
    begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    bucket, cls = net.bucket[ids], net.cls[ids]
    more = np.maximum(0, -(-(size - WINDOW) // STRIDE))
    rest = np.repeat(np.arange(len(texts)), more)
    nth = np.arange(len(rest)) - np.repeat(np.cumsum(more) - more, more) + 1
    w, wide, long = net.weights, reach(bias), longest(net.weights["out"].T)
    asks = {k: w[k] @ queries(w) for k in ("emb", "pos")}  # a query is a sum of two rows
    head = np.flatnonzero(size > 0)
    head = head[np.argsort(size[head], kind="stable")]  # short windows together
    for text, at, first in ((head, np.zeros(len(head), int), 0), (rest, nth * STRIDE, WINDOW - STRIDE)):
        for z in range(0, len(text), batch):
            i, a = text[z : z + batch], at[z : z + batch]
            n = np.minimum(WINDOW, size[i] - a)
            t = int(n.max())
            place = np.minimum((begin[i] + a)[:, None] + np.arange(t), len(ids) - 2)
            b, c = bucket.take(place), cls.take(place[:, first:] + 1)
            own = b[:, first:]
            q = asks["emb"].take(own, 0)
            q += asks["pos"][first:t]
            h, x, y = flat(attend(w, embed(w, b), first, q)[0]), own.ravel(), c.ravel()
            far, lp = longest(h) * long + wide > SAFE, np.empty(len(y), h.dtype)
            for k in range(0, len(y), ROWS):
                part = slice(k, k + ROWS)
                lp[part] = log_shares(h[part], w["out"], x[part], y[part], bias, far)[0]
            lp = lp.reshape(c.shape) * (np.arange(first, t) < n[:, None])
            out += np.bincount(i, lp.sum(1, dtype=np.float64), minlength=len(out))
    return out
