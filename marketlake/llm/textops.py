"""Vectorised word and shingle hashing over batches of texts (numpy, inside Spark tasks).

Words are ``[^\\x20\\x09-\\x0D]+``; lower-casing folds A-Z only.  Hashes are 64-bit, position
weighted sums of random byte codes with a final mix, the same on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII byte but letters and digits.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_rng = np.random.default_rng(20240607)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _CODE.copy()
_LOWER[65:91] = _CODE[97:123]
_STEP = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text that one numpy pass takes; a longer text is one pass of its own.
CHUNK = 2 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64; kept by the worker up to twice a chunk."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    out = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)))) for b in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))]
    if n <= 2 * CHUNK:
        _powers[:] = out
    return out[0], out[1]


@dataclass
class Words:
    """Words of several texts: bounds in ``raw``, and the first word of each text (``first[-1]``: all)."""

    raw: bytes
    buf: np.ndarray
    space: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    text_at: np.ndarray  # where each text begins in raw; the last entry is len(raw) + 1
    codes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        n = self.ends - self.starts
        if not len(n):
            return np.zeros(0, np.uint64)
        power, inverse = powers(len(self.buf) + 1)
        sums = np.zeros(len(self.buf) + 1, np.uint64)  # weighted by place in raw: a word is a difference, brought back to its own begin
        with np.errstate(over="ignore"):
            val = self.codes.take(self.buf)
            val *= power[1:]
            np.cumsum(val, out=sums[1:])
            h = sums.take(self.ends)
            h -= sums.take(self.starts)
            h *= inverse.take(self.starts)
            h += n.astype(np.uint64)
            return mix(h)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(texts: list[str], lower: bool, between: np.ndarray = _SPACE) -> Words:
    """``between``: the bytes that part words."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = b"\n".join(raws)
    buf = np.frombuffer(raw, np.uint8)
    space = between[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    text_at = np.concatenate(([0], np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))))
    return Words(raw, buf, space, starts, ends, np.searchsorted(starts, text_at), text_at, _LOWER if lower else _CODE)


def chunks(ids: list, texts: list[str | None], most: int = CHUNK) -> Iterator[tuple[list, list[str]]]:
    """Batches of about ``most`` characters; null texts are empty."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > most:
            yield ids[a:i], [x or "" for x in texts[a:i]]
            a, size = i, 0
        size += len(t or "") + 1
    if a < len(ids):
        yield ids[a:], [x or "" for x in texts[a:]]


def shingles(w: Words, n: int = 5, short: bool = True, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hash, word index) of each n-word window; with ``short`` a text of 1..n-1 words is one shingle; ``hashes``: of all words, where they are known."""
    h, counts = w.hashes() if hashes is None else hashes, w.counts
    if len(h) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = w.doc_of()
    at = np.flatnonzero(w.first[doc + 1] - np.arange(len(h)) >= n)
    with np.errstate(over="ignore"):
        s = np.zeros(len(at), np.uint64)
        for k in range(n):
            s += h[at + k] * _STEP[k]
        s = mix(s + np.uint64(n))
        out = [(doc[at], s, at)]
        if short and (few := np.flatnonzero((counts > 0) & (counts < n))).size:
            v = np.array([mix(np.add.reduce(h[w.first[d] : w.first[d + 1]] * _STEP[: counts[d]], dtype=np.uint64)[None] + np.uint64(counts[d]))[0] for d in few], np.uint64)
            out.append((few, v, w.first[few]))
    d, s, p = (np.concatenate(x) for x in zip(*out))
    return d, s, p


def shingle_sets(texts: list[str], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as (offsets, hashes sorted within each text)."""
    w = words(texts, True)
    d, s, _ = shingles(w, n)
    at = np.concatenate(([0], np.cumsum(np.bincount(d, minlength=len(texts)))))
    s = s[np.argsort(d, kind="stable")] if len(d) and np.any(d[1:] < d[:-1]) else s
    parts = []
    for i in range(len(texts)):
        x = np.sort(s[at[i] : at[i + 1]])
        parts.append(x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x)
    off = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
    return off, np.concatenate(parts) if parts else np.zeros(0, np.uint64)
