"""Embedding whitening by shifted CholeskyQR.

Each entry c becomes the integer x = floor(64 c) + 1000000.  The centred rows are orthogonalised in
distributed Gram passes: every task solves its rows against the triangular factors found so far and adds up
their products; the driver holds sums of dimension by dimension only.  The first factor is the Cholesky
factor of the Gram matrix plus a shift, which makes it succeed for dependent columns too; the next passes
repeat on the solved rows until their Gram matrix is the identity.  The product of the factors is the R of
the centred rows, and its singular value decomposition gives the components and their eigenvalues.

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped; a vector
shorter than the longest counts as 0 in its missing dimensions; entries are clamped to +-2^46 before they become
integers; repeated rows and null ids are rows of their own; no rows (or no dimension) give an empty result.  Components with no
variance have a null ``whitened`` (and count for nothing in ``identity_error``, null where no component has any);
``explained`` is null where the whole variance is 0; ``deviation`` is null where it exceeds a long.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
#: Entries are clamped to this size, so that integers stay exact in doubles.
MOST = 1 << 46
#: Gram passes that give a factor; a well-conditioned table needs two.
PASSES = 4


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the rows that remain, their floor(64 c) as integers, padded by 0 to the longest)."""
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    row = np.repeat(np.arange(len(column)), np.maximum(lengths, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    bad = np.bincount(row[~np.isfinite(flat)], minlength=len(column)) > 0
    keep = np.flatnonzero((lengths >= 0) & ~bad)
    at = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))))
    take = np.repeat(~bad & (lengths >= 0), np.maximum(lengths, 0))
    out = np.zeros((len(keep), int(lengths[keep].max(initial=0))), np.int64)
    place = np.cumsum(~bad & (lengths >= 0)) - 1
    out[place[row[take]], (np.arange(len(flat)) - at[row])[take]] = np.clip(np.floor(SCALE * flat[take]), -MOST, MOST)
    return keep, out


def _widen(x: np.ndarray, d: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, d - x.shape[1])))


def _sums(vectors: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of the flat vector that ``of`` makes of a batch's entries: one row a task, then an aggregation by position."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, float if kind == "double" else np.int64)
        for b in batches:
            x = of(_entries(b.column(0))[1])
            total, x = (x, total) if len(x) > len(total) else (total, x)
            total = total.copy()
            total[: len(x)] += x
        if len(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64() if kind == "double" else pa.int64()))], ["v"])

    cells = vectors.mapInArrow(part, f"v array<{kind}>").select(F.posexplode("v").alias("i", "v"))
    rows = cells.groupBy("i").agg(F.sum(F.col("v").cast("double" if kind == "double" else "decimal(38,0)")).alias("v")).collect()
    out = np.zeros(len(rows), float if kind == "double" else object)
    for r in rows:
        out[r["i"]] = r["v"] if kind == "double" else int(r["v"])
    return out


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, with the whole part of the mean taken off in integers."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (_widen(x, len(sums)) - whole).astype(float) - rest


def solve(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q r = y, for an upper triangular r, one column after the other."""
    q = np.empty_like(y)
    for j in range(r.shape[0]):
        q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor; with a shift in the first pass, or where the matrix has no factor."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps * float(np.trace(gram))
    if not first:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 16


def _gram(vectors: DataFrame, n: int, sums: list[int], then: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Gram matrix of the rows that ``then`` makes of the centred ones, from sums of its upper half."""
    up = np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        q = then(centred(x, n, sums))
        return (q.T @ q)[up]

    out = np.zeros((width, width))
    out[up] = _sums(vectors, products, "double")
    return out + np.triu(out, 1).T


def fit(vectors: DataFrame) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """(n, sums of floor(64 c) by dimension, components as columns, their eigenvalues), of a table of one array<double> column."""
    told = _sums(vectors, lambda x: np.concatenate(([len(x)], x.sum(axis=0))).astype(np.int64), "bigint")
    n, sums = (int(told[0]), [int(s) for s in told[1:]]) if len(told) else (0, [])
    d = len(sums)
    if not n or not d:
        return n, sums, np.zeros((d, 0)), np.zeros(0)
    factors: list[np.ndarray] = []
    while True:

        def orthogonal(y: np.ndarray, factors=tuple(factors)) -> np.ndarray:
            for r in factors:
                y = solve(y, r)
            return y

        gram = _gram(vectors, n, sums, orthogonal, d)
        close = factors and np.abs(gram - np.eye(d)).max() < 1e-10
        if close or len(factors) == PASSES or not np.trace(gram):
            break
        factors.append(_factor(gram, n, not factors))
    # what is left of the last Gram matrix goes into R by its square root, so dependent columns are exact as well
    values, vectors_ = np.linalg.eigh(gram)
    r = np.sqrt(np.maximum(values, 0))[:, None] * vectors_.T
    for f in reversed(factors):
        r = r @ f
    _, singular, v = np.linalg.svd(r)
    return n, sums, v.T, singular**2 / n


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exactly: in longs where all fit, else in Python's integers."""
    d, low = len(sums), np.array([abs(s) for s in sums], object)
    x = _widen(x, d)
    most = n * int(np.abs(x).max(initial=0)) + int(low.max(initial=0))
    if d * most * most < 1 << 63:
        y = n * x - np.array(sums, np.int64)
        return pa.array((y * y).sum(axis=1))
    if most < 1 << 62:
        y = (n * x - np.array(sums, np.int64)).astype(object)
    else:
        y = n * x.astype(object) - np.array(sums, object)
    total = (y * y).sum(axis=1)
    return pa.array([int(t) if t < 1 << 63 else None for t in total], pa.int64())


def whiten(rows: DataFrame, most: int = 32, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per remaining row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    table = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    n, sums, components, eigen = fit(table.select("v"))
    k, trace = min(most, len(eigen)), float(eigen.sum())
    e = eigen[:k]
    live = e > (len(eigen) * np.finfo(float).eps * eigen[0] if k else 0)
    scale = components[:, :k] / np.sqrt(np.where(live, e, 1.0)) if k else components
    explained = e / trace if trace else np.full(k, np.nan)
    error = None
    if live.any():
        cov = _gram(table.select("v"), n, sums, lambda y: y @ scale[:, live], int(live.sum())) / n
        error = float(np.abs(cov - np.eye(len(cov))).max())
    id_type = table.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x = _entries(b.column(1))
            if not len(keep) or not k:
                continue
            w = centred(x, n, sums) @ scale
            times = np.repeat(np.arange(len(keep)), k)
            none = np.tile(~live, len(keep))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(keep[times])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(keep))),
                    pa.array(np.full(len(times), n, np.int64)),
                    _deviation(x, n, sums).take(pa.array(times)),
                    pa.array(w.ravel(), mask=none),
                    pa.array(np.tile(explained, len(keep)), mask=np.tile(np.isnan(explained), len(keep))),
                    pa.array(np.full(len(times), np.nan if error is None else error), mask=np.full(len(times), error is None)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return table.mapInArrow(project, schema)
