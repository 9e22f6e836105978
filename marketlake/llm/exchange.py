"""Counting keys over a whole corpus by packed shards.

A corpus is dealt into blocks by id.  Each block sends its distinct 64-bit keys, packed as one
binary value for each shard, to the shard that owns them; a shard adds up what all blocks sent and
answers each block with the totals of its own keys: one bit for each key that was sent, in order, and the
totals of those that are held.  Spark shuffles a few packed rows for each
(block, shard) that has keys instead of one row for each key, no key is ever held by the driver, and
a key that is in every block costs one entry a block.  Rows are at most the lesser of blocks times
shards and of the blocks' distinct keys, so however many blocks there are, there are never more rows
than an aggregation by key would shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENT = "block int, shard int, keys binary, counts binary"
ANSWER = "block int, shard int, held binary, totals binary"


def encode(keys: np.ndarray) -> bytes:
    """Sorted distinct unsigned keys as differences of 4 bytes each where they fit, else of 8."""
    if not len(keys):
        return b""
    d = np.diff(keys, prepend=np.uint64(0))
    small = len(d) == 1 or int(d[1:].max()) < 1 << 32
    return (b"4" if small else b"8") + int(d[0]).to_bytes(8, "little") + d[1:].astype("<u4" if small else "<u8").tobytes()


def decode(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    d = np.frombuffer(raw[9:], "<u4" if raw[:1] == b"4" else "<u8").astype(np.uint64)
    return np.cumsum(np.concatenate((np.frombuffer(raw[1:9], "<u8"), d)), dtype=np.uint64)


def encode_counts(counts: np.ndarray) -> bytes:
    """Counts as planes of bytes, low bytes first, only as many as the largest needs: shuffles compress planes of zeros away."""
    width = max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def decode_counts(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<i8").ravel()


def edges(keys: np.ndarray, shards: int, bits: int = 64) -> np.ndarray:
    """Where each shard's range begins in sorted keys, and their number."""
    inner = np.searchsorted(keys, np.array([(s << bits) // shards for s in range(1, shards)], np.uint64))
    return np.concatenate(([0], inner, [len(keys)]))


def pack(block: int, keys: np.ndarray, counts: np.ndarray, shards: int, bits: int = 64) -> list[dict]:
    """Rows of SENT for sorted distinct keys under 2^bits; a shard owns a range of keys."""
    at = edges(keys, shards, bits)
    return [
        {"block": block, "shard": s, "keys": encode(keys[a:b]), "counts": encode_counts(counts[a:b])}
        for s, (a, b) in enumerate(zip(at[:-1], at[1:]))
        if b > a
    ]


def totals_by_key(pdf: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(total of each entry, keys of each row, total of each distinct key) of the rows of one shard."""
    rows = [decode(x) for x in pdf["keys"]]
    keys = np.concatenate(rows)
    counts = np.concatenate([decode_counts(x) for x in pdf["counts"]])
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    total = np.add.reduceat(counts[order], head)
    per = np.empty(len(keys), np.int64)
    per[order] = np.repeat(total, np.diff(np.append(head, len(k))))
    return per, rows, total


def add_up(sent: DataFrame, least: int = 1) -> DataFrame:
    """Totals of each key over all blocks, answered to each block that sent it; totals under ``least`` are left out."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        per, rows, _ = totals_by_key(pdf)
        out, a = [], 0
        for block, number, keys in zip(pdf["block"], pdf["shard"], rows):
            t = per[a : a + len(keys)]
            out.append((block, number, np.packbits(t >= least).tobytes(), encode_counts(t[t >= least])))
            a += len(keys)
        return pd.DataFrame(out, columns=["block", "shard", "held", "totals"])

    return sent.groupBy("shard").applyInPandas(shard, ANSWER)


def sizes(sent: DataFrame) -> DataFrame:
    """One row: ``n_keys`` (distinct keys with a count) and ``n_counts`` (sum of counts) over all shards."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, total = totals_by_key(pdf)
        return pd.DataFrame({"n_keys": [int((total > 0).sum())], "n_counts": [int(total.sum())]})

    per = sent.groupBy("shard").applyInPandas(shard, "n_keys long, n_counts long")
    return per.agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n_keys"), F.coalesce(F.sum("n_counts"), F.lit(0)).alias("n_counts"))


def answers(table: pa.Table, keys: np.ndarray, shards: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and totals of one block's answers; ``keys``: the sorted distinct keys that it sent."""
    known, total = marked(table, keys, shards, bits)
    return keys[known], total[known]


def marked(table: pa.Table, keys: np.ndarray, shards: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(held or not, total) of each of the sorted distinct keys that one block sent; 0 where it is not held."""
    at, known, total = edges(keys, shards, bits), np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    for s, held, totals in zip(table["shard"].to_pylist(), table["held"].to_pylist(), table["totals"].to_pylist()):
        flags = np.unpackbits(np.frombuffer(held, np.uint8), count=at[s + 1] - at[s]).astype(bool)
        known[at[s] : at[s + 1]] = flags
        total[at[s] : at[s + 1]][flags] = decode_counts(totals)
    return known, total


def find(keys: np.ndarray, totals: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Total of each wanted key; 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, totals[at], 0)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the place of each key among them."""
    order = np.argsort(keys)
    k = keys.take(order)
    new = np.ones(len(k), bool)
    np.not_equal(k[1:], k[:-1], out=new[1:])
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(new) - 1
    return k[new], place


def count_distinct(parts: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several (keys, counts) parts with the sums of their counts (None: 1 each)."""
    keys = np.concatenate([k for k, _ in parts] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([np.ones(len(k), np.int64) if c is None else c for k, c in parts] or [np.zeros(0, np.int64)])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    head = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[head], np.add.reduceat(counts[order], head)
