"""Best-fit packing by exact-complement hashing.

Documents become pieces of at most ``room`` tokens.  Packing needs only how many pieces have each
length, which is at most ``room`` numbers whatever the corpus is.  On these counts: take the longest
length left, look its gap up in the index (:class:`Sums`) of single lengths, then of sums of two, then of three, and
consume the combination as often as its counts allow; lengths that nothing completes are placed
best-fit, longest first, into the smallest gap that takes them.  Every step uses up a length (or a
kind of open sequence), so the plan is short.  Pieces then find their place by their rank among the
pieces of their length: ranks come from counts by (partition, length), so no length, however common,
meets in one task.

Defined results: null text is empty and becomes its end token alone; repeated rows are packed each;
rows with a null id are packed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import materialize
from marketlake.llm.tokens import ids_of

class Sums:
    """Index of the available lengths by sums of one, two and three of them.

    For a sum, the pairs (larger part first) and triples that gave it when it was first asked for are
    listed; a cursor passes those that are used up.  Counts only fall, so a combination that was passed
    never comes back and each is looked at once.
    """

    def __init__(self, have: np.ndarray):
        self.have = have
        self.pairs: dict[int, tuple[list[int], int]] = {}
        self.triples: dict[int, tuple[list[int], int]] = {}

    def _first(self, table: dict, total: int, parts, fits):
        """First listed part that still ``fits``; what is before it is passed for good."""
        listed, at = table.get(total) or (parts(), 0)
        while at < len(listed):
            if (found := fits(listed[at])) is not None:
                break
            at += 1
        table[total] = (listed, at)
        return found if at < len(listed) else None

    def pair(self, total: int) -> tuple[int, ...] | None:
        have = self.have

        def parts() -> list[int]:
            a = np.arange(total - 1, (total - 1) // 2, -1)
            return a[(have[a] > 0) & (have[total - a] > 0)].tolist()

        def fits(a: int) -> tuple[int, int] | None:
            b = total - a
            return (a, b) if have[a] > (a == b) and have[b] > 0 else None

        return self._first(self.pairs, total, parts, fits)

    def triple(self, total: int) -> tuple[int, ...] | None:
        have = self.have

        def parts() -> list[int]:
            c = np.arange(total - 2, 0, -1)
            return c[have[c] > 0].tolist()

        def fits(c: int) -> tuple[int, ...] | None:
            if not have[c]:
                return None
            left = self.pair(total - c)
            if left is None or have[c] > left.count(c):
                return None if left is None else (c, *left)
            # the pair found needs the last piece of this length itself: look at the others of its sum
            for a in self.pairs[total - c][0]:
                b = total - c - a
                if c not in (a, b) and have[a] > (a == b) and have[b] > 0:
                    return (c, a, b)
            return None

        return self._first(self.triples, total, parts, fits)

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """Available lengths that add up to ``gap``: one, two or three of them."""
        if gap == 0:
            return ()
        if self.have[gap] > 0:
            return (gap,)
        return self.pair(gap) or self.triple(gap)


def plan(counts: dict[int, int], room: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences) for the given numbers of pieces by length."""
    have = np.zeros(room + 1, np.int64)
    for n, c in counts.items():
        have[n] = c
    index = Sums(have)
    out: list[tuple[tuple[int, ...], int]] = []
    rest: list[tuple[int, int]] = []
    for n in range(room, 0, -1):
        while have[n]:
            have[n] -= 1
            combo = index.complement(room - n)
            have[n] += 1
            if combo is None:
                rest.append((n, int(have[n])))
                have[n] = 0
                break
            lengths = (n, *combo)
            need = defaultdict(int)
            for x in lengths:
                need[x] += 1
            times = min(int(have[x]) // k for x, k in need.items())
            for x, k in need.items():
                have[x] -= times * k
            out.append((lengths, times))
    # best fit of what is left, longest first: kinds of open sequences by the gap they have
    open_: dict[int, list[list]] = defaultdict(list)
    for n, c in rest:
        while c:
            gap = next((g for g in range(n, room + 1) if open_.get(g)), None)
            if gap is None:
                fit = room // n
                if c >= fit:
                    open_[room - fit * n].append([(n,) * fit, c // fit])
                    c -= c // fit * fit
                else:
                    open_[room - c * n].append([(n,) * c, 1])
                    c = 0
                continue
            kind = open_[gap][-1]
            fit = gap // n
            if c >= fit:
                take, k = min(kind[1], c // fit), fit
            else:
                take, k = 1, c
            kind[1] -= take
            if not kind[1]:
                open_[gap].pop()
            open_[gap - k * n].append([kind[0] + (n,) * k, take])
            c -= take * k
    return out + [(tuple(x), t) for kinds in open_.values() for x, t in kinds]


def slots(steps: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Ranks of each length to places: (length, first rank, first sequence, offset), by length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for lengths, times in steps:
        at = 0
        for n in lengths:
            rows.append((n, used[n], base, at))
            used[n] += times
            at += n
        base += times
    return pd.DataFrame(rows, columns=["length", "rank", "base", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def cut(docs: DataFrame, path: str, room: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Pieces of each document: ``doc_id, piece, start, length, ids_crc32``."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i in range(b.num_rows):
                packed = ids.packed(b[1][i].as_py() or "") + end
                n = len(packed) // 4
                a, k = 0, 0
                while a < n:
                    z = min(n, a + (room if n <= room or k or n % room == 0 else n % room))
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(packed[4 * a : 4 * z]))
                    a, k = z, k + 1
            yield pa.RecordBatch.from_arrays(
                [b[0].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(pieces, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, room: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    got = materialize(cut(docs, path, room, end_id, doc_id, text).withColumn("part", F.spark_partition_id()), "pieces")
    per = materialize(got.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``room`` rows
    where = slots(plan(counts, room))
    key = where["length"].to_numpy(np.int64) << 40 | where["rank"].to_numpy(np.int64) if len(where) else np.zeros(0, np.int64)
    rank0, base, offset = (where[c].to_numpy(np.int64) for c in ("rank", "base", "offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, n << 40 | rank, "right") - 1
            seq = base[at] + rank - rank0[at]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")], pa.array(seq, pa.int64()), pa.array(offset[at], pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = got.withColumn("own", F.row_number().over(own) - 1).join(per, ["part", "length"])
    ranked = ranked.withColumn("rank", (F.col("own") + F.col("before")).cast("long"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, got.drop("part").schema.add("sequence_id", "long").add("offset", "long"))
