"""Exact de-duplication with a log-structured merge index.

Rows are dealt by their id to memtables.  A memtable is flushed as a run: one entry of (digest, id that
stays, rows that have this id, rows) for each digest, sorted by the digest, in a table of its own, with a
filter: bitmaps of the entries' hash positions, ``FILTER_BITS`` bits an entry.  The filters are probed
with the entries of all other runs.  Entries that no other run can hold are final; only hits are
compacted, which merges them by digest and keeps the smallest (or largest) identifier.  Digests that
have more than one row then receive byte verification: their rows' texts are grouped by the bytes
themselves, in each task before the shuffle, and a digest with two texts goes to an exact path.

Only DataFrame operations are used.  A hot group of copies is one entry for each run and one text for
each task after the first aggregation, and the joins back to the rows are plain equi-joins that Spark
splits when skewed.  Runs can be added to an index one after the other (:func:`flush`).

Defined results: null text counts as empty; rows with a null id belong to their group but are kept
only if no row of the group has an id; repeated ids share a group; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import columns, materialize, shared_dir, text_or_empty

#: Memtables of one call, and filter bits an entry.
MEMTABLES, FILTER_BITS = 4, 16
#: Bits of one bitmap, as Spark's bitmap functions have them.
_BITMAP = 32_768


def digest(text: Column, bits: int = 256) -> Column:
    """SHA-256 of the UTF-8 bytes, lower-case hex; fewer ``bits`` cut it (tests force false hits so)."""
    return F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, bits // 4)


def _best(keep: str, id_: str, ties: str) -> list[Column]:
    """Aggregates of an entry: the id that stays and the rows that have it."""
    order = (F.min if keep == "smallest" else F.max)(F.when(F.col(id_).isNotNull(), F.struct(F.col(id_).alias("id"))))
    return [order["id"].alias("keep_id"), F.max_by(ties, F.col(id_)).alias("ties") if keep == "largest" else F.min_by(ties, F.col(id_)).alias("ties")]


def memtable(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", bits: int = 256, memtables: int = 1) -> DataFrame:
    """Entries (run, digest, keep_id, ties, n); ``ties``: rows with the id that stays (null where no row has an id)."""
    rows = docs.select(F.col(doc_id).alias("id"), digest(text_or_empty(text), bits).alias("digest"), F.pmod(F.xxhash64(doc_id), F.lit(memtables)).cast("int").alias("run"))
    one = rows.groupBy("run", "digest", "id").agg(F.count(F.lit(1)).alias("c"))
    return one.groupBy("run", "digest").agg(*_best(keep, "id", "c"), F.sum("c").alias("n"))


def flush(mem: DataFrame, path: str) -> DataFrame:
    """Add the entries' runs to the index at ``path``, each sorted by digest in a folder of its own; returns all runs."""
    runs = mem.select("digest", "keep_id", "ties", "n", F.concat(F.lit(f"{uuid.uuid4().hex}-"), F.col("run").cast("string")).alias("run"))
    runs.repartition("run", F.substring("digest", 1, 2)).sortWithinPartitions("run", "digest").write.mode("append").option("compression", "zstd").partitionBy("run").parquet(path)
    return mem.sparkSession.read.schema(runs.schema).parquet(path)


def filters(runs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, bitmaps): for each bucket of hash positions the bitmaps of all runs, as array<struct<run, bits>>."""
    at = F.pmod(F.xxhash64("digest"), F.lit(buckets * _BITMAP)) + 1
    one = runs.groupBy("run", F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    return one.groupBy("bucket").agg(F.collect_list(F.struct("run", "bits")).alias("bitmaps"))  # as many as there are runs


def probe(runs: DataFrame) -> DataFrame:
    """``runs`` with ``hit``: whether the filter of another run may hold the entry's digest."""
    buckets = max(1, -(-runs.count() * FILTER_BITS // _BITMAP))
    at = F.pmod(F.xxhash64("digest"), F.lit(buckets * _BITMAP)) + 1
    place = F.bitmap_bit_position(at)
    byte = lambda b: F.conv(F.hex(F.substring(b, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = lambda m: (m["run"] != F.col("run")) & (F.getbit(byte(m["bits"]), (place % 8).cast("int")) == 1)
    probed = runs.withColumn("bucket", F.bitmap_bucket_number(at)).join(filters(runs, buckets), "bucket")
    return probed.withColumn("hit", F.exists("bitmaps", held)).drop("bucket", "bitmaps")


def compact(runs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Merge runs: one entry (digest, keep_id, ties, n) for each digest; only entries that another run may hold are shuffled."""
    probed = probe(runs)
    best = (F.min if keep == "smallest" else F.max)("keep_id").alias("keep_id")
    hits = probed.where("hit")
    top = hits.groupBy("digest").agg(best, F.sum("n").alias("n"))
    ties = hits.where("keep_id IS NOT NULL").groupBy("digest", "keep_id").agg(F.sum("ties").alias("ties"))
    merged = top.join(ties, ["digest", "keep_id"], "left").select("digest", "keep_id", "ties", "n")
    return probed.where("NOT hit").select("digest", "keep_id", "ties", "n").unionByName(merged)


def index(docs: DataFrame, keep: str, doc_id: str, text: str, bits: int) -> tuple[DataFrame, DataFrame | None]:
    """(entries of the compacted index without false hits, texts of digests that false hits share: (text, keep_id, n), or None)."""
    path = f"{shared_dir(docs.sparkSession)}/lsm-{uuid.uuid4().hex}"
    runs = flush(memtable(docs, doc_id, text, keep, bits, MEMTABLES), path)
    entries = materialize(compact(runs, keep), "lsm-index")
    # byte verification of digests with several rows
    several = entries.where("n > 1").select("digest")
    rows = docs.select(F.col(doc_id).alias("id"), text_or_empty(text).alias("text")).withColumn("digest", digest(F.col("text"), bits))
    best = (F.min if keep == "smallest" else F.max)("id").alias("keep_id")
    texts = rows.join(several, "digest", "left_semi").groupBy("digest", "text").agg(best, F.count(F.lit(1)).alias("n"))
    false_hits = materialize(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "lsm-false-hits")
    if false_hits.isEmpty():
        return entries, None
    return entries.join(false_hits, "digest", "left_anti"), texts.join(false_hits, "digest", "left_semi").drop("digest")


def exact_dedup(docs: DataFrame, keep: str = "smallest", doc_id: str = "doc_id", text: str = "text", bits: int = 256) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` says whether the ``smallest`` or the ``largest`` id of a group stays.  With repeated
    ids every row that has the id that stays is kept.
    """
    entries, told = index(docs, keep, doc_id, text, bits)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).withColumn("text_sha256", digest(F.col("text")))
    rows = rows.withColumn("digest", F.substring("text_sha256", 1, bits // 4))
    out = ["doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    sure = rows.drop("text").join(entries, "digest").select(*out)
    return sure if told is None else sure.unionByName(rows.join(told, "text").select(*out))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs``, with all its columns, for each distinct text: the one with the smallest id, by the same index.

    Null and empty texts are one text (it stays as it is in the row that stays).  Ties of ids are
    settled by the other columns; only rows that tie are shuffled with their texts.
    """
    entries, told = index(docs, "smallest", doc_id, text, 256)
    every = columns(docs)
    rows = docs.select(F.struct(*every).alias("row"), F.col(doc_id).alias("id"), digest(text_or_empty(text)).alias("digest"))
    if told is not None:
        entries = entries.unionByName(told.select(digest(F.col("text")).alias("digest"), "keep_id", F.lit(2).cast("long").alias("ties"), "n"))
    mine = rows.join(entries, "digest").where(F.col("id").eqNullSafe(F.col("keep_id")))
    sole = (F.col("n") == 1) | (F.coalesce("ties", F.lit(2)) == 1)
    rest = [F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (doc_id, text)]
    order = F.struct(F.col("row").getField(text).isNull().alias("none"), *rest)
    tied = mine.where(~sole).withColumn("text", text_or_empty_of("row", text)).groupBy("digest", "text").agg(F.min_by("row", order).alias("row"))
    return mine.where(sole).select("row.*").unionByName(tied.select("row.*"))


def text_or_empty_of(row: str, text: str) -> Column:
    return F.coalesce(F.col(row).getField(text).cast("string"), F.lit(""))
