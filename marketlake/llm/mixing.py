"""Mixing sources to target weights with hash-threshold histograms.

Each document has a hash.  A source takes every document whose hash is under its threshold, so a
smaller budget takes a subset of what a larger one takes, and nothing is sorted.  The threshold is
found by histograms: sizes are summed by (source, hash bucket), the bucket in which the budget ends
is found, and only that bucket's documents are summed again by the next bits of the hash.

Shares: sources weigh 1, 2, 3, 1, ... in the order of their names (nulls last) and share the total
size.  A source whose share exceeds ``max_epochs`` times its size gets that much; the excess is
reshared by weight.  A target over the source's size takes all documents whole times and the rest by
threshold, so no document is taken more than ``max_epochs`` times.

Only DataFrame operations are used; what is joined to the documents is one row for each source.

Defined results: null or empty text has size 0 and is taken 0 times; null source is a source of its
own, last; a source without words has target 0; rows with the same id are taken together; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import columns, materialize, n_words, text_or_empty

#: Bits of the hash, and of one histogram.  Four histograms tell apart 2^48 hashes.
HASH_BITS, STEP_BITS = 48, 12
#: Sources up to which their one row each is broadcast; beyond it Spark joins by shuffling.
BROADCAST_SOURCES = 10_000


def doc_hash(doc_id: Column) -> Column:
    """48 bits of the MD5 of the id as text (any SQL engine has it)."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, has_source, source_size) -> with ``target``: shares by weight, cut at ``max_epochs`` times the size.

    The common level x (target = min(cap, x * weight)) is found by ordering sources by cap / weight.
    The windows run over one row for each source.
    """
    by_name = Window.orderBy(F.desc("has_source"), "source")
    w = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.desc("has_source"), "source").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("x", left / weight_left)
    # the first source, in order of cap / weight, that stays under its cap sets the level for all after it
    w = w.withColumn("level", F.min(F.when(F.col("x") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("at"), F.col("x").alias("x")))).over(every))
    return w.withColumn("target", F.least("cap", F.coalesce(F.col("level.x") * F.col("weight"), F.col("cap")))).select("source", "has_source", "source_size", "target")


def _keyed(docs: DataFrame, doc_id: str, source: str) -> list[Column]:
    return [
        F.col(source).isNotNull().alias("has_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        doc_hash(F.col(doc_id)).alias("h"),
    ]


def _near(plan: DataFrame) -> DataFrame:
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def _times(max_epochs: int) -> Column:
    return (F.col("whole") + F.when((F.col("h") < F.col("at")) & (F.col("whole") < max_epochs), F.lit(1)).otherwise(F.lit(0))).cast("long")


def thresholds(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """For rows (source, has_source, size, h): each source's ``source_size, target, whole`` times and hash threshold ``at``."""
    sums = rows.groupBy("source", "has_source").agg(F.sum("size").alias("source_size"))
    plan = targets(sums, weights, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    # documents with h < at are taken; left: what the budget still has at hash ``at``
    plan = plan.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("at", F.lit(0).cast("long"))
    plan = materialize(plan, "mix-plan")
    small = plan.count() <= BROADCAST_SOURCES
    near = F.broadcast if small else lambda p: p
    key = ["source", "has_source"]
    for width in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = rows if width == HASH_BITS - STEP_BITS else rows.join(near(plan.select(*key, "at")), key).where(F.shiftright("h", width + STEP_BITS) == F.shiftright("at", width + STEP_BITS)).drop("at")
        bucket = inside.groupBy(*key, F.shiftright("h", width).alias("b")).agg(F.sum("size").alias("s"))
        running = F.sum("s").over(Window.partitionBy(*key).orderBy("b"))
        found = bucket.withColumn("upto", running).join(near(plan.select(*key, "left")), key)
        # the last bucket decides whole: it goes in if that brings the sum nearer to the budget
        over = F.col("upto") - F.col("left")
        stays_out = over > (F.col("left") - (F.col("upto") - F.col("s")) if width == 0 else F.lit(0.0))
        first_out = found.where(stays_out).groupBy(*key).agg(F.min(F.struct("b", (F.col("upto") - F.col("s")).alias("before"))).alias("f"))
        full = F.lit(1 << HASH_BITS).cast("long")
        after = plan.join(near(first_out), key, "left")
        ended = F.col("at") >= full
        nxt = F.when(ended, F.col("at")).when(F.col("f").isNull(), F.lit(None)).otherwise(F.shiftleft(F.col("f.b"), width))
        # without such a bucket everything up to the end of the bucket before is taken
        span = F.lit(1 << (width + STEP_BITS)).cast("long")
        nxt = F.coalesce(nxt, F.shiftleft(F.shiftright("at", width + STEP_BITS), width + STEP_BITS) + span)
        plan = after.select(*key, "source_size", "target", "whole", (F.col("left") - F.coalesce(F.col("f.before"), F.lit(0))).alias("left"), nxt.alias("at"))
        plan = materialize(plan, "mix-plan")
    return plan


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, times, taken``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), n_words(text_or_empty(text)).alias("size"), *_keyed(docs, doc_id, source))
    rows = materialize(rows, "mix-sizes")
    plan = thresholds(rows, weights, max_epochs)
    out = rows.join(_near(plan), ["source", "has_source"]).withColumn("times", _times(max_epochs))
    return out.select("doc_id", F.when(F.col("has_source"), F.col("source")).alias("source"), "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them."""
    sized = docs.select(n_words(text_or_empty(text)).alias("size"), *_keyed(docs, doc_id, source))
    plan = thresholds(materialize(sized, "mix-sizes"), weights, max_epochs)
    row = F.struct(*columns(docs)).alias("row")
    taken = docs.select(row, *_keyed(docs, doc_id, source)).join(_near(plan), ["source", "has_source"])
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), _times(max_epochs).cast("int")))).select("row.*")
