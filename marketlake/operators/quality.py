"""Data-quality checks.  Each gives rows (check, subject, observed, expected)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import date_of, fisher_z
from marketlake.operators.windows import newest, overlapping_ranges


def _finding(df: DataFrame, check: str, subject, observed, expected) -> DataFrame:
    return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"), observed.cast("string").alias("observed"), expected.cast("string").alias("expected"))


def misfiled_rows(tape: DataFrame) -> DataFrame:
    """Rows whose date of venue time, else receipt time, is not the partition they sit in."""
    want = date_of(F.coalesce("at_micros", "recv_micros")).cast("string")
    g = tape.withColumn("_w", want).where(F.col("_w") != F.col("date").cast("string")).groupBy("date", "_w").agg(F.count(F.lit(1)).alias("n"))
    return _finding(g, "partition", F.col("date"), F.col("n"), F.col("_w"))


def range_overlaps(inventory: DataFrame) -> DataFrame:
    o = overlapping_ranges(inventory)
    return _finding(o, "overlap", F.concat_ws("/", "partition", "venue", "file"), F.col("first"), F.col("prev_last"))


def nested_files(inventory: DataFrame) -> DataFrame:
    """Files whose range lies inside that of a file before them in order of (first, widest, name), within (partition, venue); ``wide``: the one of those that reaches furthest.

    One ordered pass over a partition's files; :func:`nested_rows` tells whether the wider file holds every row.
    """
    w = Window.partitionBy("partition", "venue").orderBy("first", F.desc("last"), "file").rowsBetween(Window.unboundedPreceding, -1)
    far = F.max(F.struct(F.col("last").alias("l"), F.struct("file").alias("f"))).over(w)
    return inventory.withColumn("_w", far).where(F.col("_w.l") >= F.col("last")).select("partition", "venue", "file", F.col("_w.f.file").alias("wide"))


def nested_rows(nested: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """Nested files (file, wide) with ``missing``: how many of their rows (``rows``: file and the columns of ``key``) the wider file does not hold; 0: an interrupted compaction left them."""
    own = nested.select("file", "wide").join(rows.select("file", *key), "file")
    held = rows.select(F.col("file").alias("wide"), *key).distinct().withColumn("_h", F.lit(1))
    return own.join(held, ["wide", *key], "left").groupBy("file", "wide").agg(F.count_if(F.col("_h").isNull()).alias("missing"))


def overfull(inventory: DataFrame, bound: int, k: int = 10) -> DataFrame:
    """The ``k`` partitions with the most files above the bound, worst first."""
    return inventory.groupBy("partition").agg(F.count(F.lit(1)).alias("files")).where(F.col("files") > bound).orderBy(F.desc("files"), "partition").limit(k)


def stale_venues(declared: DataFrame, record: DataFrame, now_us: int, within_us: int) -> DataFrame:
    last = record.groupBy("venue").agg(F.max("recv_micros").alias("last"))
    g = declared.join(last, "venue", "left").where(F.col("last").isNull() | (F.col("last") < now_us - within_us))
    return _finding(g, "stale", F.col("venue"), F.coalesce(F.col("last").cast("string"), F.lit("nothing captured")), F.lit(now_us - within_us))


def correlation_drift(targets: DataFrame, derived: DataFrame, bound: float) -> DataFrame:
    """Stored correlation targets whose Fisher z is over ``bound`` standard errors from the derived one."""
    both = targets.join(derived.select("i", "j", "rho", "n"), ["i", "j"]).where("n > 3")
    gap = F.abs(fisher_z(F.col("target")) - fisher_z(F.col("rho"))) * F.sqrt(F.col("n") - 3)
    return both.withColumn("gap", gap).where(F.col("gap") > bound)


def rejected_twice(signals: DataFrame, alpha: float) -> DataFrame:
    """Horizons whose two newest constancy p-values both reject."""
    two = newest(signals, ["horizon"], ["asof_micros"], 2)
    return two.groupBy("horizon").agg(F.max("value").alias("p"), F.count(F.lit(1)).alias("n")).where((F.col("n") == 2) & (F.col("p") < alpha))


def newest_alarm(signals: DataFrame) -> DataFrame:
    one = newest(signals.where("measure = 'alarm'"), ["horizon"], ["asof_micros"], 1)
    return one.where("value > 0").select("horizon", "asof_micros", F.get_json_object("params", "$.change_at").alias("change_at"))


def unparsed_share(unparsed: DataFrame, record: DataFrame) -> DataFrame:
    bad = unparsed.groupBy("channel").agg(F.count(F.lit(1)).alias("failed"))
    return record.groupBy("channel").agg(F.count(F.lit(1)).alias("rows")).join(bad, "channel", "left").select("channel", "rows", F.coalesce("failed", F.lit(0)).alias("failed"))


def changed_fingerprints(rows: DataFrame, declared: DataFrame) -> DataFrame:
    last = rows.groupBy("alias").agg(F.max_by("fingerprint", "t").alias("newest"))
    return declared.join(last, "alias", "left").where("newest IS NULL OR newest <> fingerprint")


def verdict(findings: DataFrame, checked_rows: int) -> str:
    """``nothing checked`` is not ``clean``."""
    return "nothing checked" if not checked_rows else "clean" if findings.isEmpty() else "findings"
