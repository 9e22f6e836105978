"""Reading and writing the record, the tape, signals and the ledger; inventory and maintenance."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.scalars import date_of
from marketlake.operators.filters import apply_bound, in_scope, in_window

SIGNAL_COLUMNS = ("signal", "horizon", "measure", "ticker_i", "ticker_j", "value", "absent", "n_eff", "asof_micros", "computed_micros", "run_id", "params")


def _date(us: int) -> str:
    import datetime as dt

    return (dt.date(1970, 1, 1) + dt.timedelta(days=us // 86_400_000_000)).isoformat()


def write_record(df: DataFrame, root: str) -> None:
    """By venue, kind and receipt date; one file for each partition and task that has its rows."""
    out = df.withColumn("date", date_of(F.col("recv_micros")))
    out.repartition("venue", "kind", "date", F.pmod(F.xxhash64("seq"), F.lit(8))).sortWithinPartitions("recv_micros", "seq").write.mode("append").option("compression", "zstd").partitionBy("venue", "kind", "date").parquet(root)


def read_record(spark: SparkSession, root: str, scopes: list[str] | None, from_us: int, to_us: int, ordered: bool = False) -> DataFrame:
    """Payloads received in [from, to), failures left out; partition dates are pruned with the same bounds."""
    df = spark.read.parquet(root).where(F.col("kind") != "failures").where((F.col("date") >= F.lit(_date(from_us)).cast("date")) & (F.col("date") <= F.lit(_date(to_us)).cast("date")))
    df = in_scope(df.where((F.col("recv_micros") >= from_us) & (F.col("recv_micros") < to_us)), scopes)
    return df.orderBy("recv_micros", "seq") if ordered else df


def write_tape(df: DataFrame, root: str, kind: str, mode: str = "append") -> None:
    """By date of venue time, else of receipt; files ordered by ticker, time, sequence."""
    out = df.withColumn("date", date_of(F.coalesce("at_micros", "recv_micros")))
    out.repartition("date", "ticker").sortWithinPartitions("date", "ticker", "at_micros", "seq").write.mode(mode).option("compression", "zstd").partitionBy("date").parquet(f"{root}/kind={kind}")


def read_tape(spark: SparkSession, root: str, kind: str, from_us: int, to_us: int, ticker: str | None = None, bound: DataFrame | None = None) -> DataFrame:
    df = spark.read.parquet(f"{root}/kind={kind}")
    df = df.where((F.col("date") >= F.lit(_date(from_us)).cast("date")) & (F.col("date") <= F.lit(_date(to_us)).cast("date")))
    df = in_window(df, from_us, to_us, ticker)
    return df if bound is None else apply_bound(df, bound)


def replace_source_days(df: DataFrame, root: str, venue: str, from_day: str, to_day: str) -> None:
    """Rewrite only this venue's rows received on whole days [from_day, to_day): partitions by source venue, source day and date.

    Partitions of those days that are no longer produced are removed.
    """
    spark = df.sparkSession
    src = df.withColumn("source_venue", F.lit(venue)).withColumn("source_day", date_of(F.col("recv_micros")).cast("string")).withColumn("date", date_of(F.coalesce("at_micros", "recv_micros")).cast("string"))
    if not src.where((F.col("source_day") < from_day) | (F.col("source_day") >= to_day)).isEmpty():
        raise ValueError("rows were received outside the days to replace")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old = jvm.org.apache.hadoop.fs.Path(f"{root}/source_venue={venue}")
    fs = old.getFileSystem(conf)
    had = {s.getPath().getName() for s in fs.listStatus(old)} if fs.exists(old) else set()
    spread = F.pmod(F.xxhash64("seq"), F.lit(4))
    src.repartition("source_day", "date", spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_venue", "source_day", "date").parquet(root)
    made = {(r["source_day"], r["date"]) for r in src.select("source_day", "date").distinct().collect()}  # one row a partition
    for day in had:
        name = day.removeprefix("source_day=")
        if from_day <= name < to_day:
            for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/source_venue={venue}/{day}")):
                if (name, s.getPath().getName().removeprefix("date=")) not in made:
                    fs.delete(s.getPath(), True)


def commit_signals(df: DataFrame, root: str) -> int:
    """Append one run's rows after checks: the columns, value or reason but not both, one run; returns their number."""
    if tuple(df.columns) != SIGNAL_COLUMNS:
        raise ValueError(f"columns are {df.columns}")
    bad = F.count_if(F.col("value").isNull() == F.col("absent").isNull())
    nan = F.count_if(F.isnan("value"))
    r = df.agg(bad.alias("bad"), nan.alias("nan"), F.count_distinct("run_id").alias("runs"), F.count(F.lit(1)).alias("n")).first()
    if r["bad"] or r["nan"] or r["runs"] > 1:
        raise ValueError(f"{r['bad']} rows with both or neither of value and reason, {r['nan']} not finite, {r['runs']} runs")
    df.withColumn("date", date_of(F.col("asof_micros"))).repartition("date").write.mode("append").partitionBy("date").parquet(root)
    return r["n"]


def read_signals(spark: SparkSession, root: str, lo_us: int, hi_us: int) -> DataFrame:
    df = spark.read.parquet(root).where((F.col("date") >= F.lit(_date(lo_us)).cast("date")) & (F.col("date") <= F.lit(_date(hi_us)).cast("date")))
    return df.where((F.col("asof_micros") >= lo_us) & (F.col("asof_micros") < hi_us)).drop("date")


def write_ledger(kinds: dict[str, DataFrame], root: str) -> None:
    """One table a kind, rewritten whole; effects one row each."""
    for kind, df in kinds.items():
        if "effects" in df.columns:
            df = df.withColumn("effect", F.explode_outer("effects")).drop("effects")
        df.repartition("venue", "account").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("venue", "account").parquet(f"{root}/{kind}")


MANIFEST = "venue string, pages array<struct<file:string,sha256:string,request:struct<type:string,req:struct<coin:string,interval:string>>>>"


def import_verified(spark: SparkSession, folder: str, venue: str, recv_micros: int, first_seq: int = 0) -> DataFrame:
    """The rescued pages of a manifest as record rows, or none of them.

    ``manifest.json``: venue, pages (file, sha256, request).  Another venue, no pages, a request that is no candle page, a
    name that is a path, a missing file or other bytes than the digest says refuse the whole import; files that it does not
    list are left alone.  Pages are read once for their digests and again for their rows, never on the driver.
    """
    manifest = spark.read.schema(MANIFEST).option("multiLine", True).json(f"{folder}/manifest.json")
    stated = [r["venue"] for r in manifest.select("venue").take(2)]
    if stated != [venue]:
        raise ValueError(f"refused: the manifest is of venue {stated}, not {venue}")
    pages = manifest.select(F.posexplode("pages").alias("pos", "p")).select("pos", F.col("p.file").alias("file"), F.lower("p.sha256").alias("sha256"), F.col("p.request.type").alias("type"), F.col("p.request.req.coin").alias("symbol"), F.col("p.request.req.interval").alias("interval"))
    if pages.isEmpty():
        raise ValueError("refused: the manifest has no pages")
    files = spark.read.format("binaryFile").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("found"), F.col("content").cast("string").alias("payload"))
    both = pages.join(files, "file", "left")
    name = F.coalesce(F.col("file").rlike(r"^[^./\\][^/\\]*$"), F.lit(False))
    why = F.when(~name, "a page is named inside the folder, never by a path").when(~F.col("type").eqNullSafe(F.lit("candleSnapshot")) | F.col("symbol").isNull(), "not a candle page").when(F.col("found").isNull(), "missing").when(~F.col("found").eqNullSafe(F.col("sha256")), "other bytes than the manifest states")
    wrong = both.select("file", why.alias("why")).where("why IS NOT NULL").orderBy("file").limit(10).collect()
    if wrong:
        raise ValueError(f"refused: {json.dumps({str(r['file']): r['why'] for r in wrong})}")
    return both.select((F.lit(first_seq) + F.col("pos")).cast("long").alias("seq"), F.lit(recv_micros).cast("long").alias("recv_micros"), F.lit(venue).alias("venue"), F.lit("candles").alias("kind"), F.lit("candleSnapshot").alias("channel"), "symbol", F.lit("fetched").alias("origin"), "payload")
