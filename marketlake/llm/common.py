"""Scratch tables in the shared folder, table access and small column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every contract: space and U+0009..U+000D.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    A temporary folder stands in only where all tasks run in this process; a cluster without the setting is refused.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if at is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        sc.setCheckpointDir(at)
    return at


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts lineage: executors that are lost later cost a re-read, not a recomputation.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(by) if by else w).parquet(at)
    return spark.read.schema(df.schema).parquet(at) if not by else spark.read.parquet(at)


class Scratch:
    """Tables that only one computation reads: ``with Scratch(spark) as s: s.table(df, label)``; removed when the block ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.at = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.n = 0

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame, label: str) -> DataFrame:
        self.n += 1
        at = f"{self.at}/{self.n}-{label}"
        df.write.option("compression", "zstd").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def __exit__(self, *error: object) -> None:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def blocks(df: DataFrame, text: str, target: int = 8 << 20) -> int:
    """Number of blocks for work by block, so it grows with the table without an end.

    From the optimizer's size estimate; where it has none (it says 2^63 - 1 then, or products of that), from the summed lengths of the column.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 56:
        size = df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(12, min((1 << 31) - 1, size // target + 1))


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a non-null text (long), in one pass over it."""
    return F.regexp_count(text, F.lit(rf"[^{SPACE}]++")).cast("long")
