"""Files of the record: inventory from footers, retention, and compaction that swaps its result in.

A compaction stages new files beside the data, proves that they hold the same rows, writes a marker that names
every file to move and to remove, and only then touches the data.  :func:`recover` ends what a crash left: with a
marker the swap is finished, without one the staged files go.  Between a move and its removals a reader may
see rows twice, never too few.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000
PARTS = ("venue", "kind", "date")
STAGED, MARKER = "_staged", "_swap"


def _fs(spark: SparkSession, at: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` (``file``, ``path``, ``bytes``) with the partition its folders name; ``recognised``: a Parquet file in venue, kind and date."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = files.select(F.col("_metadata.file_path").alias("file"), "path", F.col("_metadata.file_size").alias("bytes"))
    part = lambda name: F.regexp_extract("file", f"/{name}=([^/]+)/", 1)
    files = files.withColumns({"venue": part("venue"), "kind": part("kind"), "date": F.try_to_timestamp(part("date"), F.lit("yyyy-MM-dd")).cast("date")})
    ok = F.col("file").rlike(r"/venue=[^/]+/kind=[^/]+/date=\d{4}-\d{2}-\d{2}/[^/]+\.parquet$") & F.col("date").isNotNull()
    return files.withColumn("recognised", ok).withColumn("partition", F.when(ok, F.concat_ws("/", "venue", "kind", F.col("date").cast("string"))))


def inventory(spark: SparkSession, root: str, seq: str = "seq", recv: str = "recv_micros") -> DataFrame:
    """Recognised files with rows and ranges of sequence and receipt from their Parquet footers, read in tasks; no row is read.

    For stores that only Spark reads, :func:`inventory_by_rows` gives the same.
    """
    files = listing(spark, root).where("recognised")
    schema = "file string, path string, bytes long, venue string, kind string, date date, recognised boolean, partition string, n_rows long, first long, last long, recv_first long, recv_last long"

    def stats(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for part in parts:
            found = []
            for path in part["path"]:
                fs, at = (pafs.LocalFileSystem(), path.removeprefix("file:").replace("//", "/")) if path.startswith("file:") else pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    meta = pq.ParquetFile(f).metadata
                names = [meta.schema.column(k).path for k in range(meta.num_columns)]
                row = [meta.num_rows]
                for c in (seq, recv):
                    k = names.index(c)
                    of = [s for g in range(meta.num_row_groups) if (s := meta.row_group(g).column(k).statistics) is not None and s.has_min_max]
                    row += [min((s.min for s in of), default=None), max((s.max for s in of), default=None)]
                found.append(row)
            out = part.reset_index(drop=True)
            for k, c in enumerate(("n_rows", "first", "last", "recv_first", "recv_last")):
                out[c] = pd.array([r[k] for r in found], dtype="Int64")
            yield out

    return files.mapInPandas(stats, schema)


def inventory_by_rows(spark: SparkSession, root: str, seq: str = "seq", recv: str = "recv_micros") -> DataFrame:
    """:func:`inventory` by reading the two columns."""
    df = spark.read.parquet(root).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(seq).alias("first"), F.max(seq).alias("last"), F.min(recv).alias("recv_first"), F.max(recv).alias("recv_last"))
    return listing(spark, root).where("recognised").join(df, "file")


def retention(files: DataFrame, days: dict[str, int], now_us: int, family: str = "venue") -> DataFrame:
    """Partitions (and unrecognised files) with bytes, files and a verdict, from :func:`listing`: a day goes when its end is past its family's declared horizon.

    ``family``: the column that horizons are declared for (the record's venues, the tape's kinds).  ``expired``, ``kept``, ``never`` (signals),
    ``undeclared`` (no horizon), or ``unrecognised``: reported, never chosen.
    """
    keep = F.try_element_at(F.create_map(*[F.lit(x) for kv in days.items() for x in kv]), F.col(family)) if days else F.lit(None).cast("int")
    end = (F.datediff("date", F.lit("1970-01-01").cast("date")) + 1).cast("long") * DAY_US
    known = lambda c: F.when(F.col("recognised"), F.col(c)).alias(c)
    g = files.select(F.coalesce("partition", "file").alias("subject"), *[known(c) for c in PARTS], "recognised", "bytes")
    g = g.groupBy("subject", *PARTS, "recognised").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
    verdict = F.when(~F.col("recognised"), "unrecognised").when(F.col("kind") == "signals", "never").when(keep.isNull(), "undeclared").when(end <= F.lit(now_us) - keep.cast("long") * DAY_US, "expired").otherwise("kept")
    return g.withColumn("verdict", verdict).drop("recognised")


def closed_day_sets(files: DataFrame, today: str, target_rows: int) -> DataFrame:
    """Files of days before today as sets, one a partition, where fewer files of ``target_rows`` would do."""
    return _crowded(files.where(F.col("date") < F.lit(today).cast("date")).withColumn("_set", F.lit(0).cast("long")), target_rows)


def closed_hour_sets(files: DataFrame, today: str, cutoff_us: int, target_rows: int) -> DataFrame:
    """Files of today whose last receipt is before the cutoff, as sets by the hour of it."""
    rows = files.where((F.col("date") == F.lit(today).cast("date")) & (F.col("recv_last") < cutoff_us))
    return _crowded(rows.withColumn("_set", F.floor(F.col("recv_last") / HOUR_US)), target_rows)


def _crowded(rows: DataFrame, target_rows: int) -> DataFrame:
    g = rows.groupBy("partition", "_set").agg(F.ceil(F.sum("n_rows") / target_rows).alias("_files"), F.count(F.lit(1)).alias("_now")).where(F.col("_now") > F.greatest("_files", F.lit(1)))
    return rows.join(g.drop("_now"), ["partition", "_set"]).select("file", "path", "partition", "_set", "_files")


def _proof(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Count and two order-free sums over the rows of each (partition, set)."""
    h = F.xxhash64(*[F.col(c) for c in columns])
    return rows.groupBy(*PARTS, "_set").agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(h, F.lit(1))).alias("x"))


def compact(spark: SparkSession, root: str, sets: DataFrame, stop: Callable[[str], None] | None = None) -> dict[str, int]:
    """Rewrite each set of files into its number of files, in place.  ``stop``: called before each step of the swap (tests break it there)."""
    recover(spark, root)
    listed = [r.asDict() for r in sets.collect()]  # one row a file that will be replaced
    if not listed:
        return {"files_before": 0, "files_after": 0}
    which = spark.createDataFrame([(r["file"], r["_set"], int(max(r["_files"], 1))) for r in listed], "_file string, _set long, _files long")
    df = spark.read.option("basePath", root).parquet(*[r["path"] for r in listed])
    columns = df.columns
    dealt = df.withColumn("_file", F.col("_metadata.file_path")).join(which, "_file").withColumn("_f", F.pmod(F.xxhash64("seq"), F.col("_files")))
    work = f"{root}/{STAGED}/{uuid.uuid4().hex}"
    out = dealt.repartition(*PARTS, "_set", "_f").sortWithinPartitions(*PARTS, "_set", "recv_micros", "seq").select(*columns, "_set", "_f")
    out.write.option("compression", "zstd").partitionBy(*PARTS, "_set", "_f").parquet(work)
    made = spark.read.schema(out.schema).parquet(work)
    a, b = _proof(dealt, columns), _proof(made, columns)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "s", "x")]
    wrong = a.alias("a").join(b.alias("b"), [*PARTS, "_set"], "full").where(~(same[0] & same[1] & same[2])).count()
    if wrong:
        recover(spark, root)
        raise RuntimeError(f"compaction changed the rows of {wrong} sets; nothing was swapped")
    moves = []
    for k, r in enumerate(listing(spark, work).select("path").collect()):  # one row a new file
        inside = r["path"].split(f"/{STAGED}/", 1)[1].split("/", 1)[1].split("/_set=", 1)[0]
        moves.append([r["path"], f"{root}/{inside}/part-{k:05d}-{work[-32:]}.zstd.parquet"])
    _mark(spark, root, {"work": work, "moves": moves, "remove": [r["path"] for r in listed]}, stop)
    recover(spark, root, stop)
    return {"files_before": len(listed), "files_after": len(moves)}


def _mark(spark: SparkSession, root: str, plan: dict, stop: Callable[[str], None] | None) -> None:
    """The marker appears whole, by a rename."""
    fs, path = _fs(spark, root)
    draft, final = path(f"{root}/{MARKER}/draft"), path(f"{root}/{MARKER}/marker.json")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(plan).encode()))
    stream.close()
    if stop:
        stop("marker")
    if not fs.rename(draft, final):
        raise RuntimeError("the swap's marker could not be written")


def recover(spark: SparkSession, root: str, stop: Callable[[str], None] | None = None) -> str:
    """End an interrupted compaction: ``finished`` a marked swap, ``undone`` an unmarked one, or ``clean``."""
    fs, path = _fs(spark, root)
    marker, staged = path(f"{root}/{MARKER}/marker.json"), path(f"{root}/{STAGED}")
    marked, left = fs.exists(marker), fs.exists(staged)
    if marked:
        stream = fs.open(marker)
        plan = json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        stream.close()
        for source, target in plan["moves"]:
            if stop:
                stop(f"move {target}")
            if fs.exists(path(source)) and not fs.rename(path(source), path(target)):
                raise RuntimeError(f"could not move {source}")
        for old in plan["remove"]:
            if stop:
                stop(f"remove {old}")
            fs.delete(path(old), False)
    if left:
        fs.delete(staged, True)
    if fs.exists(path(f"{root}/{MARKER}")):
        fs.delete(path(f"{root}/{MARKER}"), True)
    return "finished" if marked else "undone" if left else "clean"


def compact_closed_days(spark: SparkSession, root: str, today: str, target_rows: int = 1_000_000) -> dict[str, int]:
    """Closed days in place; today is left alone."""
    recover(spark, root)
    return compact(spark, root, closed_day_sets(inventory(spark, root), today, target_rows))


def compact_closed_hours(spark: SparkSession, root: str, today: str, cutoff_us: int, target_rows: int = 1_000_000) -> dict[str, int]:
    """Today's hours that ended before the cutoff, in place."""
    recover(spark, root)
    return compact(spark, root, closed_hour_sets(inventory(spark, root), today, cutoff_us, target_rows))
