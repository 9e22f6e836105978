"""Structured Streaming over the record: normalising, de-duplication, live bars, pair status; coverage gaps and reorganisations.

The batch and the streaming path use the same projections.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators.joins import asof_join
from marketlake.operators.normalise import normalise
from marketlake.streaming import ordered


def stream_record(spark: SparkSession, root: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(root)


def stream_normalise(record: DataFrame, venue: str, write: Callable[[str, DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch is normalised like a batch and written by kind (failures as kind ``unparsed``)."""

    def each(batch: DataFrame, _id: int) -> None:
        batch.persist()
        for kind, df in normalise(batch, venue).items():
            write(kind, df)
        batch.unpersist()

    return record.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe_stream(trades: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """A trade once within the delay (``ts``: receipt time)."""
    return trades.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["venue", "ticker", "trade_id"])


def live_bars(candles: DataFrame, delay: str = "8 days") -> DataFrame:
    """Last heard state of each bar (venue, ticker, interval, start); its state is kept until the watermark passes ``delay`` after the start."""
    w = candles.withColumn("bar_ts", F.timestamp_micros("at_micros")).withWatermark("bar_ts", delay)
    state = F.struct("open", "high", "low", "close", "is_final")
    bars = w.groupBy("venue", "ticker", "interval", "bar_ts").agg(F.max_by(state, "recv_micros").alias("s"))
    return bars.select("venue", "ticker", "interval", F.unix_micros("bar_ts").alias("at_micros"), "s.*")


def pair_status(record: DataFrame, declared: DataFrame, now_us: int, window_us: int) -> DataFrame:
    """Declared (ticker, series): messages of the last window, last receipt, and live, stale or never heard."""
    g = record.groupBy("ticker", "series").agg(F.max("recv_micros").alias("last"), F.count_if(F.col("recv_micros") >= now_us - window_us).alias("n"))
    state = F.when(F.col("last").isNull(), "never heard").when(F.col("last") >= now_us - window_us, "live").otherwise("stale")
    return declared.join(g, ["ticker", "series"], "left").select("ticker", "series", F.coalesce("n", F.lit(0)).alias("n"), "last", state.alias("state"))


def coverage_gaps(messages: DataFrame, losses: DataFrame, bucket_us: int = 86_400_000_000) -> DataFrame:
    """One gap for each loss (venue, from_us, to_us, cause) and pair: from the later of the pair's last covered moment and its last gap's end to the loss's end.

    Silence alone is no gap, and a pair that was never covered has none.  :func:`stream_gaps` gives the same from a stream.
    """
    pairs = messages.select("venue", "ticker", "series").distinct()
    lost = losses.select("venue", F.col("from_us").alias("t"), F.col("to_us").alias("until"), "cause").join(pairs, "venue")
    heard = messages.select("venue", "ticker", "series", F.col("recv_micros").alias("t"), F.col("recv_micros").alias("event_id"))
    g = asof_join(lost, heard, ["venue", "ticker", "series"], [], bucket_us).where("right_t IS NOT NULL").withColumnRenamed("right_t", "c")
    gapped = F.max("until").over(Window.partitionBy("venue", "ticker", "series").orderBy("t", "until").rowsBetween(Window.unboundedPreceding, -1))
    g = g.withColumn("from_us", F.greatest("c", F.coalesce(gapped, "c")))
    return g.where("from_us < until").select("venue", "ticker", "series", "from_us", F.col("until").alias("to_us"), "cause")


def stream_gaps(events: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Coverage gaps with keyed state, from messages and :func:`ordered.controls` in one stream (``venue, ticker, series, at_us, seq, what, to_us, cause``)."""
    return ordered.fold_stream(events, ["venue", "ticker", "series"], ordered.gap_step, ordered.GAP, delay)


def restart_gaps(record: DataFrame, marks: DataFrame, now_us: int) -> DataFrame:
    """Gap of each venue from its last durable receipt (or an earlier unflushed mark) to now."""
    last = record.groupBy("venue").agg(F.max("recv_micros").alias("last"))
    out = last.join(marks.select("venue", "unflushed_us", "clean"), "venue", "left")
    return out.select("venue", F.least("last", F.coalesce("unflushed_us", "last")).alias("from_us"), F.lit(now_us).cast("long").alias("to_us"), F.when(F.coalesce("clean", F.lit(False)), "downtime").otherwise("crash").alias("cause"))


def detect_reorgs(blocks: DataFrame, depth: int = 64) -> DataFrame:
    """Blocks (venue, height, hash, parent, seq) whose parent is not the hash held at the height below, with both hashes.

    A venue's chain is one pass in order of ``seq`` that holds the last ``depth`` heights (:func:`ordered.reorg_step`).
    """
    rows = blocks.select("venue", "height", "hash", "parent", F.col("seq").alias("at_us"), "seq")
    return ordered.fold_table(rows, ["venue"], ordered.reorg_step(depth), ordered.REORG)


def stream_reorgs(blocks: DataFrame, depth: int = 64, delay: str = "1 minute") -> DataFrame:
    """The same with keyed state, from a stream of blocks with ``at_us``, their receipt."""
    return ordered.fold_stream(blocks.select("venue", "height", "hash", "parent", "at_us", "seq"), ["venue"], ordered.reorg_step(depth), ordered.REORG, delay)


def new_events(history: DataFrame, page: DataFrame, keys: list[str], since_us: int) -> DataFrame:
    """Events of a page received since the last one seen that the history doesn't hold."""
    return page.where(F.col("recv_micros") >= since_us).dropDuplicates(keys).join(history.select(*keys), keys, "left_anti")
