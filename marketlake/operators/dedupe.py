"""Identity rules of the tape and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.aggs import latest_by


def dedupe_trades(trades: DataFrame) -> DataFrame:
    """A trade counts once: its first receipt; rows without an id all stay."""
    keys = ["venue", "ticker", "trade_id"]
    rest = [c for c in trades.columns if c not in keys]
    some = trades.where("trade_id IS NOT NULL").groupBy(*keys).agg(F.min_by(F.struct(*rest), "recv_micros").alias("_s"))
    some = some.select(*[c if c in keys else F.col(f"_s.{c}").alias(c) for c in trades.columns])
    return some.unionByName(trades.where("trade_id IS NULL"))


def latest_candles(candles: DataFrame) -> DataFrame:
    return latest_by(candles, ["venue", "ticker", "at_micros", "interval"], ["recv_micros"])


def dedupe_events(df: DataFrame, kind: str) -> DataFrame:
    """Account events once: fills by (trade_id, order_id), others by the whole row."""
    return df.dropDuplicates(["account", "trade_id", "order_id"]) if kind == "fills" else df.distinct()


def contained_rows(a: DataFrame, b: DataFrame) -> bool:
    """Every row of ``a`` is in ``b``, as often."""
    return a.exceptAll(b.select(*a.columns)).isEmpty()


def missing(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return declared.join(present.select(*keys).distinct(), keys, "left_anti")


def unify(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedupe_chain(df: DataFrame) -> DataFrame:
    """A chain event once within one side of a reorganisation (``reorg_seq`` from ``standing``)."""
    return df.dropDuplicates(["tx_hash", "log_index", "reorg_seq"])
