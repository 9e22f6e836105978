"""Predicates on the tape: windows, bounds, sessions, quote states, scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalars import DAY_US, width_micros


def in_window(df: DataFrame, from_us: int, to_us: int, ticker: str | None = None, at: str = "at_micros") -> DataFrame:
    """Rows of [from, to) and rows without a venue time; a ticker drops rows without one."""
    if to_us < from_us:
        raise ValueError("the window runs backwards")
    df = df.where(F.col(at).isNull() | ((F.col(at) >= from_us) & (F.col(at) < to_us)))
    return df if ticker is None else df.where(F.col("ticker") == ticker)


def apply_bound(df: DataFrame, bound: DataFrame) -> DataFrame:
    """Rows up to their venue's bound (venue, bound); venues without one are withheld.  Few venues: Spark broadcasts them by size."""
    return df.join(bound.select("venue", "bound"), "venue").where("stream_seq <= bound").drop("bound")


def closing_bars(candles: DataFrame, bucket_us: int, from_us: int, to_us: int) -> DataFrame:
    """Final bars heard at or after their end, whose width divides the bucket, which lie inside the window and end on a bucket's end."""
    width = width_micros(F.col("interval"))
    end = F.col("at_micros") + width
    return candles.where(F.col("is_final") & (F.col("recv_micros") >= end) & (F.lit(bucket_us) % width == 0) & (F.col("at_micros") >= from_us) & (end <= to_us) & (end % bucket_us == 0))


def external(ts_us: Column, closed_dates: Column | None = None, zone: str = "America/New_York") -> Column:
    """Futures session hours: Sunday 18:00 to Friday 17:00 local, with a daily break from 17:00 to 18:00.

    ``closed_dates``: an array of trade dates without a session (evenings belong to the next date).
    """
    local = F.from_utc_timestamp(F.timestamp_micros(ts_us), zone)
    hour, day = F.hour(local), F.dayofweek(local)  # Sunday is 1
    is_open = F.when(day == 7, False).when(day == 1, hour >= 18).when(day == 6, hour < 17).otherwise(hour != 17)
    if closed_dates is None:
        return is_open
    trade_date = F.when(hour >= 18, F.date_add(F.to_date(local), 1)).otherwise(F.to_date(local))
    return is_open & ~F.array_contains(closed_dates, trade_date)


def both_in_session(width_us: int, zone: str = "America/New_York", closed_dates: Column | None = None) -> Column:
    """Whether a return's two bars, the one before and its own, lie in session (``t``: start of the return's bar)."""
    t = F.col("t")
    before, own = (external(x, closed_dates, zone) & external(y, closed_dates, zone) for x, y in ((t - width_us, t - 1), (t, t + width_us - 1)))
    return before & own


def in_session_returns(returns: DataFrame, width_us: int, zone: str = "America/New_York", closed_dates: Column | None = None) -> DataFrame:
    return returns.where(both_in_session(width_us, zone, closed_dates))


def valid_quotes(quotes: DataFrame) -> DataFrame:
    return quotes.where("ask_px > bid_px AND bid_sz > 0 AND ask_sz > 0")


def only_new(rows: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ("signal", "horizon", "asof_micros"), redo: bool = False) -> DataFrame:
    """Rows whose period isn't stored yet; all of them with ``redo``."""
    return rows if redo else rows.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def in_scope(df: DataFrame, scopes: list[str] | None, columns: tuple[str, ...] = ("venue", "kind", "date")) -> DataFrame:
    """Rows under any of the paths ``venue``, ``venue/kind``, ...; no scope is nothing, null is all."""
    if scopes is None:
        return df
    cond = F.lit(False)
    for s in scopes:
        one = F.lit(True)
        for c, v in zip(columns, [x for x in s.split("/") if x]):
            one = one & (F.col(c).cast("string") == v)
        cond = cond | one
    return df.where(cond)


def whole_period(now_us: int, width_us: int, frontier_us: int | None) -> int:
    """End of the last whole period that the clock and the tape have both passed."""
    return (now_us if frontier_us is None else min(now_us, frontier_us)) // width_us * width_us


def frontier(tape: DataFrame, kinds: list[str]) -> DataFrame:
    """One row: ``frontier_us``, the least over ``kinds`` of the newest receipt; null where a kind has none.

    ``tape``: kind, date (partition columns of the store) and recv_micros.  Of each kind the newest two dates count.
    """
    held = tape.where(F.col("kind").isin(kinds)).groupBy("kind", "date").agg(F.max("recv_micros").alias("end"))
    newest = held.groupBy("kind").agg(F.slice(F.sort_array(F.collect_list(F.struct("date", "end")), asc=False), 1, 2).alias("d"))
    each = newest.select(F.array_max("d.end").alias("end"))
    return each.agg(F.when((F.count("end") == len(set(kinds))), F.min("end")).alias("frontier_us"))


def external_shares(intervals: DataFrame, closed_dates: Column | None = None) -> DataFrame:
    """``intervals`` (start_us, end_us) with ``external_share``: the share of their minutes, on the grid from the start, in the session.

    The session is constant over an hour, so hours and not minutes are looked at, in the row itself; an empty
    interval has no share.
    """
    minute, hour = 60_000_000, 3_600_000_000
    start, end = F.col("start_us"), F.col("end_us")
    upto = lambda t: F.ceil((F.least(t, end) - start) / minute)  # noqa: E731  grid minutes before t
    in_hour = lambda h: upto((h + 1) * hour) - F.greatest(F.lit(0), upto(h * hour))
    hours = F.sequence(F.floor(start / hour), F.floor((end - 1) / hour))
    count = F.aggregate(hours, F.lit(0).cast("long"), lambda n, h: n + F.when(external(h * hour, closed_dates), in_hour(h)).otherwise(0))
    return intervals.withColumn("external_share", F.when(end > start, count / upto(end)))


__all__ = ["DAY_US", "apply_bound", "both_in_session", "closing_bars", "external", "external_shares", "frontier", "in_scope", "in_session_returns", "in_window", "only_new", "valid_quotes", "whole_period"]
