"""Lead and lag of instruments by correlations of overlapping returns (Hayashi and Yoshida), all periods, pairs and lags in one job.

For a return of the leader over (s, e], moved by a lag, the follower's overlapping returns add up to a
difference of two of its log prices: at its first tick at or after e + lag, less at its last at or before
s + lag.  So a sum over overlaps is two as-of joins, linear in ticks times lags; these are cut by time
buckets, and no hot pair or hour meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.joins import asof_join


def ticks(quotes: DataFrame, period_us: int) -> DataFrame:
    """Log mid at each distinct time of (ticker, period): ``ticker, period, t, p``."""
    mid = F.log((F.col("bid_px") + F.col("ask_px")) / 2)
    return quotes.groupBy("ticker", (F.floor(F.col("t") / period_us) * period_us).alias("period"), "t").agg(F.max_by(mid, "event_id").alias("p"))


def intervals(of: DataFrame, bucket_us: int) -> DataFrame:
    """Returns between neighbouring ticks of (ticker, period): ``s, e, r``; windows run in time buckets, with the last tick before each."""
    b = of.withColumn("_b", F.floor(F.col("t") / bucket_us))
    last = b.groupBy("ticker", "period", "_b").agg(F.max(F.struct("t", "p")).alias("_l"))
    carry = last.select("ticker", "period", "_b", F.lag("_l").over(Window.partitionBy("ticker", "period").orderBy("_b")).alias("_c"))
    own = F.lag(F.struct("t", "p")).over(Window.partitionBy("ticker", "period", "_b").orderBy("t"))
    both = b.withColumn("_o", own).join(carry, ["ticker", "period", "_b"]).withColumn("_o", F.coalesce("_o", "_c")).where("_o IS NOT NULL")
    return both.select("ticker", "period", F.col("_o.t").alias("s"), F.col("t").alias("e"), (F.col("p") - F.col("_o.p")).alias("r"))


def overlap_correlations(of: DataFrame, leader: str, lags_us: Sequence[int], bucket_us: int = 60_000_000) -> DataFrame:
    """(period, follower, lag_us, rho, n): correlation of the leader's returns, moved by each lag, with every other ticker's; ``n``: the fewer ticks."""
    iv = intervals(of, bucket_us)
    sums = of.groupBy("ticker", "period").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "p")).alias("_first"), F.max(F.struct("t", "p")).alias("_last"))
    sums = sums.join(iv.groupBy("ticker", "period").agg(F.sum(F.col("r") * F.col("r")).alias("v")), ["ticker", "period"], "left")
    lead = sums.where(F.col("ticker") == leader).select("period", F.col("n").alias("n_lead"), F.col("v").alias("v_lead"))
    pairs = sums.where(F.col("ticker") != leader).join(lead, "period")
    moved = iv.where(F.col("ticker") == leader).drop("ticker").withColumn("lag_us", F.explode(F.array(*[F.lit(v).cast("long") for v in lags_us])))
    moved = moved.join(pairs.select("period", "ticker"), "period").select("period", "ticker", "lag_us", "e", "r", (F.col("s") + F.col("lag_us")).alias("t"))
    ys = of.where(F.col("ticker") != leader).select("period", "ticker", "t", "p", F.col("t").alias("event_id"))
    hit = asof_join(moved, ys, ["period", "ticker"], ["p"], bucket_us).withColumnRenamed("p", "before").drop("right_t")
    # the first tick at or after a time is the last one before it when time runs backwards
    back = ys.withColumn("t", -F.col("t")).withColumn("event_id", F.col("t"))
    hit = asof_join(hit.withColumn("t", -(F.col("e") + F.col("lag_us"))), back, ["period", "ticker"], ["p"], bucket_us).withColumnRenamed("p", "after")
    ends = pairs.select("period", "ticker", F.col("_first.p").alias("_f"), F.col("_last.p").alias("_l"))
    hit = hit.select("period", "ticker", "lag_us", "r", "before", "after").join(ends, ["period", "ticker"])
    cross = hit.groupBy("period", "ticker", "lag_us").agg(F.sum(F.col("r") * (F.coalesce("after", "_l") - F.coalesce("before", "_f"))).alias("cross"))
    grid = pairs.withColumn("lag_us", F.explode(F.array(*[F.lit(v).cast("long") for v in lags_us])))
    out = grid.join(cross, ["period", "ticker", "lag_us"], "left")
    norm = F.sqrt(F.col("v") * F.col("v_lead"))
    return out.select("period", F.col("ticker").alias("follower"), "lag_us", F.when(norm > 0, F.coalesce("cross", F.lit(0.0)) / norm).alias("rho"), F.least("n", "n_lead").alias("n"), F.col("n").alias("n_other"), "n_lead")


def lead_lag(of: DataFrame, leader: str, lags_us: Sequence[int], block_us: int = 100_000, step_us: int = 1_000, bucket_us: int = 60_000_000) -> DataFrame:
    """The lag with the largest absolute correlation of each (period, follower), and what the block around 0 says.

    ``lead_us`` above 0: the leader moves first.  A peak within one block, or one that beats the block's best by
    under 2 / sqrt n (``indistinct``), is a lead of 0 with the block's best correlation.  ``llr``: squared correlations at
    positive lags over those at the mirrored negative ones; ``rho_leader_first`` and ``rho_other_first`` at one step to either side.
    """
    block = (-block_us, -step_us, 0, step_us, block_us)
    c = overlap_correlations(of, leader, sorted({*lags_us, *block}), bucket_us)
    grid = F.col("lag_us").isin(*[int(v) for v in lags_us])
    peak = lambda inside: F.max(F.when(inside & F.col("rho").isNotNull(), F.struct(F.abs("rho").alias("a"), (-F.abs("lag_us")).alias("near"), "lag_us", "rho")))
    at = lambda v: F.max(F.when(F.col("lag_us") == v, F.col("rho")))
    side = lambda s: F.sum(F.when(grid & (F.signum(F.col("lag_us")) == s), F.col("rho") * F.col("rho")))
    g = c.groupBy("period", "follower", "n", "n_lead", "n_other").agg(
        peak(grid).alias("_p"), peak(F.col("lag_us").isin(*[int(v) for v in block])).alias("_b"), at(0).alias("rho_0"),
        at(step_us).alias("rho_leader_first"), at(-step_us).alias("rho_other_first"), side(1.0).alias("_up"), side(-1.0).alias("_down"))
    g = g.withColumn("within", F.abs("_p.lag_us") <= block_us)
    g = g.withColumn("indistinct", ~F.col("within") & (F.col("_p.a") - F.col("_b.a") < 2 / F.sqrt("n")))
    zero = F.col("within") | F.col("indistinct")
    return g.select(
        "period", "follower", "n", "n_lead", "n_other", F.when(zero, F.lit(0)).otherwise(F.col("_p.lag_us")).cast("long").alias("lead_us"),
        F.when(zero, F.col("_b.rho")).otherwise(F.col("_p.rho")).alias("rho_lead"), "rho_0", F.when(F.col("_down") > 0, F.col("_up") / F.col("_down")).alias("llr"),
        "rho_leader_first", "rho_other_first", (F.col("rho_leader_first") - F.col("rho_other_first")).alias("block_asymmetry"), "within", "indistinct")
