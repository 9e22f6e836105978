"""Aggregations over the tape: all instruments and periods in one job, keyed by them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import HOUR_US, bound, fisher_z

WEEK_US, MONDAY_US = 604_800_000_000, 345_600_000_000  # 1970-01-05 was a Monday


def build_bars(fine: DataFrame, fine_us: int, coarse_us: int) -> DataFrame:
    """Coarse OHLC bars from all coarse/fine fine bars of a bucket, not fewer; weeks begin on Monday."""
    if coarse_us % fine_us:
        raise ValueError("the coarse width is no multiple of the fine width")
    at = MONDAY_US if coarse_us == WEEK_US else 0
    bucket = F.floor((F.col("t") - at) / coarse_us) * coarse_us + at
    bars = fine.groupBy("ticker", bucket.alias("bucket")).agg(F.min_by("open", "t").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "t").alias("close"), F.count(F.lit(1)).alias("_n"))
    return bars.where(F.col("_n") == coarse_us // fine_us).drop("_n").withColumnRenamed("bucket", "t")


def time_weighted(df: DataFrame, value: str, keys: list[str], w: str = "w") -> DataFrame:
    return df.groupBy(*keys).agg((F.sum(F.col(value) * F.col(w)) / F.sum(w)).alias("mean"), F.sum(w).alias("covered"))


def weighted_quantile(df: DataFrame, value: str, q: float, keys: list[str], w: str = "w") -> DataFrame:
    """Least value at which the running weight reaches share ``q`` of the key's weight."""
    rows = df.groupBy(*keys, value).agg(F.sum(w).alias("_w"))
    upto = F.sum("_w").over(Window.partitionBy(*keys).orderBy(value))
    rows = rows.withColumn("_c", upto).join(rows.groupBy(*keys).agg(F.sum("_w").alias("_all")), keys)
    return rows.where(F.col("_c") >= q * F.col("_all")).groupBy(*keys).agg(F.min(value).alias("quantile"))


def winsorise(df: DataFrame, value: str, lo: float, hi: float, keys: list[str]) -> DataFrame:
    """Values outside the nearest-rank quantiles of their key become these quantiles."""
    cut = nearest_ranks(df, value, [lo, hi], keys)
    return df.join(cut, keys).withColumn(value, F.greatest("q0", F.least("q1", F.col(value)))).drop("q0", "q1")


def nearest_ranks(df: DataFrame, value: str, qs: list[float], keys: list[str]) -> DataFrame:
    """``q0``, ``q1``, ..: the values whose index is q (n - 1), rounded half up; equal values are one row before the sort."""
    rows = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys)
    rows = rows.withColumn("_to", F.sum("_c").over(w.orderBy("_v"))).withColumn("_n", F.sum("_c").over(w))
    at = lambda q: F.floor(F.lit(q) * (F.col("_n") - 1) + 0.5)
    return rows.groupBy(*keys).agg(*[F.max(F.when((at(q) < F.col("_to")) & (at(q) >= F.col("_to") - F.col("_c")), F.col("_v"))).alias(f"q{i}") for i, q in enumerate(qs)])


def robust_z(now: DataFrame, history: DataFrame, keys: list[str], min_n: int, value: str = "value") -> DataFrame:
    """(value - median) / (1.4826 MAD) of the key's history; null under ``min_n`` or at MAD 0."""
    med = history.groupBy(*keys).agg(F.expr(f"percentile({value}, 0.5)").alias("_m"), F.count(value).alias("_n"))
    mad = history.join(med, keys).groupBy(*keys, "_m", "_n").agg(F.expr(f"percentile(abs({value} - _m), 0.5)").alias("_d"))
    z = (F.col(value) - F.col("_m")) / (1.4826 * F.col("_d"))
    return now.join(mad, keys, "left").withColumn("z", F.when((F.col("_n") >= min_n) & (F.col("_d") > 0), z)).withColumnRenamed("_n", "n_eff").drop("_m", "_d")


def median_of(values: Column) -> Column:
    """Median of an array of numbers; null for an empty one."""
    n = F.size(values)
    mid = lambda s: (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2
    return F.when(n > 0, bound(F.array_sort(values), mid))


def trailing_z(rows: DataFrame, value: str, past: str, keys: list[str], span_us: int, min_n: int, t: str = "period") -> DataFrame:
    """``z`` of ``value`` against ``past`` of the key's rows in the ``span_us`` before (median and 1.4826 MAD), ``z_n`` of them and ``z_why`` not.

    For rows of whole periods: each holds the span's values (a month of hours is 720) and nothing is joined.
    """
    w = Window.partitionBy(*keys).orderBy(t).rangeBetween(-span_us, -1)
    x = rows.withColumn("_a", F.collect_list(past).over(w)).withColumn("z_n", F.size("_a")).withColumn("_m", median_of(F.col("_a")))
    x = x.withColumn("_d", median_of(F.transform("_a", lambda v: F.abs(v - F.col("_m")))))
    why = F.when(F.col(value).isNull(), "nothing this period").when(F.col("z_n") < min_n, "too few periods before").when(~(F.col("_d") > 0), "the periods before do not vary")
    return x.withColumn("z_why", why).withColumn("z", F.when(why.isNull(), (F.col(value) - F.col("_m")) / (1.4826 * F.col("_d")))).drop("_a", "_m", "_d")


SEASON = ("ticker", "hour", "weekend")


def _same_season(hours: DataFrame, days: int, keys: tuple[str, ...]) -> DataFrame:
    """``hours`` with each ``_v`` of the same season in the ``days`` before: rows of one hour of day lie whole days apart, so it is an equi-join."""
    h = hours.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(days))).alias("_k"), F.col("t").alias("_t"), F.col("value").alias("_v"))
    return hours.join(h.withColumn("t", F.col("_t") + F.col("_k") * 24 * HOUR_US).drop("_k", "_t"), [*keys, "t"])


def seasonal_rank(hours: DataFrame, days: int, min_bucket: int, keys: tuple[str, ...] = SEASON) -> DataFrame:
    """Share of the earlier ``days`` of the same season strictly below now, and how many there are."""
    hit = _same_season(hours, days, keys)
    return hit.groupBy(*keys, "t", "value").agg(F.avg((F.col("_v") < F.col("value")).cast("double")).alias("rank"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_bucket)


def seasonal_z(hours: DataFrame, days: int = 28, min_bucket: int = 5, keys: tuple[str, ...] = SEASON) -> DataFrame:
    """Robust z on the log scale against the earlier ``days`` of the same season: ``z`` (null if they do not vary), ``n``."""
    logs = hours.where("value > 0").withColumn("value", F.log("value"))
    hit = _same_season(logs, days, keys)
    mid = hit.groupBy(*keys, "t", "value").agg(F.expr("percentile(_v, 0.5)").alias("_m"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_bucket)
    dev = hit.drop("value").join(mid, [*keys, "t"]).groupBy(*keys, "t", "value", "_m", "n").agg(F.expr("percentile(abs(_v - _m), 0.5)").alias("_d"))
    return dev.select(*keys, "t", F.when(F.col("_d") > 0, (F.col("value") - F.col("_m")) / (1.4826 * F.col("_d"))).alias("z"), "n")


def vw_ew(df: DataFrame, value: str, weight: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("vw"), F.avg(value).alias("ew"))


def trade_flow(trades: DataFrame, every_us: int, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Buy and sell notional, imbalance, last price and count of each (keys, bucket)."""
    n = F.col("price") * F.col("size")
    g = trades.groupBy(*keys, (F.floor(F.col("t") / every_us) * every_us).alias("bucket")).agg(
        F.sum(F.when(F.col("aggressor") == "bid", n).otherwise(0.0)).alias("buy"), F.sum(F.when(F.col("aggressor") == "ask", n).otherwise(0.0)).alias("sell"),
        F.count(F.lit(1)).alias("trades"), F.max_by("price", F.struct("t", "trade_id")).alias("last"),
    )
    return g.withColumn("imbalance", (F.col("buy") - F.col("sell")) / (F.col("buy") + F.col("sell")))


def ofi(quotes: DataFrame, every_us: int) -> DataFrame:
    """Order-flow imbalance by (venue, ticker, bucket): signed changes at the touch, mean depth, return of the mid in bps, number of states.

    The row before is looked up inside (ticker, bucket): a bucket's first state is compared with nothing.
    """
    q = quotes.withColumn("bucket", F.floor(F.col("t") / every_us) * every_us)
    w = Window.partitionBy("venue", "ticker", "bucket").orderBy("t", "event_id")
    b, a, bs, as_ = (F.col(c) for c in ("bid_px", "ask_px", "bid_sz", "ask_sz"))
    pb, pa_, pbs, pas = (F.lag(c).over(w) for c in ("bid_px", "ask_px", "bid_sz", "ask_sz"))
    zero = F.lit(0.0)
    e = F.when(b >= pb, bs).otherwise(zero) - F.when(b <= pb, pbs).otherwise(zero) - F.when(a <= pa_, as_).otherwise(zero) + F.when(a >= pa_, pas).otherwise(zero)
    q = q.withColumn("_e", F.when(pb.isNotNull(), e).otherwise(zero))
    mid, when = (b + a) / 2, F.struct("t", "event_id")
    back = F.log(F.max_by(mid, when) / F.min_by(mid, when)) * 1e4
    return q.groupBy("venue", "ticker", "bucket").agg(F.sum("_e").alias("ofi"), F.avg((bs + as_) / 2).alias("depth"), back.alias("return_bps"), F.count(F.lit(1)).alias("states"))


def linear_fit(df: DataFrame, y: str, x: str, keys: list[str], min_n: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")).where(F.col("n") >= min_n)


def volatility(returns: DataFrame, bucket_us: int, min_n: int) -> DataFrame:
    year = math.sqrt(365 * 86400 / (bucket_us / 1e6))
    g = returns.groupBy("ticker").agg((F.stddev_samp("r") * year).alias("_v"), F.count("r").alias("n"))
    return g.select("ticker", F.when(F.col("n") >= max(min_n, 2), F.col("_v")).alias("volatility"), "n")


def correlation(paired: DataFrame, min_n: int, z: float) -> DataFrame:
    """Correlation of pairs with its Fisher interval (only past 3 observations)."""
    g = paired.groupBy("i", "j").agg(F.corr("ri", "rj").alias("rho"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(min_n, 2))
    half = z / F.sqrt(F.col("n") - 3)
    side = lambda s: F.when((F.col("n") > 3) & (F.col("i") != F.col("j")), F.tanh(fisher_z(F.col("rho")) + s * half))
    return g.withColumn("lo", side(-1)).withColumn("hi", side(1))


def beta(paired: DataFrame, reference: str, min_n: int) -> DataFrame:
    both = paired.where(F.col("i") == reference).select("t", F.col("j").alias("ticker"), F.col("rj").alias("r"), F.col("ri").alias("ref")).unionByName(
        paired.where((F.col("j") == reference) & (F.col("i") != reference)).select("t", F.col("i").alias("ticker"), F.col("ri").alias("r"), F.col("rj").alias("ref")))
    return both.groupBy("ticker").agg(F.regr_slope("r", "ref").alias("beta"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(min_n, 2))


def ewma_cov(paired: DataFrame, lam: float, slot_us: int, least: float = 1e-12) -> DataFrame:
    """Zero-mean covariance with weights lam^age by slot rank, one row per pair, and the effective number of slots.

    Ages are ranks of distinct slots, at most log(least) / log(lam) of them.
    """
    keep = int(math.log(least) / math.log(lam))
    slots = paired.select("t").distinct().orderBy(F.desc("t")).limit(keep)
    aged = slots.withColumn("age", F.row_number().over(Window.orderBy(F.desc("t"))) - 1)
    rows = paired.join(F.broadcast(aged), "t").withColumn("_w", F.pow(F.lit(lam), F.col("age")))
    return rows.groupBy("i", "j").agg((F.sum(F.col("_w") * F.col("ri") * F.col("rj")) / F.sum("_w")).alias("cov"), (F.sum("_w") * F.sum("_w") / F.sum(F.col("_w") * F.col("_w"))).alias("n_eff"))


def ewma_variance(returns: DataFrame, lam: float = 0.94, block: int = 512) -> DataFrame:
    """``returns`` with ``i`` (row of the ticker) and ``s2``, the zero-mean EWMA variance known before the row: (1 - lam) sum of lam^(age - 1) r^2.

    Sums are taken inside blocks of rows from their own begin, so no power overflows, and the two blocks
    before are carried in; what is older weighs under lam^(2 block).  The row after a ticker's last, with
    no return, holds the forecast.
    """
    by = Window.partitionBy("ticker")
    rows = returns.select("ticker", "t", "r").withColumn("i", F.row_number().over(by.orderBy("t")))
    end = rows.groupBy("ticker").agg(F.max("t").alias("t"), (F.max("i") + 1).alias("i")).select("ticker", "t", F.lit(None).cast("double").alias("r"), "i")
    rows = rows.unionByName(end).withColumn("_b", F.floor(F.col("i") / block)).withColumn("_k", F.col("i") - F.col("_b") * block)
    x = F.coalesce(F.col("r") * F.col("r"), F.lit(0.0)) * F.pow(F.lit(1 / lam), F.col("_k"))
    total = rows.groupBy("ticker", "_b").agg(F.sum(x).alias("_t"))
    w = Window.partitionBy("ticker").orderBy("_b")
    carry = total.select("ticker", "_b", (F.coalesce(F.lag("_t").over(w), F.lit(0.0)) * lam**block + F.coalesce(F.lag("_t", 2).over(w), F.lit(0.0)) * lam ** (2 * block)).alias("_c"))
    own = F.coalesce(F.sum(x).over(Window.partitionBy("ticker", "_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("_o", own).join(carry, ["ticker", "_b"])
    return rows.withColumn("s2", (1 - lam) * F.pow(F.lit(lam), F.col("_k") - 1) * (F.col("_o") + F.col("_c"))).drop("_b", "_k", "_o", "_c")


def realized_variance(returns: DataFrame, period_us: int, expected: int) -> DataFrame:
    g = returns.groupBy("ticker", (F.floor(F.col("t") / period_us) * period_us).alias("period")).agg(F.sum(F.col("r") * F.col("r")).alias("rv"), F.count(F.lit(1)).alias("n"))
    return g.where(F.col("n") >= expected)


def realized_moments(returns: DataFrame, period_us: int, min_n: int, thin: bool = False) -> DataFrame:
    """Volatility, skewness and kurtosis by (ticker, period); ``thin``: periods under ``min_n`` or without variation stay, with nulls."""
    s = lambda k: F.sum(F.pow("r", F.lit(float(k))))
    g = returns.groupBy("ticker", (F.floor(F.col("t") / period_us) * period_us).alias("period")).agg(F.count("r").alias("n"), s(2).alias("_2"), s(3).alias("_3"), s(4).alias("_4"))
    ok = F.coalesce((F.col("n") >= min_n) & (F.col("_2") > 0), F.lit(False))
    g = g.withColumn("_2", F.when(ok, F.col("_2"))) if thin else g.where(ok)
    return g.select("ticker", "period", "n", F.sqrt("_2").alias("vol"), (F.sqrt("n") * F.col("_3") / F.pow("_2", F.lit(1.5))).alias("skew"), (F.col("n") * F.col("_4") / (F.col("_2") * F.col("_2"))).alias("kurt"))


def jump_ratio(returns: DataFrame, period_us: int, min_n: int) -> DataFrame:
    """Bipower jump share and its z by (ticker, period); lags stay inside the period."""
    r = returns.withColumn("period", F.floor(F.col("t") / period_us) * period_us)
    w = Window.partitionBy("ticker", "period").orderBy("t")
    a, b, c = F.abs("r"), F.abs(F.lag("r", 1).over(w)), F.abs(F.lag("r", 2).over(w))
    r = r.withColumn("_2", a * b).withColumn("_3", F.pow(a * b * c, F.lit(4 / 3)))
    g = r.groupBy("ticker", "period").agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("r") * F.col("r")).alias("rv"), F.sum("_2").alias("_s2"), F.sum("_3").alias("_s3")).where((F.col("m") >= max(3, min_n)) & (F.col("rv") > 0))
    mu = 2 ** (2 / 3) * math.gamma(7 / 6) / math.gamma(0.5)
    m = F.col("m")
    g = g.withColumn("bv", F.lit(math.pi / 2) * m / (m - 1) * F.col("_s2")).withColumn("tq", m * F.lit(mu**-3) * m / (m - 2) * F.col("_s3"))
    rj = (F.col("rv") - F.col("bv")) / F.col("rv")
    theta = (math.pi / 2) ** 2 + math.pi - 5
    return g.select("ticker", "period", "m", "rv", "bv", rj.alias("rj"), F.greatest(rj, F.lit(0.0)).alias("share"), (rj / F.sqrt(F.lit(theta) / m * F.greatest(F.lit(1.0), F.col("tq") / (F.col("bv") * F.col("bv"))))).alias("z"))


def decay_intensity(events: DataFrame, asofs: DataFrame, tau_us: int, days: int) -> DataFrame:
    """Sum of exp(-age / tau) of the key's events in the ``days`` before each asof; events are dealt to the days they count for."""
    day = 86_400_000_000
    e = events.withColumn("_d", F.explode(F.sequence(F.floor(F.col("t") / day), F.floor(F.col("t") / day) + days)))
    hit = asofs.withColumn("_d", F.floor(F.col("asof") / day)).join(e, ["ticker", "_d"]).where((F.col("t") < F.col("asof")) & (F.col("t") >= F.col("asof") - days * day))
    return hit.groupBy("ticker", "asof").agg(F.sum(F.exp(-(F.col("asof") - F.col("t")) / F.lit(float(tau_us)))).alias("intensity"))


def amihud(flow: DataFrame, period_us: int) -> DataFrame:
    """Mean of |log return| in bps per million of notional over buckets with a bucket before them."""
    step = flow.select("ticker", "bucket", (F.col("buy") + F.col("sell")).alias("notional"), "last")
    w = Window.partitionBy("ticker", F.floor(F.col("bucket") / period_us)).orderBy("bucket")
    step = step.withColumn("_r", F.abs(F.log(F.col("last") / F.lag("last").over(w))) * 1e4).where("_r IS NOT NULL AND notional > 0")
    return step.groupBy("ticker", (F.floor(F.col("bucket") / period_us) * period_us).alias("period")).agg(F.avg(F.col("_r") / (F.col("notional") / 1e6)).alias("amihud"))


def trailing_amihud(trades: DataFrame, asofs: DataFrame, hours: int = 24, every_us: int = 60_000_000) -> DataFrame:
    """``asofs`` (venue, ticker, period) with ``amihud``: mean |log return| in bps per million of notional over the buckets of the ``hours`` to the period's end.

    A bucket's return is from the bucket before it inside these hours, so the first of them has none.  Buckets are looked at
    inside their hour; across hours one row an hour is carried.
    """
    key = ["venue", "ticker"]
    b = trade_flow(trades, every_us, tuple(key)).withColumn("period", F.floor(F.col("bucket") / HOUR_US) * HOUR_US).withColumn("_n", F.col("buy") + F.col("sell")).where("_n > 0")
    ratio = lambda now, before, n: F.abs(F.log(now / before)) * 1e4 / (n / 1e6)
    b = b.withColumn("_x", ratio(F.col("last"), F.lag("last").over(Window.partitionBy(*key, "period").orderBy("bucket")), F.col("_n")))
    first = lambda c: F.min_by(c, "bucket")
    h = b.groupBy(*key, "period").agg(F.sum("_x").alias("_s"), F.count("_x").alias("_c"), first("last").alias("_open"), first("_n").alias("_on"), F.max_by("last", "bucket").alias("_close"))
    grid = asofs.select(*key, "period").distinct()
    h = h.join(grid.withColumn("_asked", F.lit(True)), [*key, "period"], "full")
    w = Window.partitionBy(*key).orderBy("period")
    before = F.last("_close", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    h = h.withColumn("_f", F.when(F.col("_open").isNotNull(), F.struct(ratio(F.col("_open"), before, F.col("_on")).alias("x"))))
    back = w.rangeBetween(-(hours - 1) * HOUR_US, 0)
    lead = F.first("_f", ignorenulls=True).over(back)["x"]  # of the first hour that has buckets: from before the window
    total = F.sum(F.coalesce("_s", F.lit(0.0)) + F.coalesce(F.col("_f.x"), F.lit(0.0))).over(back) - F.coalesce(lead, F.lit(0.0))
    count = F.sum(F.coalesce("_c", F.lit(0)) + F.col("_f.x").isNotNull().cast("int")).over(back) - lead.isNotNull().cast("int")
    return h.withColumn("_t", total).withColumn("amihud_n", count).where("_asked").select(*key, "period", F.when(F.col("amihud_n") > 0, F.col("_t") / F.col("amihud_n")).alias("amihud"), "amihud_n")


def trailing_carry(funding: DataFrame, hours: int, coverage: float = 0.9, baseline: float = 0.0, near: float = 1e-9) -> DataFrame:
    """Annualised mean of the settled rates in the ``hours`` up to each hour, where enough of them are there; shares of positive rates and of rates at the baseline."""
    one = funding.groupBy("ticker", (F.floor(F.col("t") / HOUR_US) * HOUR_US).alias("hour")).agg(F.min_by("rate", "t").alias("rate"))
    w = Window.partitionBy("ticker").orderBy("hour").rangeBetween(-(hours - 1) * HOUR_US, 0)
    share = lambda c: F.avg(c.cast("double")).over(w)
    out = one.withColumn("n", F.count("rate").over(w)).withColumn("apr", F.avg("rate").over(w) * 8760)
    out = out.withColumn("positive", share(F.col("rate") > 0)).withColumn("at_baseline", share(F.abs(F.col("rate") - baseline) < near))
    return out.where(F.col("n") >= coverage * hours).select("ticker", "hour", "apr", "n", "positive", "at_baseline")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The key's row that is last in ``order`` (all columns); partial aggregation, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_s")).select(*[c if c in keys else F.col(f"_s.{c}").alias(c) for c in df.columns])


def venue_bound(tape: DataFrame, kinds: int) -> DataFrame:
    """Least over kinds of the newest sequence of each venue; ``missing`` counts kinds a venue hasn't written."""
    top = tape.groupBy("venue", "kind").agg(F.max("stream_seq").alias("top"))
    return top.groupBy("venue").agg(F.min("top").alias("bound"), (F.lit(kinds) - F.count(F.lit(1))).alias("missing"))


def latency(df: DataFrame) -> DataFrame:
    ms = (F.col("recv_micros") - F.col("at_micros")) / 1000
    return df.where("at_micros IS NOT NULL").groupBy("venue", "ticker").agg(F.avg(ms).alias("avg_ms"), *[F.percentile(ms, F.lit(q)).alias(f"p{int(q * 100)}_ms") for q in (0.5, 0.95, 0.99)], F.max(ms).alias("max_ms"), F.count(F.lit(1)).alias("n"))


def redelivery(trades: DataFrame) -> DataFrame:
    """Receipts beyond the first of each trade, by minute of the last receipt."""
    g = trades.where("trade_id IS NOT NULL").groupBy("ticker", "trade_id").agg((F.count(F.lit(1)) - 1).alias("again"), F.max("recv_micros").alias("at"))
    return g.groupBy("ticker", (F.floor(F.col("at") / 60_000_000)).alias("minute")).agg(F.sum("again").alias("redelivered"), F.count(F.lit(1)).alias("trades")).where("redelivered > 0")


def activity_grid(rows: DataFrame, zone: str) -> DataFrame:
    local = F.from_utc_timestamp(F.timestamp_micros("t"), zone)
    return rows.groupBy("ticker", F.dayofweek(local).alias("dow"), F.hour(local).alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("volume"))


def qlike(df: DataFrame, f: str, y: str, keys: list[str]) -> DataFrame:
    x = F.col(y) / F.col(f)
    return df.groupBy(*keys).agg(F.avg(x - F.log(x) - 1).alias("qlike"))


def large_share(trades: DataFrame, q: float = 0.95, min_n: int = 100, hours: int = 24) -> DataFrame:
    """Share of an hour's notional above the nearest-rank quantile of the ``hours`` before it."""
    t = trades.select("ticker", F.floor(F.col("t") / HOUR_US).alias("hour"), (F.col("price") * F.col("size")).alias("notional"))
    spread = t.withColumn("hour", F.explode(F.sequence(F.col("hour") + 1, F.col("hour") + hours)))
    n = spread.groupBy("ticker", "hour").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_n)
    cut = nearest_ranks(spread, "notional", [q], ["ticker", "hour"]).withColumnRenamed("q0", "cut").join(n, ["ticker", "hour"])
    hit = t.join(cut, ["ticker", "hour"])
    return hit.groupBy("ticker", "hour").agg((F.sum(F.when(F.col("notional") > F.col("cut"), F.col("notional")).otherwise(0.0)) / F.sum("notional")).alias("large_share"))


def backfill_worklist(gaps: DataFrame, candles: DataFrame, now_us: int) -> DataFrame:
    """One range for each (ticker, series, width): from recorded gaps, and from bars closed since the last final one."""
    last = candles.where("is_final").groupBy("ticker", "width").agg(F.max("at_micros").alias("last"))
    due = last.where((F.col("last") + 2 * F.col("width")) <= now_us).select("ticker", F.lit("candles").alias("series"), "width", F.col("last").alias("from_us"), F.lit(now_us).cast("long").alias("to_us"))
    pad = F.coalesce("width", F.lit(60_000_000))
    return gaps.select("ticker", "series", "width", (F.col("from_us") - pad).alias("from_us"), "to_us").unionByName(due).groupBy("ticker", "series", "width").agg(F.min("from_us").alias("from_us"), F.max("to_us").alias("to_us"))
