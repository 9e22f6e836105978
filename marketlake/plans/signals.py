"""Composed signals: long rows (signal, horizon, measure, ticker_i, ticker_j, value, absent, n_eff, asof_micros).

Every period and instrument comes from one job; a figure that can't be computed is a row with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import HOUR_US, fisher_z, season
from marketlake.operators import aggs, dedupe, filters, joins, windows

DAY_US = 24 * HOUR_US


def long_rows(df: DataFrame, signal: str, horizon: str, measures: dict[str, Column | tuple[Column, Column]], asof: Column, n_eff: Column, i: str = "ticker", j: str | None = None, why: Column | str = "not enough observations", venue: bool = False) -> DataFrame:
    """One row per measure; null and non-finite values are absent with the reason (a measure may have its own: value, reason).  ``venue``: ``ticker_i`` is venue/ticker."""
    why = F.lit(why) if isinstance(why, str) else why
    both = {k: v if isinstance(v, tuple) else (v, why) for k, v in measures.items()}
    each = F.array(*[F.struct(F.lit(k).alias("measure"), v.cast("double").alias("v"), w.alias("why")) for k, (v, w) in both.items()])
    rows = df.select((F.concat_ws("/", "venue", i) if venue else F.col(i)).alias("ticker_i"), (F.col(j) if j else F.lit(None).cast("string")).alias("ticker_j"), asof.alias("asof_micros"), n_eff.cast("double").alias("n_eff"), F.explode(each).alias("m"))
    ok = F.col("m.v").isNotNull() & ~F.isnan("m.v") & (F.abs("m.v") < float("inf"))
    return rows.select(F.lit(signal).alias("signal"), F.lit(horizon).alias("horizon"), "m.measure", "ticker_i", "ticker_j", F.when(ok, F.col("m.v")).alias("value"), F.when(~ok, F.col("m.why")).alias("absent"), "n_eff", "asof_micros")


def basis(marks: DataFrame, max_stand_us: int = 30_000_000, covered_minutes: int = 48, sessioned: tuple[str, ...] = (), z_days: int = 30, z_min: int = 72, closed_dates: Column | None = None) -> DataFrame:
    """Hourly premium (winsorised mean, median, z against the hours of ``z_days`` before), mark over oracle, open interest and its log change.

    ``sessioned`` tickers follow an external market: they have the hour's share in its session, and only hours wholly in it are compared.
    """
    rows = marks.where("mark IS NOT NULL AND oracle > 0 AND premium IS NOT NULL").withColumn("bps", F.col("premium") * 1e4).withColumn("over", (F.col("mark") / F.col("oracle") - 1) * 1e4)
    st = windows.stood(rows, ["ticker"], HOUR_US, max_stand_us, ["event_id"])
    key = ["ticker", "period"]
    twa = aggs.time_weighted(aggs.winsorise(st, "bps", 0.01, 0.99, key), "bps", key).withColumnRenamed("mean", "premium")
    med = aggs.weighted_quantile(st, "bps", 0.5, key).withColumnRenamed("quantile", "median")
    sampled = F.when(F.col("open_interest") > 0, F.struct("t", "event_id"))
    first, last = (f(F.struct("open_interest", "mark"), sampled) for f in (F.min_by, F.max_by))
    rest = st.groupBy(*key).agg((F.sum(F.col("over") * F.col("w")) / F.sum("w")).alias("over"), F.count(sampled).alias("oi_n"), first.alias("oi_first"), last.alias("oi_last"))
    all_ = twa.join(med, key).join(rest, key)
    ok, outside = F.col("covered") >= covered_minutes * 60_000_000, F.col("ticker").isin(*sessioned)
    all_ = filters.external_shares(all_.withColumn("start_us", F.col("period")).withColumn("end_us", F.col("period") + HOUR_US), closed_dates)
    all_ = all_.withColumn("twa", F.when(ok, F.col("premium"))).withColumn("whole", ~outside | (F.col("external_share") == 1)).withColumn("past", F.when(F.col("whole"), F.col("twa")))
    all_ = aggs.trailing_z(all_, "twa", "past", ["ticker"], z_days * DAY_US, z_min)
    thin, held = F.lit("too little of the hour is covered"), ok & (F.col("oi_n") >= 2)
    few = F.when(ok, F.lit("under two open-interest samples in the hour")).otherwise(thin)
    measures = {
        "premium_twa_bps": (F.col("twa"), thin), "premium_median_bps": (F.when(ok, F.col("median")), thin), "mark_oracle_bps": (F.when(ok, F.col("over")), thin),
        "open_interest_log_change": (F.when(held, F.log(F.col("oi_last.open_interest") / F.col("oi_first.open_interest"))), few), "open_interest_usd": (F.when(held, F.col("oi_last.open_interest") * F.col("oi_last.mark")), few),
        "external_share": (F.col("external_share"), thin), "premium_z_30d": (F.when(F.col("whole"), F.col("z")), F.when(F.col("whole"), F.col("z_why")).otherwise(F.lit("the hour is not wholly in the external session"))),
    }
    out = long_rows(all_, "basis", "1h", measures, F.col("period") + HOUR_US, F.col("covered") / 6e7)
    return out.where((F.col("measure") != "external_share") | F.col("ticker_i").isin(*sessioned))


def activity(trades: DataFrame, days: int = 28, min_bucket: int = 5, min_trades: int = 100) -> DataFrame:
    """Hourly notional, trade count, mean trade, their seasonal z, the notional's seasonal rank and the large share; trades count once."""
    t = dedupe.dedupe_trades(trades)
    g = t.groupBy("ticker", F.floor(F.col("t") / HOUR_US).alias("_h")).agg(F.sum(F.col("price") * F.col("size")).alias("notional"), F.count(F.lit(1)).alias("count"))
    g = g.withColumn("size", F.col("notional") / F.col("count")).withColumn("t", F.col("_h") * HOUR_US)
    hour, weekend = season(F.col("t") + HOUR_US)
    g = g.withColumn("hour", hour).withColumn("weekend", weekend)
    key = ["ticker", "t"]
    of = lambda c: g.select(*aggs.SEASON, "t", F.col(c).cast("double").alias("value"))
    out = g.select(*key, "notional", "count", "size")
    for c in ("notional", "count", "size"):
        out = out.join(aggs.seasonal_z(of(c), days, min_bucket).select(*key, F.col("z").alias(f"z_{c}")), key, "left")
    out = out.join(aggs.seasonal_rank(of("notional"), days, min_bucket).select(*key, "rank"), key, "left")
    large = aggs.large_share(t, min_n=min_trades).withColumn("t", F.col("hour") * HOUR_US).drop("hour")
    out = out.join(large, key, "left")
    m = {"notional_usd": "notional", "trade_count": "count", "avg_trade_usd": "size", "volume_z": "z_notional", "count_z": "z_count", "size_z": "z_size", "volume_pct": "rank", "large_share": "large_share"}
    return long_rows(out, "activity", "1h", {k: F.col(v) for k, v in m.items()}, F.col("t") + HOUR_US, F.col("count"))


def carry(funding: DataFrame, coverage: float = 0.9, baseline: float | Column = 1.25e-5, live: DataFrame | None = None, returns: DataFrame | None = None, near: float = 1e-12, z_days: int = 90, z_min: int = 60, min_returns: int = 480) -> DataFrame:
    """At each hour with a settled rate: annualised means over 24 hours, 7 and 30 days to it; over 7 days also the excess over the
    baseline rate, shares of positive rates and of rates at it, z against the daily means of the ``z_days`` before the week, and the
    mean over the volatility of 31 days of hourly ``returns`` (ticker, t of the bar's start, r).  Nowcast: the newest ``live`` rate
    (ticker, recv_micros, rate) received in the hour before.  A figure with too few hours is absent.
    """
    base = F.lit(baseline) if not isinstance(baseline, Column) else baseline
    one = funding.groupBy("ticker", (F.floor(F.col("t") / HOUR_US) * HOUR_US).alias("hour")).agg(F.min_by("rate", "t").alias("rate"))
    out, thin, year = one, F.lit("too few settled hours"), 8760
    for name, hours in (("24h", 24), ("7d", 168), ("30d", 720)):
        w = Window.partitionBy("ticker").orderBy("hour").rangeBetween(-(hours - 1) * HOUR_US, 0)
        out = out.withColumn(f"n_{name}", F.count("rate").over(w)).withColumn(f"mean_{name}", F.when(F.col(f"n_{name}") >= coverage * hours, F.avg("rate").over(w)))
        if name == "7d":
            share = lambda c: F.avg(c.cast("double")).over(w)  # noqa: E731, B023
            out = out.withColumn("positive", share(F.col("rate") > 0)).withColumn("at_base", share(F.abs(F.col("rate") - base) < near))
    week = F.col("mean_7d").isNotNull()
    out = _against_days(out, one, coverage, z_days)
    flat = F.col("day_sd") <= 1e-9 * F.greatest(F.abs("day_mean"), F.lit(1e-12))
    z = F.when(week & (F.col("days") >= z_min) & ~flat, (F.col("mean_7d") - F.col("day_mean")) / F.col("day_sd"))
    z_why = F.when(~week, thin).when(F.col("days") < z_min, F.lit("too few covered days before the week")).otherwise(F.lit("the daily means do not vary"))
    at = lambda name: {"n": F.col(f"n_{name}"), "asof": F.col("hour")}
    rows = lambda m, name: long_rows(out, "carry", "1h", m, at(name)["asof"], at(name)["n"], why=thin)
    if returns is not None:
        r = returns.select("ticker", (F.col("t") + HOUR_US).alias("hour"), "r").unionByName(out.select("ticker", "hour").withColumn("r", F.lit(None).cast("double")).withColumn("_asof", F.lit(True)), allowMissingColumns=True)
        # closes of 31 days: the first of them has no return
        w = Window.partitionBy("ticker").orderBy("hour").rangeBetween(-(31 * 24 - 2) * HOUR_US, 0)
        vol = r.withColumn("vol_n", F.count("r").over(w)).withColumn("vol", F.stddev_samp("r").over(w)).where("_asof").select("ticker", "hour", "vol_n", "vol")
        out = out.join(vol, ["ticker", "hour"])
    if live is not None:
        # received in (hour - 1 h, hour], or at its very begin
        due = F.array_distinct(F.array(F.ceil(F.col("recv_micros") / HOUR_US) * HOUR_US, F.floor(F.col("recv_micros") / HOUR_US) * HOUR_US + HOUR_US))
        now = live.where("rate IS NOT NULL").withColumn("hour", F.explode(due)).groupBy("ticker", "hour").agg(F.max_by("rate", "recv_micros").alias("now"))
        out = out.join(now, ["ticker", "hour"], "left")
    m7 = {"carry_apr_7d": F.col("mean_7d") * year, "excess_apr_7d": (F.col("mean_7d") - base) * year, "positive_share_7d": F.when(week, F.col("positive")), "baseline_share_7d": F.when(week, F.col("at_base")), "zscore_7d": (z, z_why)}
    if returns is not None:
        v_why = F.when(~week, thin).when(F.col("vol_n") < min_returns, F.lit("too few hourly returns")).otherwise(F.lit("the hourly returns do not vary"))
        m7["carry_to_vol_7d"] = (F.when(week & (F.col("vol_n") >= min_returns) & (F.col("vol") > 0), F.col("mean_7d") * year / (F.col("vol") * year**0.5)), v_why)
    if live is not None:
        m7["nowcast_apr"] = (F.col("now") * year, F.lit("no live rate received in the hour before"))
    n = {"24h": {"carry_apr_24h": F.col("mean_24h") * year}, "7d": m7, "30d": {"carry_apr_30d": F.col("mean_30d") * year}}
    parts = [rows(m, name) for name, m in n.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _against_days(asofs: DataFrame, rates: DataFrame, coverage: float, z_days: int) -> DataFrame:
    """``asofs`` with mean and deviation (``day_mean``, ``day_sd``, ``days``) of the covered daily means of the ``z_days`` before their week.

    Days end at midnight.  The span's first and last day are cut at the hour, so these two are averaged from their (at most 24)
    hours; the days between come from a window over one row a day.
    """
    day_of = lambda c: F.floor((c - 1) / DAY_US)
    mean = lambda a: F.when(F.size(a) >= coverage * 24, F.aggregate(a, F.lit(0.0), lambda s, x: s + x["rate"]) / F.size(a))
    start = F.col("hour") - 168 * HOUR_US
    asofs = asofs.withColumn("_s", start).withColumn("_d", F.floor(start / DAY_US))
    daily = rates.where("rate IS NOT NULL").groupBy("ticker", day_of(F.col("hour")).alias("_d")).agg(F.collect_list(F.struct("hour", "rate")).alias("_h"))
    grid = daily.join(asofs.select("ticker", "_d").distinct(), ["ticker", "_d"], "full").withColumn("_m", mean(F.col("_h")))
    between = F.collect_list("_m").over(Window.partitionBy("ticker").orderBy("_d").rangeBetween(-(z_days - 1), -1))
    grid = grid.withColumn("_full", between)
    x = asofs.join(grid.select("ticker", "_d", "_full", F.col("_h").alias("_top")), ["ticker", "_d"], "left")
    x = x.join(daily.select("ticker", (F.col("_d") + z_days).alias("_d"), F.col("_h").alias("_low")), ["ticker", "_d"], "left")
    top = mean(F.filter("_top", lambda v: v["hour"] <= F.col("_s")))
    low = mean(F.filter("_low", lambda v: v["hour"] > F.col("_s") - z_days * DAY_US))
    x = x.withColumn("_a", F.concat("_full", F.array_compact(F.array(top, low)))).withColumn("days", F.size("_a"))
    x = x.withColumn("day_mean", F.aggregate("_a", F.lit(0.0), lambda s, v: s + v) / F.when(F.col("days") > 0, F.col("days")))
    square = F.aggregate("_a", F.lit(0.0), lambda s, v: s + (v - F.col("day_mean")) * (v - F.col("day_mean")))
    return x.withColumn("day_sd", F.sqrt(square / F.when(F.col("days") > 1, F.col("days") - 1))).drop("_s", "_d", "_full", "_top", "_low", "_a")


def flow(quotes: DataFrame, trades: DataFrame, bucket_us: int = 10_000_000, min_n: int = 100, extreme: float = 0.9, max_stand_us: int = HOUR_US) -> DataFrame:
    """Hourly order-flow imbalance over depth, fits of the mid's return on it and on trade imbalance, trade and queue imbalance; by venue and ticker.

    The fits are of bucket returns in bps on ofi / depth, and on trade imbalance.
    """
    key = ["venue", "ticker", "period"]
    at = (F.floor(F.col("bucket") / HOUR_US) * HOUR_US).alias("period")
    q = filters.valid_quotes(quotes)
    o = aggs.ofi(q, bucket_us).withColumn("x", F.col("ofi") / F.col("depth"))
    f = aggs.trade_flow(dedupe.dedupe_trades(trades), bucket_us, ("venue", "ticker")).withColumnRenamed("imbalance", "y")
    both = o.select("*", at).join(f.select("venue", "ticker", "bucket", "y"), ["venue", "ticker", "bucket"], "left")
    g = both.groupBy(*key).agg((F.sum("ofi") / F.avg("depth")).alias("norm"), F.regr_count("return_bps", "x").alias("n"), F.regr_slope("return_bps", "x").alias("slope"), F.regr_r2("return_bps", "x").alias("r2"), F.regr_count("return_bps", "y").alias("n_t"), F.regr_r2("return_bps", "y").alias("r2_t"))
    t = f.select("*", at).groupBy(*key).agg(((F.sum("buy") - F.sum("sell")) / (F.sum("buy") + F.sum("sell"))).alias("imb"))
    qi = q.withColumn("qi", (F.col("bid_sz") - F.col("ask_sz")) / (F.col("bid_sz") + F.col("ask_sz")))
    st = windows.stood(qi, ["venue", "ticker"], HOUR_US, max_stand_us, ["event_id"]).groupBy(*key)
    st = st.agg((F.sum(F.col("qi") * F.col("w")) / F.sum("w")).alias("qi"), (F.sum(F.when(F.abs("qi") > extreme, F.col("w")).otherwise(0)) / F.sum("w")).alias("far"))
    # one row a key from each of the three: put side by side by an aggregation, as any of them may miss an hour
    parts = dedupe.unify(g, t, st)
    g = parts.groupBy(*key).agg(*[F.max(c).alias(c) for c in parts.columns if c not in key])
    fit, fit_t = F.col("n") >= min_n, F.col("n_t") >= min_n
    measures = {"ofi_norm_1h": F.col("norm"), "ofi_beta_bps": F.when(fit, F.col("slope")), "ofi_r2": F.when(fit, F.col("r2")), "trade_imbalance_1h": F.col("imb"), "trade_r2": F.when(fit_t, F.col("r2_t")), "queue_imbalance_twa": F.col("qi"), "queue_imbalance_extreme_share": F.col("far")}
    return long_rows(g, "flow", "1h", measures, F.col("period") + HOUR_US, F.coalesce("n", F.lit(0)), venue=True)


def liquidity(quotes: DataFrame, trades: DataFrame, max_stand_us: int = HOUR_US, horizon_us: int = 5_000_000, covered_minutes: int = 48, z_days: int = 7, z_min: int = 72) -> DataFrame:
    """Hourly quoted spread and its z on the log scale against ``z_days`` before, depth, effective spread, impact after the horizon
    (where it has passed by the hour's end) and price impact per notional over 24 hours; by venue and ticker, hours with quotes or trades.
    """
    q = filters.valid_quotes(quotes).withColumn("mid", (F.col("bid_px") + F.col("ask_px")) / 2)
    q = q.withColumn("spread", (F.col("ask_px") - F.col("bid_px")) / F.col("mid") * 1e4).withColumn("depth", F.least(F.col("bid_px") * F.col("bid_sz"), F.col("ask_px") * F.col("ask_sz")))
    st, key = windows.stood(q, ["venue", "ticker"], HOUR_US, max_stand_us, ["event_id"]), ["venue", "ticker", "period"]
    depths = [aggs.weighted_quantile(st, "depth", x, key).withColumnRenamed("quantile", name) for name, x in (("depth_median", 0.5), ("depth_p10", 0.1))]
    s = aggs.time_weighted(st, "spread", key).withColumnRenamed("mean", "quoted").join(depths[0], key).join(depths[1], key)
    once = dedupe.dedupe_trades(trades)
    t = joins.asof_join(once, q.select("venue", "ticker", "t", "event_id", "mid"), ["venue", "ticker"], ["mid"]).drop("right_t")
    t = joins.asof_join(t, q.select("venue", "ticker", "t", "event_id", F.col("mid").alias("later")), ["venue", "ticker"], ["later"], shift_us=horizon_us)
    sign, hour = F.when(F.col("aggressor") == "bid", 1.0).otherwise(-1.0), F.floor(F.col("t") / HOUR_US) * HOUR_US
    known = F.when(F.col("t") + horizon_us <= hour + HOUR_US, F.col("later"))
    t = t.withColumn("notional", F.col("price") * F.col("size")).withColumn("eff", 2 * sign * (F.col("price") - F.col("mid")) / F.col("mid") * 1e4).withColumn("imp", F.when(F.col("mid").isNotNull(), 2 * sign * (known - F.col("mid")) / F.col("mid") * 1e4))
    mean = lambda c: F.sum(F.col(c) * F.col("notional")) / F.sum(F.when(F.col(c).isNotNull(), F.col("notional")))
    e = t.groupBy("venue", "ticker", hour.alias("period")).agg(mean("eff").alias("eff_vw"), F.avg("eff").alias("eff_ew"), mean("imp").alias("imp_vw"))
    all_ = s.join(e, key, "full")
    all_ = all_.join(aggs.trailing_amihud(once, all_), key, "left")
    ok = F.coalesce(F.col("covered") >= covered_minutes * 60_000_000, F.lit(False))
    all_ = all_.withColumn("log_quoted", F.when(ok & (F.col("quoted") > 0), F.log("quoted")))
    all_ = aggs.trailing_z(all_, "log_quoted", "log_quoted", ["venue", "ticker"], z_days * DAY_US, z_min)
    thin, none = F.lit("too little of the hour is covered"), F.lit("no trade with a quote before it")
    measures = {
        "quoted_spread_bps": (F.when(ok, F.col("quoted")), thin), "depth_usd_median": (F.when(ok, F.col("depth_median")), thin), "depth_usd_p10": (F.when(ok, F.col("depth_p10")), thin),
        "effective_spread_bps_vw": (F.col("eff_vw"), none), "effective_spread_bps_ew": (F.col("eff_ew"), none), "impact_bps_5s_vw": (F.col("imp_vw"), F.lit("no trade whose horizon had passed")),
        "amihud_24h": (F.col("amihud"), F.lit("no bucket with a return and notional")), "spread_z_7d": (F.col("z"), F.col("z_why")),
    }
    return long_rows(all_, "liquidity", "1h", measures, F.col("period") + HOUR_US, F.coalesce("covered", F.lit(0)) / 6e7, venue=True)


def moments(returns: DataFrame, period_us: int = DAY_US, min_n: int = 50, horizon: str = "1d", week: int = 7, min_periods: int = 4, sessioned: tuple[str, ...] = (), width_us: int = 300_000_000, closed_dates: Column | None = None) -> DataFrame:
    """Realised volatility, skewness and kurtosis of each period, and means of the last ``week`` periods' skewness and kurtosis.

    Of ``sessioned`` tickers only returns whose two bars (of ``width_us``) lie in the external session count.
    """
    inside = ~F.col("ticker").isin(*sessioned) | filters.both_in_session(width_us, closed_dates=closed_dates)
    m = aggs.realized_moments(returns.withColumn("r", F.when(inside, F.col("r"))) if sessioned else returns, period_us, min_n, thin=True)
    w = Window.partitionBy("ticker").orderBy("period").rangeBetween(-(week - 1) * period_us, 0)
    m = m.withColumn("weeks", F.count("skew").over(w)).withColumn("skew_mean", F.avg("skew").over(w)).withColumn("kurt_mean", F.avg("kurt").over(w))
    enough, few = F.col("weeks") >= min_periods, F.lit("too few periods with moments")
    one, all_ = horizon, f"{week * int(horizon[:-1])}{horizon[-1]}"
    measures = {f"realized_vol_{one}": F.col("vol"), f"realized_skew_{one}": F.col("skew"), f"realized_kurt_{one}": F.col("kurt"), f"realized_skew_{all_}": (F.when(enough, F.col("skew_mean")), few), f"realized_kurt_{all_}": (F.when(enough, F.col("kurt_mean")), few)}
    return long_rows(m, "moments", horizon, measures, F.col("period") + period_us, F.col("n"))


def jumps(returns: DataFrame, period_us: int = DAY_US, min_n: int = 259, k: int = 270, alpha: float = 0.01, factors: DataFrame | None = None, width_us: int = 300_000_000, tau_us: int = 6 * HOUR_US, days: int = 7) -> DataFrame:
    """At each period's end: the last return's statistic and whether it is a jump; the period's jumps up and down, their shares of
    its variance, the jump share and its z; and jump intensities with decay ``tau_us`` over the ``days`` before.

    Returns are judged over their hour's scale where ``factors`` (ticker, hour, factor) has one.
    """
    rows = returns.select("ticker", "t", "r", F.col("r").alias("raw"))
    if factors is not None:
        hour = F.floor(F.pmod("t", F.lit(DAY_US)) / HOUR_US).cast("int")
        rows = rows.withColumn("hour", hour).join(factors.select("ticker", "hour", "factor"), ["ticker", "hour"], "left").withColumn("r", F.col("r") / F.coalesce("factor", F.lit(1.0))).drop("hour", "factor")
    x = windows.lee_mykland(rows, k, alpha).withColumn("period", F.floor(F.col("t") / period_us) * period_us)
    up, down = F.col("jump") & (F.col("raw") > 0), F.col("jump") & (F.col("raw") < 0)
    of = lambda c: F.sum(F.when(c, F.col("raw") * F.col("raw")).otherwise(0.0))
    g = x.groupBy("ticker", "period").agg(F.count("raw").alias("n"), F.max_by("L", "t").alias("L"), F.max_by("jump", "t").cast("double").alias("jump"), F.count_if(up).alias("ups"), F.count_if(down).alias("downs"), of(up).alias("var_up"), of(down).alias("var_down"))
    g = g.join(aggs.jump_ratio(returns, period_us, min_n), ["ticker", "period"], "left").withColumn("asof", F.col("period") + period_us)
    # a jump is known at its bar's end, which may be the asof itself: both are asked one micro later
    ends, asofs = x.withColumn("t", F.col("t") + width_us), g.select("ticker", (F.col("asof") + 1).alias("asof"))
    for name, hit in (("up", up), ("down", down)):
        i = aggs.decay_intensity(ends.where(hit).select("ticker", "t"), asofs, tau_us, days)
        g = g.join(i.select("ticker", (F.col("asof") - 1).alias("asof"), F.col("intensity").alias(f"intensity_{name}")), ["ticker", "asof"], "left")
    enough, early = F.col("m").isNotNull(), F.lit("too few returns before the bar")
    thin = lambda c: F.when(enough, F.col(c))
    measures = {
        "L_last": (F.col("L"), early), "jump_last": (F.when(F.col("L").isNotNull(), F.col("jump")), early), "jumps_up_24h": thin("ups"), "jumps_down_24h": thin("downs"), "jump_share_24h": F.col("share"), "rj_z_24h": F.col("z"),
        "jump_var_up_24h": F.col("var_up") / F.col("rv"), "jump_var_down_24h": F.col("var_down") / F.col("rv"), "intensity_up": F.coalesce("intensity_up", F.lit(0.0)), "intensity_down": F.coalesce("intensity_down", F.lit(0.0)),
    }
    return long_rows(g, "jumps", "24h", measures, F.col("asof"), F.col("n"))


def varcov(returns: DataFrame, lam: float = 0.94, slot_us: int = DAY_US, horizon: str = "1d") -> DataFrame:
    """EWMA covariance (i <= j) and correlation (i < j) at the newest slot's end."""
    c = aggs.ewma_cov(joins.pairs(returns), lam, slot_us)
    var = c.where("i = j").select(F.col("i").alias("k"), F.col("cov").alias("v"))
    c = c.join(var.select(F.col("k").alias("i"), F.col("v").alias("vi")), "i").join(var.select(F.col("k").alias("j"), F.col("v").alias("vj")), "j")
    asof = returns.agg(F.max("t") + slot_us).first()[0]
    cov = long_rows(c, "varcov", horizon, {"covariance": F.col("cov")}, F.lit(asof).cast("long"), F.col("n_eff"), "i", "j")
    cor = long_rows(c.where("i < j"), "varcov", horizon, {"correlation": F.col("cov") / F.sqrt(F.col("vi") * F.col("vj"))}, F.lit(asof).cast("long"), F.col("n_eff"), "i", "j")
    return cov.unionByName(cor)


def tail(returns: DataFrame, min_n: int = 1000, horizon: str = "1d", lam: float = 0.94, burn: int = 30, slot_us: int = DAY_US, days: int = 365) -> DataFrame:
    """One-bar-ahead value at risk and expected shortfall by filtered historical simulation, as positive log-return losses.

    The residuals are the last ``days`` of returns (of ``slot_us`` each) over their own EWMA volatility (after ``burn`` rows); their
    quantiles times the next bar's volatility are the figures.  Instruments with under ``min_n`` are absent.
    """
    window = days * DAY_US // slot_us
    v = aggs.ewma_variance(returns, lam)
    top = v.where("r IS NULL").select("ticker", F.sqrt("s2").alias("next"), F.col("i").alias("end"), F.col("t").alias("asof"))
    z = v.where((F.col("i") > burn) & (F.col("s2") > 0)).withColumn("z", F.col("r") / F.sqrt("s2")).join(top, "ticker").where((F.col("i") >= F.col("end") - window) & F.col("z").isNotNull())
    q = z.groupBy("ticker", "next", "asof").agg(F.count("z").alias("n"), F.expr("percentile(z, 0.01)").alias("q01"), F.expr("percentile(z, 0.025)").alias("q025"))
    es = z.select("ticker", "z").join(q.select("ticker", "q025"), "ticker").where("z <= q025").groupBy("ticker").agg(F.avg("z").alias("es"))
    q, ok = q.join(es, "ticker"), (F.col("n") >= min_n) & (F.col("next") > 0)
    loss = lambda c: F.when(ok, -F.col("next") * F.col(c))
    return long_rows(q, "tail", horizon, {"sigma_next": F.when(ok, F.col("next")), "var_99": loss("q01"), "var_975": loss("q025"), "es_975": loss("es"), "es_to_var": F.when(ok & (F.col("q01") < 0), F.col("es") / F.col("q01"))}, F.col("asof"), F.col("n"))


def betas(returns: DataFrame, reference: str, lam: float = 0.94, slot_us: int = DAY_US, horizon: str = "1d") -> DataFrame:
    """Beta to the reference and the idiosyncratic share of variance, from the EWMA covariance; nothing without the reference."""
    c = aggs.ewma_cov(joins.pairs(returns), lam, slot_us)
    var = c.where("i = j").select(F.col("i").alias("ticker"), F.col("cov").alias("v"))
    ref = var.where(F.col("ticker") == reference).select(F.lit(reference).alias("ref"), F.col("v").alias("v_ref"))
    other = F.when(F.col("i") == reference, F.col("j")).otherwise(F.col("i"))
    with_ref = c.where((F.col("i") != F.col("j")) & ((F.col("i") == reference) | (F.col("j") == reference))).select(other.alias("ticker"), F.lit(reference).alias("ref"), "cov", "n_eff")
    rows = with_ref.join(var, "ticker").join(ref, "ref").withColumn("ok", (F.col("v") > 0) & (F.col("v_ref") > 0))
    asof = returns.agg(F.max("t") + slot_us).first()[0]
    beta = F.when(F.col("ok"), F.col("cov") / F.col("v_ref"))
    share = F.when(F.col("ok"), 1 - F.col("cov") * F.col("cov") / (F.col("v") * F.col("v_ref")))
    return long_rows(rows, "beta", horizon, {"beta": beta, "idiosyncratic_share": share}, F.lit(asof).cast("long"), F.col("n_eff"), "ticker", "ref", why="a variance is not positive")


def derive(returns: DataFrame, bucket_us: int, min_n: int, z: float = 1.96, reference: str | None = None, horizon: str = "all") -> DataFrame:
    """Table of statistics: volatility of each instrument, correlation and interval of each pair, beta to the reference.

    A figure with fewer observations than the floor is absent and names the thinner instrument (of two
    equally thin ones the first; for beta the one that isn't the reference).  Pairs are formed after
    aggregation, one row for each instrument.
    """
    least, year = max(min_n, 2), (365 * 86_400e6 / bucket_us) ** 0.5
    why = lambda who, n: F.concat(who, F.lit(" has "), n.cast("string"), F.lit(f" of {min_n} observations"))
    each = returns.groupBy("ticker").agg(F.count("r").alias("n"), F.stddev_samp("r").alias("sd"), (F.max("t") + bucket_us).alias("asof"))
    n = F.col("n")
    out = long_rows(each, "derive", horizon, {"volatility": F.when(n >= least, F.col("sd") * year)}, F.col("asof"), n, why=why(F.col("ticker"), n))
    joint = joins.pairs(returns).where("i < j").groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.corr("ri", "rj").alias("rho"), F.regr_slope("ri", "rj").alias("i_on_j"), F.regr_slope("rj", "ri").alias("j_on_i"))
    a, b = (each.select(F.col("ticker").alias(k), F.col("n").alias(f"n_{k}"), F.col("asof").alias(f"asof_{k}")) for k in "ij")
    pairs = a.join(b, F.col("i") < F.col("j")).join(joint, ["i", "j"], "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("asof", F.greatest("asof_i", "asof_j"))
    enough = n >= least
    side = lambda s: F.when(enough & (n > 3), F.tanh(fisher_z(F.col("rho")) + s * z / F.sqrt(n - 3)))
    thin = F.when(F.col("n_i") <= F.col("n_j"), F.col("i")).otherwise(F.col("j"))
    out = out.unionByName(long_rows(pairs, "derive", horizon, {"correlation": F.when(enough, F.col("rho")), "correlation_low": side(-1), "correlation_high": side(1)}, F.col("asof"), n, "i", "j", why=why(thin, n)))
    if "backfilled" in returns.columns:
        late = returns.where("r IS NOT NULL").withColumn("r", F.col("backfilled").cast("double"))
        alone = late.groupBy("ticker").agg(F.avg("r").alias("share")).join(each, "ticker")
        out = out.unionByName(long_rows(alone, "derive", horizon, {"backfilled_share": F.when(n >= least, F.col("share"))}, F.col("asof"), n, why=why(F.col("ticker"), n)))
        either = joins.pairs(late, own=False).groupBy("i", "j").agg(F.avg(F.greatest("ri", "rj")).alias("share"))
        both = pairs.join(either, ["i", "j"], "left")
        out = out.unionByName(long_rows(both, "derive", horizon, {"backfilled_share": F.when(enough, F.col("share"))}, F.col("asof"), n, "i", "j", why=why(thin, n)))
    if reference is None:
        return out
    is_j = F.col("j") == reference
    with_ref = pairs.where(is_j | (F.col("i") == reference)).select(F.when(is_j, F.col("i")).otherwise(F.col("j")).alias("own"), F.lit(reference).alias("ref"), F.when(is_j, F.col("n_i")).otherwise(F.col("n_j")).alias("n_own"), F.when(is_j, F.col("n_j")).otherwise(F.col("n_i")).alias("n_ref"), F.when(is_j, F.col("i_on_j")).otherwise(F.col("j_on_i")).alias("slope"), "n", "asof")
    thin = F.when(F.col("n_own") <= F.col("n_ref"), F.col("own")).otherwise(F.col("ref"))
    return out.unionByName(long_rows(with_ref, "derive", horizon, {"beta": F.when(n >= least, F.col("slope"))}, F.col("asof"), n, "own", "ref", why=why(thin, n)))
