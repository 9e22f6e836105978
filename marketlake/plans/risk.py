"""Composed signals of risk: realized-volatility forecasts, regimes of correlation, derived matrices, lead-lag, cascades, backtests.

Long rows as in :mod:`marketlake.plans.signals`; ``*`` stands for all instruments together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import HOUR_US, chi2_tail
from marketlake.operators import aggs, filters, joins, leadlag, models
from marketlake.plans.signals import DAY_US, long_rows

EVERYONE = "*"
MINUTE_US = 60_000_000


def realvol(returns: DataFrame, period_us: int = DAY_US, expected: int = 24, week: int = 7, month: int = 30, min_train: int = 100, judge: int = 60, horizon: str = "1d", asof_us: int | None = None) -> DataFrame:
    """Forecasts of the next period's and the next ``week`` periods' volatility as of the newest period's end, the last period's own, and their losses.

    ``qlike_*``: over the last ``judge`` origins, the loss of the walk-forward forecast, of the period before, and of the mean
    of ``month`` periods.
    """
    periods = models.realized(returns, period_us, expected)
    whole = periods.where("whole")
    if asof_us is None:
        asof_us = periods.agg(F.max("t") + period_us).first()[0] or 0
    at = asof_us - period_us
    whole = whole.where(F.col("t") <= at)
    one = models.harq(whole, period_us, 1, week, month, min_train)
    many = models.harq(whole, period_us, week, week, month, min_train).where(F.col("t") == at).select("ticker", F.col("forecast").alias("f_many"))
    newest = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("t")))
    one = one.withColumn("_k", newest)
    judged = one.where((F.col("_k") > 1) & (F.col("_k") <= judge + 1) & (F.col("forecast") > 0) & (F.col("y") > 0) & (F.col("rv") > 0) & (F.col("month") > 0))
    loss = lambda f: F.avg(F.col("y") / F.col(f) - F.log(F.col("y") / F.col(f)) - 1)
    judged = judged.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_judged"), loss("forecast").alias("q_harq"), loss("rv").alias("q_naive"), loss("month").alias("q_month"))
    now = one.where(F.col("t") == at).select("ticker", "rv", "month", "forecast")
    table = periods.select("ticker").distinct().join(whole.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")), "ticker", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    table = table.join(now, "ticker", "left").join(many, "ticker", "left").join(judged, "ticker", "left")
    need = min_train + month + judge
    enough = F.col("rv").isNotNull() & (F.col("n") >= need)
    why = F.when(F.col("rv").isNull(), F.lit("the period to the asof is not whole")).when(F.col("n") < need, F.concat(F.col("n").cast("string"), F.lit(f" whole periods, under {need}")))
    short = F.coalesce(why, F.lit("not enough closed targets to train on"))
    never = F.coalesce(why, F.lit("no earlier forecast has its period closed"))
    w = lambda c: F.when(enough, c)
    m = {
        f"sigma_{horizon}": (w(F.sqrt("forecast")), short), f"sigma_{week}{horizon[1:]}": (w(F.sqrt("f_many")), short),
        f"rv_sigma_{horizon}": (w(F.sqrt("rv")), short), "vol_term": (w(F.col("rv") / F.when(F.col("month") > 0, F.col("month"))), short),
        "qlike_harq": (w(F.col("q_harq")), never), "qlike_naive": (w(F.col("q_naive")), never), f"qlike_mean{month}": (w(F.col("q_month")), never),
    }
    return long_rows(table, "realvol", horizon, m, F.lit(asof_us).cast("long"), F.col("n"))


def joint_residuals(returns: DataFrame, lam: float = 0.94, burn: int = 30) -> DataFrame:
    """EWMA residuals at slots where every instrument of ``returns`` has one."""
    z = models.residuals(aggs.ewma_variance(returns.where("r IS NOT NULL"), lam), burn)
    tickers = z.select("ticker").distinct().count()
    return joins.joint_returns(z, tickers)


def monitor(z: DataFrame, slot_us: int, epoch_days: int, critical: float, horizon: str = "1d", reach: float = 1.5, gamma: float = 0.25) -> DataFrame:
    """Ratio of each pair and of all, the alarm, and the close of the slot that an alarm dates the change to, at the newest slot's end."""
    z = z.withColumn("t", F.col("t") + slot_us)
    asof = z.agg(F.max("t")).first()[0] or 0
    pairs = models.correlation_monitor(z, epoch_days * DAY_US, asof, critical, reach, gamma)
    all_ = pairs.groupBy().agg(F.max("ratio").alias("ratio"), F.max("k").alias("k"), F.min(F.struct("first", "change")).alias("_f"), F.min(F.when(F.col("first").isNotNull(), F.struct("first", "i", "j", "change"))).alias("_a"))
    all_ = all_.select(F.lit(EVERYONE).alias("i"), F.lit(None).cast("string").alias("j"), "ratio", "k", F.when(F.col("ratio").isNotNull(), (F.col("ratio") > 1).cast("double")).alias("alarm"), F.col("_a.change").alias("change"))
    none = F.lit("no baseline, or nothing after it")
    m = {"wied_galeano_ratio": (F.col("ratio"), none), "wied_galeano_alarm": (F.col("alarm"), none), "change_at_micros": (F.col("change").cast("double"), F.lit("no alarm"))}
    at = F.lit(asof).cast("long")
    return long_rows(all_, "monitor", horizon, m, at, F.col("k"), "i", "j").unionByName(long_rows(pairs, "monitor", horizon, {"wied_galeano_ratio": F.col("ratio")}, at, F.col("k"), "i", "j"))


def constancy(z: DataFrame, slot_us: int, days: int = 30, lags: int = 5, horizon: str = "1d") -> DataFrame:
    """The test of a constant correlation over the last ``days``, at the newest slot's end."""
    last = z.agg(F.max("t")).first()[0] or 0
    c = models.constancy(z, last + slot_us - days * DAY_US, lags=lags).withColumn("i", F.lit(EVERYONE))
    why = F.coalesce("reason", F.lit("not defined"))
    return long_rows(c, "constancy", horizon, {"engle_sheppard_stat": (F.col("statistic"), why), "engle_sheppard_p": (F.col("p_value"), why)}, F.lit(last + slot_us).cast("long"), F.col("n"), "i")


def derived(returns: DataFrame, slot_us: int = DAY_US, lam: float = 0.94, horizon: str = "1d") -> DataFrame:
    """Absorption of the newest covariance, surprise of the last slot against the covariance before it, and turbulence of the last slot in the sample."""
    joint = joins.joint_returns(returns.where("r IS NOT NULL"), returns.select("ticker").distinct().count()).select("t", "ticker", "r")
    told = joint.agg(F.max("t").alias("last"), F.count_distinct("ticker").alias("n"), F.count_distinct("t").alias("slots")).first()
    last, n, slots = told["last"] or 0, told["n"], told["slots"]
    paired = joins.pairs(joint)
    now = aggs.ewma_cov(paired, lam, slot_us).withColumn("of", F.lit("now"))
    before = aggs.ewma_cov(paired.where(F.col("t") < last), lam, slot_us).withColumn("of", F.lit("before"))
    mean = joint.groupBy("ticker").agg(F.avg("r").alias("_m"))
    sample = paired.groupBy("i", "j").agg(F.covar_samp("ri", "rj").alias("cov")).withColumn("of", F.lit("sample"))
    cov = now.select("of", "i", "j", "cov").unionByName(before.select("of", "i", "j", "cov")).unionByName(sample.select("of", "i", "j", "cov"))
    figures = models.matrix_figures(cov, ["of"])
    x = joint.where(F.col("t") == last).select(F.lit("before").alias("of"), "t", "ticker", F.col("r").alias("x"))
    x = x.unionByName(joint.join(mean, "ticker").select(F.lit("sample").alias("of"), "t", "ticker", (F.col("r") - F.col("_m")).alias("x")))
    d = models.quadratic_form(x, figures.where("what = 'inverse'"), ["of"])
    # the few figures, side by side in one row
    ratio = figures.where("of = 'now' AND what IN ('covariance_ar', 'correlation_ar')").select("what", "v")
    own = before.where("i = j").select(F.col("i").alias("ticker"), "cov").join(joint.where(F.col("t") == last), "ticker").select(F.lit("magnitude").alias("what"), (F.col("r") * F.col("r") / F.when(F.col("cov") > 0, F.col("cov"))).alias("v"))
    # one row a slot: the last slot's figure next to each
    d = d.withColumn("_d", F.max_by("d", "t").over(Window.partitionBy("of")))
    far = F.when(F.col("of") == "sample", F.lit("turbulence")).otherwise(F.lit("mahalanobis"))
    found = d.select(F.explode(F.array(F.struct(far.alias("what"), F.col("_d").alias("v")), F.struct(F.when(F.col("of") == "sample", F.lit("percentile")).alias("what"), (F.col("d") <= F.col("_d")).cast("double").alias("v")))).alias("s")).select("s.what", "s.v")
    names = ("covariance_ar", "correlation_ar", "magnitude", "mahalanobis", "turbulence", "percentile")
    one = ratio.unionByName(own).unionByName(found).groupBy().agg(*[F.avg(F.when(F.col("what") == c, F.col("v"))).alias(c) for c in names])
    one = one.withColumn("i", F.lit(EVERYONE))
    at, k = F.lit(last + slot_us).cast("long"), F.lit(slots)
    pd_ = F.lit("the covariance matrix is not positive definite")
    absorbed = {c: (F.col(c), F.lit("a variance is not positive")) for c in ("covariance_ar", "correlation_ar")}
    moved = F.when(F.col("magnitude") > 1e-12, F.col("mahalanobis") / n / F.col("magnitude")) if n else F.lit(None).cast("double")
    surprise = {
        "mahalanobis": (F.col("mahalanobis"), pd_), "chi2_percentile": (1 - chi2_tail(F.greatest("mahalanobis", F.lit(0.0)), max(n, 1)), pd_),
        "magnitude_surprise": (F.when(F.col("mahalanobis").isNotNull(), F.col("magnitude")), pd_),
        "correlation_surprise": (moved, F.when(F.col("mahalanobis").isNull(), pd_).otherwise(F.lit("no magnitude to divide by: no instrument moved"))),
    }
    few = F.lit(f"{slots} joint returns cannot estimate a {n} x {n} covariance") if slots <= n else pd_
    keep = lambda c: F.when(F.lit(slots > n), F.col(c))
    turbulence = {c: (keep(c), few) for c in ("turbulence", "percentile")}
    rows = long_rows(one, "absorption", horizon, absorbed, at, k, "i")
    return rows.unionByName(long_rows(one, "surprise", horizon, surprise, at, k, "i")).unionByName(long_rows(one, "turbulence", horizon, turbulence, at, k, "i"))


#: Lags of the lead-lag grid in milliseconds, to either side (fixed values).
GRID_MS = (0, 1, 100, 200, 300, 400, 500, 600, 700, 800, 900, 1000, 2000, 3000, 4000, 5000, 6000, 7000, 8000, 9000, 10000, 15000, 20000, 30000)


def lead_lag(quotes: DataFrame, leader: str, lags_us: Sequence[int] | None = None, period_us: int = HOUR_US, min_ticks: int = 300, block_us: int = 100_000, step_us: int = 1_000, bucket_us: int = MINUTE_US, horizon: str = "1h") -> DataFrame:
    """Hourly lead of an instrument over every other one: its size, correlations and the contrast of either side."""
    lags = sorted({1000 * s * g for g in GRID_MS for s in (1, -1)}) if lags_us is None else lags_us
    of = leadlag.ticks(filters.valid_quotes(quotes), period_us)
    g = leadlag.lead_lag(of, leader, lags, block_us, step_us, bucket_us).withColumn("leader", F.lit(leader))
    ok = F.col("n") >= min_ticks
    few = F.concat(F.lit(f"{leader} has "), F.col("n_lead").cast("string"), F.lit(" and "), F.col("follower"), F.lit(" "), F.col("n_other").cast("string"), F.lit(f" quote updates, under {min_ticks}"))
    why = F.when(~ok, few).otherwise(F.lit("not defined"))
    v = {"lead_ms": F.col("lead_us") / 1000, "rho_lead": F.col("rho_lead"), "rho_0": F.col("rho_0"), "llr": F.col("llr"), "rho_leader_first": F.col("rho_leader_first"), "rho_other_first": F.col("rho_other_first"), "block_asymmetry": F.col("block_asymmetry")}
    return long_rows(g, "leadlag", horizon, {k: F.when(ok, c) for k, c in v.items()}, F.col("period") + period_us, F.col("n"), "leader", "follower", why)


def cascade_steps(marks: DataFrame, step_us: int = MINUTE_US) -> DataFrame:
    """Last mark and open interest of each step, log changes of both to the step before (null without it), and the interest closed."""
    s = marks.where("mark > 0 AND open_interest > 0").groupBy("ticker", (F.floor(F.col("t") / step_us) * step_us).alias("t"))
    s = s.agg(F.max_by(F.struct("mark", "open_interest"), F.struct("t", "event_id")).alias("s")).select("ticker", "t", "s.mark", "s.open_interest")
    b = s.select("ticker", (F.col("t") + step_us).alias("t"), F.col("mark").alias("m0"), F.col("open_interest").alias("o0"))
    s = s.join(b, ["ticker", "t"], "left")
    return s.select("ticker", "t", "mark", "open_interest", F.log(F.col("mark") / F.col("m0")).alias("r"), F.log(F.col("open_interest") / F.col("o0")).alias("d"), (F.col("o0") - F.col("open_interest")).alias("closed"))


def cascade(marks: DataFrame, step_us: int = MINUTE_US, period_us: int = HOUR_US, trail: int = 24, trail_floor: int = 720, z: float = 4.0, floor_usd: float = 250_000.0, floor_share: float = 0.0025, gap: int = 2, event_share: float = 0.01, horizon: str = "1h") -> DataFrame:
    """Liquidation cascades of each period: steps whose price and open interest both move far against the ``trail`` periods before.

    Flagged steps of one side, at most ``gap`` steps without one apart and no step of the other side between, are one event; it counts
    when it closed at least ``event_share`` of the interest standing before its first step.  Events end with the period.
    """
    s = cascade_steps(marks, step_us).withColumn("period", F.floor(F.col("t") / period_us) * period_us)
    hours = s.groupBy("ticker", "period").agg(F.count(F.lit(1)).alias("n"), F.count("r").alias("n_r"), F.avg(F.col("open_interest") * F.col("mark")).alias("oi_usd"))
    moved = s.where("r IS NOT NULL")
    past = moved.select("ticker", F.explode(F.transform(F.sequence(F.lit(1), F.lit(trail)), lambda k: F.col("period") + k * period_us)).alias("period"), "r", "d").join(hours.select("ticker", "period"), ["ticker", "period"])
    key = ["ticker", "period"]
    mid = past.groupBy(*key).agg(F.count(F.lit(1)).alias("n_trail"), *[F.expr(f"percentile({c}, 0.5)").alias(f"m_{c}") for c in "rd"])
    scale = past.join(mid, key).groupBy(*key, "n_trail", "m_r", "m_d").agg(*[(1.4826 * F.expr(f"percentile(abs({c} - m_{c}), 0.5)")).alias(f"s_{c}") for c in "rd"])
    now = moved.join(scale.where((F.col("n_trail") >= trail_floor) & (F.col("s_r") > 0) & (F.col("s_d") > 0)), key)
    now = now.withColumn("z_r", (F.col("r") - F.col("m_r")) / F.col("s_r")).withColumn("z_d", (F.col("d") - F.col("m_d")) / F.col("s_d")).withColumn("usd", F.greatest("closed", F.lit(0.0)) * F.col("mark"))
    joint = now.groupBy(*key).agg(F.max(F.when(F.col("z_d") < 0, F.least(F.abs("z_r"), -F.col("z_d"))).otherwise(0.0)).alias("joint"))
    floor = F.greatest(F.lit(floor_usd), floor_share * F.col("open_interest") * F.col("mark"))
    hit = now.where((F.col("z_d") <= -z) & (F.col("usd") >= floor) & (F.abs("z_r") >= z)).withColumn("side", F.when(F.col("z_r") < 0, F.lit("long")).otherwise(F.lit("short")))
    by = Window.partitionBy(*key).orderBy("t")  # a period has at most period / step rows
    same = (F.lag("side").over(by) == F.col("side")) & (F.col("t") - F.lag("t").over(by) <= (gap + 1) * step_us)
    hit = hit.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("event", F.sum("_new").over(by))
    ev = hit.groupBy(*key, "event", "side").agg(F.sum("usd").alias("usd"), F.sum("closed").alias("coins"), F.min_by(F.col("open_interest") + F.col("closed"), "t").alias("standing")).where(F.col("coins") >= event_share * F.col("standing"))
    side = lambda k: F.sum(F.when(F.col("side") == k, F.col("usd")).otherwise(0.0)).alias(k)
    ev = ev.groupBy(*key).agg(side("long"), side("short"), F.count(F.lit(1)).alias("events"), F.max("usd").alias("largest"))
    out = hours.join(scale, key, "left").join(joint, key, "left").join(ev, key, "left").withColumn("n_trail", F.coalesce("n_trail", F.lit(0)))
    steady = (F.col("n_trail") >= trail_floor) & (F.col("s_r") > 0) & (F.col("s_d") > 0)
    ok = steady & (F.col("n_r") > 0)
    why = F.when(F.col("n_trail") < trail_floor, F.concat(F.col("n_trail").cast("string"), F.lit(f" consecutive steps in the trail, under {trail_floor}"))).when(~F.coalesce(steady, F.lit(False)), F.lit("the trailing steps do not vary")).when(F.col("n_r") == 0, F.lit("no consecutive steps in the period")).otherwise(F.lit("no open interest"))
    zero = lambda c: F.when(ok, F.coalesce(c, F.lit(0.0)))
    both = F.coalesce("long", F.lit(0.0)) + F.coalesce("short", F.lit(0.0))
    m = {"liq_long_usd": zero("long"), "liq_short_usd": zero("short"), "liq_intensity": F.when(ok & (F.col("oi_usd") > 0), both / F.col("oi_usd")), "cascade_events": zero(F.col("events").cast("double")), "largest_event_usd": zero("largest"), "max_joint_z": zero("joint")}
    return long_rows(out, "cascade", horizon, m, F.col("period") + period_us, F.col("n"), why=why)


def backtest(tails: DataFrame, returns: DataFrame, slot_us: int = DAY_US, days: int = 90, min_n: int = 250, horizon: str = "1d", asof_us: int | None = None) -> DataFrame:
    """Stored forecasts (``ticker, asof, var_975, es_975, var_99``) of the last ``days`` against the bars that followed them.

    The forecast made at ``asof`` is of the bar that begins there; bars still open at the end do not count.
    """
    if asof_us is None:
        asof_us = returns.agg(F.max("t") + slot_us).first()[0] or 0
    span = (F.col("asof") >= asof_us - days * DAY_US) & (F.col("asof") < asof_us)
    mine = tails.where(span)
    m = joins.match_tails(mine, returns.where("r IS NOT NULL")).where(F.col("asof") + slot_us <= asof_us)
    m = m.where("var_975 > 0 AND es_975 >= var_975 AND var_99 IS NOT NULL")
    a = models.var_backtest(m.select("ticker", "asof", "r", F.col("var_975").alias("var"), F.col("es_975").alias("es")), 0.025)
    b = models.var_backtest(m.select("ticker", "asof", "r", F.col("var_99").alias("var"), F.col("var_99").alias("es")), 0.01)
    names = ("hit_rate", "kupiec_p", "cc_p", "dq_p", "z2")
    g = mine.select("ticker").distinct().join(a.select("ticker", "n", *[F.col(c).alias(f"{c}_975") for c in names]), "ticker", "left")
    g = g.join(b.select("ticker", *[F.col(c).alias(f"{c}_99") for c in names[:3]]), "ticker", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    few = F.when(F.col("n") < min_n, F.concat(F.col("n").cast("string"), F.lit(f" forecasts matched with their bar in the {days} days, under {min_n}")))
    measures = {c: (F.when(F.col("n") >= min_n, F.col(c)), F.coalesce(few, F.lit("no hit: coverage is undefined") if "kupiec" in c or "cc_" in c else F.lit("not defined"))) for c in ("n", "hit_rate_975", "kupiec_p_975", "cc_p_975", "dq_p_975", "z2_975", "hit_rate_99", "kupiec_p_99", "cc_p_99")}
    return long_rows(g, "backtest", horizon, measures, F.lit(asof_us).cast("long"), F.col("n"))
