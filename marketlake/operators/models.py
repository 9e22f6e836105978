"""Forecasts and tests of volatility and correlation: sums are made by Spark, small systems are solved in SQL expressions.

Rows here are closed periods and slots (a day, a bar), so a window over an instrument or a pair holds as
many rows as the calendar has periods, whatever the number of ticks below them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import chi2_tail


def total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def over(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.when(b != 0, b)


def solve(df: DataFrame, rows: Sequence[Sequence[Column]], out: str) -> DataFrame:
    """``df`` with the solution (array) of a system of n rows of n coefficients and a right side; null where it has none.

    Elimination below and above each pivot, one projection a pivot; the systems are normal equations, so pivots need no exchange.
    """
    m, n = "_system", len(rows)
    df = df.withColumn(m, F.array(*[F.array(*[c.cast("double") for c in r]) for r in rows]))

    def without(k: int, pivot: Column):
        return lambda row, i: F.when(i == k, row).otherwise(F.zip_with(row, pivot, lambda x, y: x - over(row[k], pivot[k]) * y))

    for k in range(n):
        df = df.withColumn(m, F.transform(m, without(k, F.col(m)[k])))
    return df.withColumn(out, F.array(*[over(F.col(m)[i][n], F.col(m)[i][i]) for i in range(n)])).drop(m)


def realized(returns: DataFrame, period_us: int, expected: int) -> DataFrame:
    """Realized variance and quarticity (n / 3 sum r^4) of each (ticker, period); ``whole``: all ``expected`` returns are there."""
    g = returns.where("r IS NOT NULL").groupBy("ticker", (F.floor(F.col("t") / period_us) * period_us).alias("t"))
    r = F.col("r")
    g = g.agg(F.sum(r * r).alias("rv"), F.sum(r * r * r * r).alias("_4"), F.count(F.lit(1)).alias("n"))
    return g.select("ticker", "t", "rv", (F.col("_4") * F.col("n") / 3).alias("rq"), "n", (F.col("n") >= expected).alias("whole"))


HARQ = ("one", "rv", "noisy", "week", "month")


def harq(days: DataFrame, day_us: int, horizon: int = 1, week: int = 7, month: int = 30, min_train: int = 100) -> DataFrame:
    """Walk-forward forecasts of the variance summed over the next ``horizon`` days, one row for each whole day (``ticker, t, rv, rq``).

    The regression is on the day's variance, the variance times the root of its quarticity, and the means of
    the last ``week`` and ``month`` whole days.  An origin uses only days whose target has closed by then: their
    normal equations are running sums.  A forecast outside the range of those targets becomes their mean
    (``filtered``); with under ``min_train`` of them there is none.  ``y``: what followed, null if a day of it is not whole.
    """
    by = Window.partitionBy("ticker").orderBy("t")
    mean = lambda k: F.when(F.count("rv").over(by.rowsBetween(1 - k, 0)) == k, F.avg("rv").over(by.rowsBetween(1 - k, 0)))
    ahead = by.rangeBetween(day_us, horizon * day_us)
    x = days.select("ticker", "t", "rv", F.lit(1.0).alias("one"), (F.col("rv") * F.sqrt("rq")).alias("noisy"), mean(week).alias("week"), mean(month).alias("month"), F.when(F.count("rv").over(ahead) == horizon, F.sum("rv").over(ahead)).alias("y"))
    x = x.withColumn("_y", F.when(F.col("month").isNotNull() & F.col("week").isNotNull(), F.col("y")))
    known = by.rangeBetween(Window.unboundedPreceding, -horizon * day_us)
    sums = {f"_{i}{j}": F.sum(F.when(F.col("_y").isNotNull(), F.col(HARQ[i]) * F.col(HARQ[j]))).over(known) for i in range(5) for j in range(i, 5)}
    sums |= {f"_{i}y": F.sum(F.col(HARQ[i]) * F.col("_y")).over(known) for i in range(5)}
    sums |= {"n_train": F.count("_y").over(known), "_low": F.min("_y").over(known), "_high": F.max("_y").over(known), "_mean": F.avg("_y").over(known)}
    x = x.withColumns(sums)
    x = solve(x, [[*[F.col(f"_{min(i, j)}{max(i, j)}") for j in range(5)], F.col(f"_{i}y")] for i in range(5)], "beta")
    raw = total([F.col("beta")[i] * F.col(c) for i, c in enumerate(HARQ)])
    x = x.withColumn("_raw", raw).withColumn("filtered", F.when(F.col("n_train") >= min_train, ~F.col("_raw").between(F.col("_low"), F.col("_high"))))
    f = F.when((F.col("n_train") >= min_train) & F.col("_raw").isNotNull(), F.when(F.col("filtered"), F.col("_mean")).otherwise(F.col("_raw")))
    return x.select("ticker", "t", "rv", "month", "y", f.alias("forecast"), "filtered", "n_train")


def residuals(variances: DataFrame, burn: int = 30) -> DataFrame:
    """Returns over the volatility known before them (rows of ``aggs.ewma_variance``), after ``burn`` rows of an instrument."""
    return variances.where((F.col("i") > burn) & (F.col("s2") > 0) & F.col("r").isNotNull()).select("ticker", "t", (F.col("r") / F.sqrt("s2")).alias("z"))


def _pairs(z: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    a = z.select(*keys, "t", F.col("ticker").alias("i"), F.col("z").alias("a"))
    b = z.select(*keys, "t", F.col("ticker").alias("j"), F.col("z").alias("b"))
    return a.join(b, [*keys, "t"]).where("i < j")


def correlation_monitor(z: DataFrame, epoch_us: int, asof_us: int, critical: float, reach: float = 1.5, gamma: float = 0.25) -> DataFrame:
    """Fluctuation of each pair's correlation in the epoch that holds ``asof_us`` against the epoch before it.

    With m slots in the baseline and correlation rho there, the k-th slot after it gives
    (k / sqrt m) |rho_k - rho| / s over critical (1 + k/m) (k / (k + m))^gamma, where rho_k is the correlation of
    the k slots and s the deviation of rho's influence.  ``ratio`` is its maximum over k <= reach m; above 1 it
    is an alarm, at ``first``; ``change``: where the correlations up to then differ most from the one at the alarm.
    """
    start = asof_us // epoch_us * epoch_us
    p = _pairs(z.where((F.col("t") > start - epoch_us) & (F.col("t") <= asof_us)))
    base = p.where(F.col("t") <= start)
    m = base.groupBy("i", "j").agg(F.count(F.lit(1)).alias("m"), F.corr("a", "b").alias("rho"), F.avg("a").alias("ma"), F.avg("b").alias("mb"), F.stddev_pop("a").alias("sa"), F.stddev_pop("b").alias("sb"))
    m = m.where("m > 1 AND sa > 0 AND sb > 0")
    u, v = (F.col("a") - F.col("ma")) / F.col("sa"), (F.col("b") - F.col("mb")) / F.col("sb")
    spread = base.join(m, ["i", "j"]).groupBy("i", "j", "m", "rho").agg(F.sqrt(F.avg(F.pow(u * v - F.col("rho") / 2 * (u * u + v * v), F.lit(2.0)))).alias("s"))
    now = p.where(F.col("t") > start)
    w = Window.partitionBy("i", "j").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    now = now.select("i", "j", "t", F.row_number().over(Window.partitionBy("i", "j").orderBy("t")).alias("k"), F.corr("a", "b").over(w).alias("c"))
    now = now.join(spread.where("s > 0"), ["i", "j"]).where((F.col("k") <= reach * F.col("m")) & (F.col("k") > 1) & F.col("c").isNotNull() & ~F.isnan("c"))
    bound = critical * (1 + F.col("k") / F.col("m")) * F.pow(F.col("k") / (F.col("k") + F.col("m")), F.lit(gamma))
    now = now.withColumn("x", F.col("k") / F.sqrt("m") * F.abs(F.col("c") - F.col("rho")) / F.col("s") / bound)
    out = now.groupBy("i", "j", "m", "rho").agg(F.max("x").alias("ratio"), F.max("k").alias("k"), F.min(F.when(F.col("x") > 1, F.struct("k", "t", "c"))).alias("_a"))
    alarm = out.where("_a IS NOT NULL").select("i", "j", F.col("_a.k").alias("ka"), F.col("_a.c").alias("ca"))
    move = F.struct((F.col("k") * F.abs(F.col("c") - F.col("ca"))).alias("d"), (-F.col("k")).alias("early"))
    change = now.select("i", "j", "k", "t", "c").join(alarm, ["i", "j"]).where("k <= ka").groupBy("i", "j").agg(F.max_by("t", move).alias("change"))
    return out.join(change, ["i", "j"], "left").select("i", "j", "m", "k", "rho", "ratio", F.col("_a.t").alias("first"), "change")


def _root(keys: Sequence[str], pdf: pd.DataFrame) -> pd.DataFrame:
    import numpy as np

    names = sorted(set(pdf["i"]) | set(pdf["j"]))
    at = {k: n for n, k in enumerate(names)}
    r = np.eye(len(names))
    for i, j, v in zip(pdf["i"], pdf["j"], pdf["rho"]):
        r[at[i], at[j]] = r[at[j], at[i]] = v
    e, q = np.linalg.eigh(r)
    w = q @ np.diag(1 / np.sqrt(e)) @ q.T if e[0] > 1e-12 else np.full_like(r, np.nan)
    head = {k: pdf[k].iloc[0] for k in keys}
    return pd.DataFrame([{**head, "i": a, "j": b, "w": float(w[at[a], at[b]])} for a in names for b in names])


def constancy(z: DataFrame, since_us: Column | int, keys: Sequence[str] = (), lags: int = 5) -> DataFrame:
    """Whether the correlation of joint residuals has been constant since ``since_us``: ``statistic, p_value, n, reason`` for each of ``keys``.

    R is the correlation of all rows.  Residuals times R^(-1/2) (one matrix of instruments for each key) have
    independent columns under it; the products of two columns are regressed on a constant and their own ``lags``,
    pooled over pairs, and the explained part over the residual variance is chi-square with lags + 1 degrees.
    """
    keys = list(keys)
    if not keys:
        return constancy(z.withColumn("_all", F.lit(0)), since_us, ["_all"], lags).drop("_all")
    rho = _pairs(z, keys).groupBy(*keys, "i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("_ab"), F.sum(F.col("a") * F.col("a")).alias("_aa"), F.sum(F.col("b") * F.col("b")).alias("_bb"))
    rho = rho.select(*keys, "i", "j", over(F.col("_ab"), F.sqrt(F.col("_aa") * F.col("_bb"))).alias("rho"))
    kinds = ", ".join(f"{k} {z.schema[k].dataType.simpleString()}" for k in keys)
    root = rho.groupBy(*keys).applyInPandas(lambda pdf: _root(keys, pdf), f"{kinds}, i string, j string, w double")
    late = z.where(F.col("t") >= since_us)
    u = late.select(*keys, "t", F.col("ticker").alias("j"), "z").join(root, [*keys, "j"]).groupBy(*keys, "t", "i").agg(F.sum(F.col("w") * F.col("z")).alias("z"))
    y = _pairs(u.withColumnRenamed("i", "ticker"), keys).select(*keys, "i", "j", "t", (F.col("a") * F.col("b")).alias("x0"))
    w = Window.partitionBy(*keys, "i", "j").orderBy("t")
    y = y.withColumns({f"x{k}": F.lag("x0", k).over(w) for k in range(1, lags + 1)})
    full = F.col(f"x{lags}").isNotNull()
    x = [F.lit(1.0), *[F.col(f"x{k}") for k in range(1, lags + 1)]]
    each = lambda v: F.sum(F.when(full, v))
    sums = [each(x[i] * x[j]).alias(f"_{i}_{j}") for i in range(lags + 1) for j in range(i, lags + 1)]
    g = y.groupBy(*keys).agg(F.count_distinct("t").alias("n"), F.count(F.when(full, 1)).alias("_n"), each(F.col("x0") * F.col("x0")).alias("_yy"), *sums, *[each(x[i] * F.col("x0")).alias(f"_{i}_y") for i in range(lags + 1)])
    g = solve(g, [[*[F.col(f"_{min(i, j)}_{max(i, j)}") for j in range(lags + 1)], F.col(f"_{i}_y")] for i in range(lags + 1)], "d")
    explained = total([F.col("d")[i] * F.col(f"_{i}_y") for i in range(lags + 1)])
    g = g.withColumn("_e", explained).withColumn("_v", (F.col("_yy") - F.col("_e")) / F.when(F.col("_n") > lags + 1, F.col("_n") - (lags + 1)))
    stat = F.when(F.col("_v") > 0, F.col("_e") / F.col("_v"))
    stat = F.when(~F.isnan(stat), stat)
    return g.select(*keys, stat.alias("statistic"), chi2_tail(F.greatest(stat, F.lit(0.0)), lags + 1).alias("p_value"), "n", F.when(stat.isNull(), F.lit("the joint residuals do not give the regression")).alias("reason"))


def _matrix(keys: Sequence[str], pdf: pd.DataFrame) -> pd.DataFrame:
    import numpy as np

    names = sorted(set(pdf["i"]) | set(pdf["j"]))
    at = {k: n for n, k in enumerate(names)}
    s = np.full((len(names), len(names)), np.nan)
    for i, j, v in zip(pdf["i"], pdf["j"], pdf["cov"]):
        s[at[i], at[j]] = s[at[j], at[i]] = v
    head = {k: pdf[k].iloc[0] for k in keys}
    out: list[dict] = []
    d = np.diag(s)
    if np.isfinite(s).all() and (d > 0).all():
        r = s / np.sqrt(np.outer(d, d))
        out.append({**head, "what": "covariance_ar", "v": float(np.linalg.eigvalsh(s)[-1] / np.trace(s))})
        spectrum = np.linalg.eigvalsh(r)
        out.append({**head, "what": "correlation_ar", "v": float(spectrum[-1] / len(d))})
        if spectrum[0] > 1e-12:
            low = np.linalg.inv(np.linalg.cholesky(s))
            inverse = low.T @ low
            out += [{**head, "what": "inverse", "i": a, "j": b, "v": float(inverse[at[a], at[b]])} for a in names for b in names]
        else:
            out.append({**head, "what": "undefined"})
    else:
        out.append({**head, "what": "undefined"})
    names = [*keys, "what", "i", "j", "v"]
    return pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=float if c == "v" else object) for c in names})


def matrix_figures(cov: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inverse (``what`` = inverse, with i and j) and absorption ratios of each key's covariance matrix (rows i, j, cov); ``undefined`` where it is not positive definite.

    One call for each matrix: it holds instruments by instruments, never slots.
    """
    keys = list(keys)
    kinds = ", ".join(f"{k} {cov.schema[k].dataType.simpleString()}" for k in keys)
    return cov.groupBy(*keys).applyInPandas(lambda pdf: _matrix(keys, pdf), f"{kinds}, what string, i string, j string, v double")


def quadratic_form(slots: DataFrame, inverse: DataFrame, keys: Sequence[str]) -> DataFrame:
    """x' A x of every slot's vector (rows keys, t, ticker, x) with its key's matrix (rows i, j, v): ``d`` by (keys, t)."""
    half = slots.select(*keys, "t", F.col("ticker").alias("j"), F.col("x").alias("_x")).join(inverse.select(*keys, "i", "j", "v"), [*keys, "j"])
    half = half.groupBy(*keys, "t", F.col("i").alias("ticker")).agg(F.sum(F.col("v") * F.col("_x")).alias("_h"))
    return half.join(slots, [*keys, "t", "ticker"]).groupBy(*keys, "t").agg(F.sum(F.col("_h") * F.col("x")).alias("d"))


def var_backtest(matched: DataFrame, alpha: float, lags: int = 4) -> DataFrame:
    """Tests of forecasts (``ticker, asof, var`` and ``es``, both losses above 0) against returns ``r``, one row a ticker.

    ``hit_rate``, coverage (``kupiec_p``), coverage with independence (``cc_p``), dynamic quantile (``dq_p``: hits less
    alpha on a constant, ``lags`` earlier hits and the forecast, chi-square with lags + 2 degrees) and ``z2``.  Without a hit the tests are null.
    """
    by = Window.partitionBy("ticker").orderBy("asof")
    m = matched.withColumn("hit", F.when(F.col("r") < -F.col("var"), 1.0).otherwise(0.0))
    m = m.withColumns({f"x{k}": F.lag("hit", k).over(by) for k in range(1, lags + 1)})
    x = [F.lit(1.0), *[F.col(f"x{k}") for k in range(1, lags + 1)], F.col("var")]
    n_x, full, y = len(x), F.col(f"x{lags}").isNotNull(), F.col("hit") - alpha
    of = lambda v: F.sum(F.when(full, v))
    pair = lambda a, b: F.coalesce(F.sum(F.when((F.col("x1") == a) & (F.col("hit") == b), 1)), F.lit(0)).alias(f"n{a}{b}")
    sums = [of(x[i] * x[j]).alias(f"_{i}_{j}") for i in range(n_x) for j in range(i, n_x)]
    z = F.sum(F.when(F.col("hit") == 1, F.col("r") / F.col("es")).otherwise(0.0)).alias("_z")
    g = m.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"), *[pair(a, b) for a in (0, 1) for b in (0, 1)], z, *sums, *[of(x[i] * y).alias(f"_{i}_y") for i in range(n_x)])
    g = solve(g, [[*[F.col(f"_{min(i, j)}_{max(i, j)}") for j in range(n_x)], F.col(f"_{i}_y")] for i in range(n_x)], "d")
    dq = total([F.col("d")[i] * F.col(f"_{i}_y") for i in range(n_x)]) / (alpha * (1 - alpha))
    log = lambda k, p: F.when(k > 0, k * F.log(F.when(p > 0, p))).otherwise(0.0)
    ll = lambda k, n, p: log(k, p) + log(n - k, 1 - p)
    n, h, a = F.col("n"), F.col("hits"), F.lit(alpha)
    uc = -2 * (ll(h, n, a) - ll(h, n, h / n))
    n0, n1 = F.col("n00") + F.col("n01"), F.col("n10") + F.col("n11")
    p = over(F.col("n01") + F.col("n11"), n0 + n1)
    own = ll(F.col("n01"), n0, over(F.col("n01"), n0)) + ll(F.col("n11"), n1, over(F.col("n11"), n1))
    ind = -2 * (ll(F.col("n01"), n0, p) + ll(F.col("n11"), n1, p) - own)
    some = lambda c, df: F.when(h > 0, chi2_tail(F.greatest(c, F.lit(0.0)), df))
    return g.select("ticker", "n", (h / n).alias("hit_rate"), some(uc, 1).alias("kupiec_p"), some(uc + ind, 2).alias("cc_p"), some(F.when(~F.isnan(dq), dq), n_x).alias("dq_p"), (F.col("_z") / (n * alpha) + 1).alias("z2"))
