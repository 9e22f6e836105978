"""Queries of the risk signals over the given tables, with their SQL; importing this adds them to the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import aggs, leadlag, models, windows
from marketlake.plans import fixtures as fx
from marketlake.plans import risk
from marketlake.plans.catalog import D, H, M, _FHS, _returns, query, r6

P4 = 4 * H


def _rows(signal: str, horizon: str, measures: dict[str, tuple[str, str]], til: str, n: str, source: str, i: str = "ticker", j: str = "NULL::VARCHAR", places: int = 6) -> str:
    """Long rows in SQL; each measure has (value, reason of absence)."""
    each = ", ".join(f"{{'measure': '{k}', 'v': ({v})::DOUBLE, 'why': ({w})::VARCHAR}}" for k, (v, w) in measures.items())
    return f"SELECT '{signal}' AS signal, '{horizon}' AS horizon, mm.measure, {i} AS ticker_i, {j} AS ticker_j, round(mm.v, {places}) AS value, CASE WHEN mm.v IS NULL THEN mm.why END AS absent, ({n})::DOUBLE AS n_eff, ({til})::BIGINT AS asof_micros FROM (SELECT *, unnest([{each}]) AS mm FROM {source})"


def _solved(name: str, source: str, n: int) -> str:
    """CTEs that solve the system a0_0 .. of ``source`` (right side a0_y ..) by elimination; the solutions are b0 .. in table ``name``."""
    cols = [str(j) for j in range(n)] + ["y"]
    out, at = [], source
    for k in range(n):
        of = [f"a{i}_{c} - a{i}_{k} / nullif(a{k}_{k}, 0) * a{k}_{c} AS a{i}_{c}" for i in range(n) if i != k for c in cols]
        out.append(f"{name}{k} AS (SELECT * REPLACE ({', '.join(of)}) FROM {at})")
        at = f"{name}{k}"
    return ", ".join(out) + f", {name} AS (SELECT *, {', '.join(f'a{i}_y / nullif(a{i}_{i}, 0) AS b{i}' for i in range(n))} FROM {at})"


def _tail1(x: str) -> str:
    """Upper tail of chi-square with one degree, by the approximation of the error function that the library uses."""
    t = f"(1 / (1 + 0.3275911::DOUBLE * sqrt({x}) / sqrt(2.0::DOUBLE)))"
    poly = f"{t} * (0.254829592::DOUBLE + {t} * (-0.284496736::DOUBLE + {t} * (1.421413741::DOUBLE + {t} * (-1.453152027::DOUBLE + {t} * 1.061405429::DOUBLE))))"
    return f"({poly} * exp(-({x}) / 2))"


def _tail3(x: str) -> str:
    return f"({_tail1(x)} + sqrt(2 * ({x}) / pi()) * exp(-({x}) / 2))"


def _tail6(x: str) -> str:
    return f"(exp(-({x}) / 2) * (1 + ({x}) / 2 + ({x}) * ({x}) / 8))"


# realized volatility

_HOURS = f"hc AS (SELECT ticker, t // {H} * {H} AS t, arg_max(mark, (t, event_id)) AS close FROM marks_fx GROUP BY 1, 2), hr AS (SELECT a.ticker, a.t, ln(a.close / b.close) AS r FROM hc a JOIN hc b ON a.ticker = b.ticker AND a.t = b.t + {H}), rp AS (SELECT ticker, t // {P4} * {P4} AS t, sum(r * r) AS rv, sum(r * r * r * r) * count(*) / 3 AS rq, count(*) AS n FROM hr GROUP BY 1, 2), rw AS (SELECT * FROM rp WHERE n >= 4)"


def _harq(name: str, h: int, week: int, month: int, least: int) -> str:
    by = "PARTITION BY ticker ORDER BY t"
    mean = lambda k: f"CASE WHEN count(rv) OVER ({by} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) = {k} THEN avg(rv) OVER ({by} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) END"
    ahead = f"OVER ({by} RANGE BETWEEN {P4} FOLLOWING AND {h * P4} FOLLOWING)"
    x = ("1.0::DOUBLE", "rv", "noisy", "wk", "mo")
    known = f"OVER ({by} RANGE BETWEEN UNBOUNDED PRECEDING AND {h * P4} PRECEDING)"
    sums = [f"sum(CASE WHEN u IS NOT NULL THEN {x[i]} * {x[j]} END) {known} AS a{i}_{j}" for i in range(5) for j in range(5)]
    sums += [f"sum({x[i]} * u) {known} AS a{i}_y" for i in range(5)]
    sums += [f"count(u) {known} AS nt", f"min(u) {known} AS lo", f"max(u) {known} AS hi", f"avg(u) {known} AS av"]
    return (
        f"{name}x AS (SELECT ticker, t, rv, rv * sqrt(rq) AS noisy, {mean(week)} AS wk, {mean(month)} AS mo, CASE WHEN count(rv) {ahead} = {h} THEN sum(rv) {ahead} END AS y FROM rw), "
        f"{name}u AS (SELECT *, CASE WHEN wk IS NOT NULL AND mo IS NOT NULL THEN y END AS u FROM {name}x), {name}s AS (SELECT *, {', '.join(sums)} FROM {name}u), {_solved(name + 'b', name + 's', 5)}, "
        f"{name}r AS (SELECT *, b0 + b1 * rv + b2 * noisy + b3 * wk + b4 * mo AS raw FROM {name}b), "
        f"{name} AS (SELECT ticker, t, rv, mo, y, nt, CASE WHEN nt >= {least} THEN NOT raw BETWEEN lo AND hi END AS filtered, CASE WHEN nt >= {least} AND raw IS NOT NULL THEN CASE WHEN raw BETWEEN lo AND hi THEN raw ELSE av END END AS f FROM {name}r)"
    )


def _hours(s, d):
    h = fx.marks(s, d).groupBy("ticker", (F.floor(F.col("t") / H) * H).alias("t")).agg(F.max_by("mark", F.struct("t", "event_id")).alias("close"))
    return windows.log_returns(h, H)


@query(f"WITH {_HOURS} SELECT ticker, t, round(rv, 9) AS rv, round(rq, 12) AS rq, n, n >= 4 AS whole FROM rp", "marks_fx")
def realized_periods(s, d):
    return r6(r6(models.realized(_hours(s, d), P4, 4), "rv", places=9), "rq", places=12)


@query(f"WITH {_HOURS}, {_harq('f1', 1, 3, 10, 40)} SELECT ticker, t, round(f * 1e4, 5) AS forecast, filtered, nt AS n_train, round(y * 1e4, 5) AS y FROM f1", "marks_fx")
def harq_forecasts(s, d):
    f = models.harq(models.realized(_hours(s, d), P4, 4).where("whole"), P4, 1, 3, 10, 40)
    return f.select("ticker", "t", F.round(F.col("forecast") * 1e4, 5).alias("forecast"), "filtered", "n_train", F.round(F.col("y") * 1e4, 5).alias("y"))


_RV_WHY = "CASE WHEN rv IS NULL THEN 'the period to the asof is not whole' WHEN n < 70 THEN n || ' whole periods, under 70' ELSE '{}' END"
_SHORT, _NEVER = _RV_WHY.format("not enough closed targets to train on"), _RV_WHY.format("no earlier forecast has its period closed")


def _rv(v: str, why: str) -> tuple[str, str]:
    return f"CASE WHEN rv IS NOT NULL AND n >= 70 THEN {v} END", why


@query(
    f"WITH {_HOURS}, {_harq('f1', 1, 3, 10, 40)}, {_harq('f3', 3, 3, 10, 40)}, o AS (SELECT max(t) + {P4} AS til FROM rp), k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY t DESC) AS k FROM f1), "
    "q AS (SELECT ticker, avg(y / f - ln(y / f) - 1) AS qh, avg(y / rv - ln(y / rv) - 1) AS qn, avg(y / mo - ln(y / mo) - 1) AS qm FROM k WHERE k > 1 AND k <= 21 AND f > 0 AND y > 0 AND rv > 0 AND mo > 0 GROUP BY 1), "
    f"g AS (SELECT a.ticker, til, coalesce(w.n, 0) AS n, f1.rv, f1.mo, f1.f AS fa, f3.f AS fb, qh, qn, qm FROM (SELECT DISTINCT ticker FROM rp) a CROSS JOIN o LEFT JOIN (SELECT ticker, count(*) AS n FROM rw GROUP BY 1) w USING (ticker) LEFT JOIN f1 ON f1.ticker = a.ticker AND f1.t = til - {P4} LEFT JOIN f3 ON f3.ticker = a.ticker AND f3.t = til - {P4} LEFT JOIN q ON q.ticker = a.ticker) "
    + _rows("realvol", "4h", {"sigma_4h": _rv("sqrt(fa)", _SHORT), "sigma_3h": _rv("sqrt(fb)", _SHORT), "rv_sigma_4h": _rv("sqrt(rv)", _SHORT), "vol_term": _rv("rv / mo", _SHORT), "qlike_harq": _rv("qh", _NEVER), "qlike_naive": _rv("qn", _NEVER), "qlike_mean10": _rv("qm", _NEVER)}, "til", "n", "g"), "marks_fx")
def signal_realvol(s, d):
    return r6(risk.realvol(_hours(s, d), P4, 4, 3, 10, 40, 20, "4h"), "value")


# regimes

_Z = _FHS.strip().split("\ne AS")[0].rstrip(",") + ", zz AS (SELECT ticker, t, r / sqrt(s2) AS z FROM v WHERE r IS NOT NULL AND i > 30 AND s2 > 0)"
_ZJ = _Z + ", zj AS (SELECT * FROM zz WHERE t IN (SELECT t FROM zz GROUP BY t HAVING count(*) = 3))"
EPOCH, CRITICAL = 800, 0.5
_MON = f"""
zm AS (SELECT ticker, t + {D} AS t, z FROM zj),
o AS (SELECT max(t) AS til, max(t) // {EPOCH * D} * {EPOCH * D} AS st FROM zm),
pp AS (SELECT a.ticker AS i, b.ticker AS j, a.t, a.z AS a, b.z AS b, st FROM zm a JOIN zm b ON a.t = b.t AND a.ticker < b.ticker CROSS JOIN o WHERE a.t > st - {EPOCH * D} AND a.t <= til),
bs AS (SELECT i, j, count(*) AS m, corr(a, b) AS rho, avg(a) AS ma, avg(b) AS mb, stddev_pop(a) AS sa, stddev_pop(b) AS sb FROM pp WHERE t <= st GROUP BY 1, 2),
uv AS (SELECT i, j, m, rho, (a - ma) / sa AS u, (b - mb) / sb AS v FROM pp JOIN bs USING (i, j) WHERE t <= st),
sp AS (SELECT i, j, m, rho, sqrt(avg(pow(u * v - rho / 2 * (u * u + v * v), 2))) AS s FROM uv GROUP BY 1, 2, 3, 4),
nw AS (SELECT i, j, t, row_number() OVER (PARTITION BY i, j ORDER BY t) AS k, corr(a, b) OVER (PARTITION BY i, j ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM pp WHERE t > st),
x AS (SELECT *, k / sqrt(m) * abs(c - rho) / s / ({CRITICAL}::DOUBLE * (1 + k / m) * pow(k / (k + m), 0.25::DOUBLE)) AS x FROM nw JOIN sp USING (i, j) WHERE k <= 1.5 * m AND k > 1 AND c IS NOT NULL),
al AS (SELECT i, j, m, rho, max(x) AS ratio, max(k) AS k, min(k) FILTER (x > 1) AS ka FROM x GROUP BY 1, 2, 3, 4),
fi AS (SELECT x.i, x.j, x.t AS first, x.c AS ca, ka FROM x JOIN al USING (i, j) WHERE x.k = ka),
ch AS (SELECT i, j, arg_max(t, (k * abs(c - ca), -k)) AS change FROM x JOIN fi USING (i, j) WHERE k <= ka GROUP BY 1, 2),
mo AS (SELECT al.i, al.j, m, k, rho, ratio, first, change FROM al LEFT JOIN fi USING (i, j) LEFT JOIN ch USING (i, j))
"""


def _z(s, d, tickers=None):
    r = _returns(s, d)
    return risk.joint_residuals(r.where(F.col("ticker").isin(*tickers)) if tickers else r)


@query(f"WITH {_ZJ}, {_MON.strip()} SELECT i, j, m, k, round(rho, 9) AS rho, round(ratio, 6) AS ratio, first, change FROM mo", "returns_fx")
def correlation_monitor(s, d):
    z = _z(s, d).withColumn("t", F.col("t") + D)
    return r6(r6(models.correlation_monitor(z, EPOCH * D, z.agg(F.max("t")).first()[0] or 0, CRITICAL), "rho", places=9), "ratio")


_NO = "'no baseline, or nothing after it'"


@query(
    f"WITH {_ZJ}, {_MON.strip()}, evr AS (SELECT max(ratio) AS ratio, max(k) AS k, (max(ratio) > 1)::INT AS alarm, arg_min(change, (first, i, j)) FILTER (first IS NOT NULL) AS change FROM mo), eo AS (SELECT * FROM evr CROSS JOIN o), mp AS (SELECT * FROM mo CROSS JOIN o) "
    + _rows("monitor", "1d", {"wied_galeano_ratio": ("ratio", _NO), "wied_galeano_alarm": ("alarm", _NO), "change_at_micros": ("change", "'no alarm'")}, "til", "k", "eo", "'*'")
    + " UNION ALL " + _rows("monitor", "1d", {"wied_galeano_ratio": ("ratio", "'not enough observations'")}, "til", "k", "mp", "i", "j"), "returns_fx")
def signal_monitor(s, d):
    return r6(risk.monitor(_z(s, d), D, EPOCH, CRITICAL), "value")


_L = range(6)
_CON = f"""
zt AS (SELECT * FROM zz WHERE ticker IN ('F', 'O')), p AS (SELECT a.t, a.z AS a, b.z AS b FROM zt a JOIN zt b ON a.t = b.t AND a.ticker < b.ticker),
rr AS (SELECT sum(a * b) / sqrt(sum(a * a) * sum(b * b)) AS rho, max(t) AS last FROM p),
ww AS (SELECT *, (1 / sqrt(1 + rho) + 1 / sqrt(1 - rho)) / 2 AS d, (1 / sqrt(1 + rho) - 1 / sqrt(1 - rho)) / 2 AS o FROM rr),
yy AS (SELECT t, (d * a + o * b) * (o * a + d * b) AS x0 FROM p CROSS JOIN ww WHERE t >= last + {D} - 1500 * {D}),
yl AS (SELECT t, x0, {', '.join(f'lag(x0, {k}) OVER (ORDER BY t) AS x{k}' for k in range(1, 6))} FROM yy),
ys AS (SELECT count(*) AS n, count(x5) AS nf, sum(x0 * x0) FILTER (x5 IS NOT NULL) AS s2, {', '.join(f'sum({"1" if i == 0 else f"x{i}"} * {"1" if j == 0 else f"x{j}"}) FILTER (x5 IS NOT NULL)::DOUBLE AS a{i}_{j}' for i in _L for j in _L)}, {', '.join(f'sum({"1" if i == 0 else f"x{i}"} * x0) FILTER (x5 IS NOT NULL)::DOUBLE AS a{i}_y' for i in _L)} FROM yl),
yk AS (SELECT *, {', '.join(f'a{i}_y AS r{i}' for i in _L)} FROM ys), {_solved('yb', 'yk', 6)},
ye AS (SELECT n, nf, s2, {' + '.join(f'b{i} * r{i}' for i in _L)} AS ex FROM yb), ct AS (SELECT n, ex / ((s2 - ex) / (nf - 6)) AS st, last + {D} AS til FROM ye CROSS JOIN rr)
"""
_NOT = "'the joint residuals do not give the regression'"


@query(f"WITH {_Z}, {_CON.strip()} " + _rows("constancy", "1d", {"engle_sheppard_stat": ("st", _NOT), "engle_sheppard_p": (_tail6("st"), _NOT)}, "til", "n", "ct", "'*'"), "returns_fx")
def signal_constancy(s, d):
    return r6(risk.constancy(_z(s, d, ("F", "O")), D, 1500), "value")


# figures of the covariance matrix, for the three instruments of the candles


def _det(m: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def _sym(p: str) -> list[list[str]]:
    return [[f"{p}{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]


def _quad(p: str, x: list[str]) -> str:
    """x' A^-1 x by cofactors."""
    m = _sym(p)
    cof = lambda i, j: (lambda r, c: f"({m[r[0]][c[0]]} * {m[r[1]][c[1]]} - {m[r[0]][c[1]]} * {m[r[1]][c[0]]}) * {(-1) ** (i + j)}")([k for k in range(3) if k != i], [k for k in range(3) if k != j])
    return f"(({' + '.join(f'{x[i]} * {x[j]} * {cof(i, j)}' for i in range(3) for j in range(3))}) / {_det(m)})"


def _top(name: str, source: str, p: str) -> str:
    """CTEs that add the largest eigenvalue of the symmetric matrix ``p`` as ``name``, by its cubic's trigonometric roots."""
    m, tr = _sym(p), f"({p}00 + {p}11 + {p}22)"
    b = [[f"({m[i][j]}{f' - {tr} / 3' if i == j else ''})" for j in range(3)] for i in range(3)]
    sq = " + ".join(f"{b[i][j]} * {b[i][j]}" for i in range(3) for j in range(3))
    return f"{name}_p AS (SELECT *, sqrt(({sq}) / 6) AS {name}_w FROM {source}), {name}_r AS (SELECT *, {_det(b)} / pow({name}_w, 3) / 2 AS {name}_d FROM {name}_p), {name}_t AS (SELECT *, {tr} / 3 + 2 * {name}_w * cos(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {name}_d))) / 3) AS {name} FROM {name}_r)"


_T = ("F", "O", "P")
_C = [(i, j) for i in range(3) for j in range(i, 3)]


def _cov(p: str, what: str) -> str:
    return ", ".join(f"max({what}) FILTER (i = '{_T[i]}' AND j = '{_T[j]}') AS {p}{i}{j}" for i, j in _C)


def _ewma(name: str, where: str) -> str:
    return f"{name}s AS (SELECT t, row_number() OVER (ORDER BY t DESC) - 1 AS age FROM (SELECT DISTINCT t FROM jp WHERE {where})), {name}c AS (SELECT i, j, sum(pow(0.94::DOUBLE, age) * ri * rj) / sum(pow(0.94::DOUBLE, age)) AS c FROM jp JOIN {name}s USING (t) WHERE age < 446 GROUP BY 1, 2), {name} AS (SELECT {_cov(name, 'c')} FROM {name}c)"


_DER = f"""
j AS (SELECT t, max(r) FILTER (ticker = 'F') AS x0, max(r) FILTER (ticker = 'O') AS x1, max(r) FILTER (ticker = 'P') AS x2 FROM returns_fx GROUP BY 1 HAVING count(*) = 3),
jl AS (SELECT max(t) AS last, count(*) AS slots FROM j), jp AS (SELECT p.* FROM pairs_fx p JOIN j USING (t)),
{_ewma('c', 'true')}, {_ewma('b', 't < (SELECT last FROM jl)')},
sc AS (SELECT i, j, covar_samp(ri, rj) AS c FROM jp GROUP BY 1, 2), e AS (SELECT {_cov('e', 'c')} FROM sc),
mu AS (SELECT avg(x0) AS m0, avg(x1) AS m1, avg(x2) AS m2 FROM j),
qs AS (SELECT t, {_quad('e', ['(x0 - m0)', '(x1 - m1)', '(x2 - m2)'])} AS d FROM j CROSS JOIN e CROSS JOIN mu),
qt AS (SELECT max(d) FILTER (t = last) AS turb FROM qs CROSS JOIN jl), qp AS (SELECT avg((d <= turb)::INT) AS pct FROM qs CROSS JOIN qt),
ql AS (SELECT {_quad('b', ['x0', 'x1', 'x2'])} AS maha, (x0 * x0 / b00 + x1 * x1 / b11 + x2 * x2 / b22) / 3 AS mag FROM j CROSS JOIN b WHERE t = (SELECT last FROM jl)),
cr AS (SELECT *, 1.0::DOUBLE AS r00, 1.0::DOUBLE AS r11, 1.0::DOUBLE AS r22, c01 / sqrt(c00 * c11) AS r01, c02 / sqrt(c00 * c22) AS r02, c12 / sqrt(c11 * c22) AS r12 FROM c),
{_top('ec', 'cr', 'c')}, {_top('er', 'ec_t', 'r')},
g AS (SELECT ec / (c00 + c11 + c22) AS car, er / 3 AS rar, turb, pct, maha, mag, slots, last FROM er_t CROSS JOIN qt CROSS JOIN qp CROSS JOIN ql CROSS JOIN jl)
"""
_V = "'a variance is not positive'"
_PD = "'the covariance matrix is not positive definite'"


@query(
    f"WITH {_DER.strip()} " + " UNION ALL ".join(
        _rows(name, "1d", m, f"last + {D}", "slots", "g", "'*'") for name, m in {
            "absorption": {"covariance_ar": ("car", _V), "correlation_ar": ("rar", _V)},
            "surprise": {"mahalanobis": ("maha", _PD), "chi2_percentile": (f"1 - {_tail3('maha')}", _PD), "magnitude_surprise": ("mag", _PD), "correlation_surprise": ("maha / 3 / mag", _PD)},
            "turbulence": {"turbulence": ("turb", _PD), "percentile": ("pct", _PD)}}.items()), "pairs_fx")
def signal_derived(s, d):
    return r6(risk.derived(_returns(s, d)), "value")


# lead and lag

PERIOD, LAGS = 5 * D, tuple(k * H for k in (-8, -4, -2, 0, 2, 4, 8))
_LL = f"""
tk AS (SELECT ticker, t // {PERIOD} * {PERIOD} AS period, t, arg_max(ln((bid_px + ask_px) / 2), event_id) AS p FROM quotes_fx WHERE bid_px > 0 AND ask_px > bid_px GROUP BY 1, 2, 3),
iv AS (SELECT ticker, period, lag(t) OVER w AS s, t AS e, p - lag(p) OVER w AS r FROM tk WINDOW w AS (PARTITION BY ticker, period ORDER BY t)),
sm AS (SELECT ticker, period, count(*) AS n, sum(r * r) AS v FROM iv GROUP BY 1, 2),
pr AS (SELECT a.period, b.ticker AS follower, a.n AS n_lead, b.n AS n_other, least(a.n, b.n) AS n, sqrt(a.v * b.v) AS norm FROM sm a JOIN sm b USING (period) WHERE a.ticker = 'click' AND b.ticker <> 'click'),
lg AS (SELECT unnest([{', '.join(map(str, sorted({*LAGS, -H, -M, 0, M, H})))}])::BIGINT AS lag_us),
cs AS (SELECT x.period, y.ticker AS follower, lag_us, sum(x.r * y.r) AS c FROM iv x JOIN iv y USING (period) CROSS JOIN lg WHERE x.ticker = 'click' AND y.ticker <> 'click' AND x.s + lag_us < y.e AND y.s < x.e + lag_us GROUP BY 1, 2, 3),
rh AS (SELECT pr.*, lag_us, CASE WHEN norm > 0 THEN coalesce(c, 0) / norm END AS rho, lag_us IN ({', '.join(map(str, LAGS))}) AS grid, lag_us IN ({-H}, {-M}, 0, {M}, {H}) AS blk FROM pr CROSS JOIN lg LEFT JOIN cs USING (period, follower, lag_us)),
gl AS (SELECT period, follower, n, n_lead, n_other, arg_max(lag_us, (abs(rho), -abs(lag_us), lag_us)) FILTER (grid AND rho IS NOT NULL) AS lp, arg_max(rho, (abs(rho), -abs(lag_us), lag_us)) FILTER (grid AND rho IS NOT NULL) AS rp, arg_max(rho, (abs(rho), -abs(lag_us), lag_us)) FILTER (blk AND rho IS NOT NULL) AS rb, max(rho) FILTER (lag_us = 0) AS r0, max(rho) FILTER (lag_us = {M}) AS ru, max(rho) FILTER (lag_us = {-M}) AS rd, sum(rho * rho) FILTER (grid AND lag_us > 0) AS up, sum(rho * rho) FILTER (grid AND lag_us < 0) AS dn FROM rh GROUP BY 1, 2, 3, 4, 5),
ll AS (SELECT *, abs(lp) <= {H} OR abs(rp) - abs(rb) < 2 / sqrt(n) AS zero FROM gl)
"""
_FEW = "CASE WHEN n < 100 THEN 'click has ' || n_lead || ' and ' || follower || ' ' || n_other || ' quote updates, under 100' ELSE 'not defined' END"


@query(f"WITH {_LL.strip()} SELECT period, follower, lag_us, round(rho, 9) AS rho, n FROM rh", "quotes_fx")
def overlap_correlations(s, d):
    of = leadlag.ticks(fx.quotes(s, d).where("bid_px > 0 AND ask_px > bid_px"), PERIOD)
    return r6(leadlag.overlap_correlations(of, "click", sorted({*LAGS, -H, -M, 0, M, H}), 6 * H).drop("n_other", "n_lead"), "rho", places=9)


@query(
    f"WITH {_LL.strip()} " + _rows("leadlag", "5d", {k: (f"CASE WHEN n >= 100 THEN {v} END", _FEW) for k, v in {"lead_ms": "CASE WHEN zero THEN 0 ELSE lp / 1000 END", "rho_lead": "CASE WHEN zero THEN rb ELSE rp END", "rho_0": "r0", "llr": "up / nullif(dn, 0)", "rho_leader_first": "ru", "rho_other_first": "rd", "block_asymmetry": "ru - rd"}.items()}, f"period + {PERIOD}", "n", "ll", "'click'", "follower"), "quotes_fx")
def signal_leadlag(s, d):
    return r6(risk.lead_lag(fx.quotes(s, d), "click", LAGS, PERIOD, 100, H, M, 6 * H, "5d"), "value")


# cascades

_CAS = f"""
st AS (SELECT ticker, t // {H} * {H} AS t, arg_max(mark, (t, event_id)) AS mark, arg_max(open_interest, (t, event_id)) AS oi FROM marks_fx WHERE mark > 0 AND open_interest > 0 GROUP BY 1, 2),
s AS (SELECT a.ticker, a.t, a.t // {D} * {D} AS period, a.mark, a.oi, ln(a.mark / b.mark) AS r, ln(a.oi / b.oi) AS d, b.oi - a.oi AS closed FROM st a LEFT JOIN st b ON a.ticker = b.ticker AND a.t = b.t + {H}),
hr AS (SELECT ticker, period, count(*) AS n, count(r) AS n_r, avg(oi * mark) AS oi_usd FROM s GROUP BY 1, 2),
ps AS (SELECT hr.ticker, hr.period, s.r, s.d FROM hr JOIN s ON s.ticker = hr.ticker AND s.period < hr.period AND s.period >= hr.period - 7 * {D} WHERE s.r IS NOT NULL),
md AS (SELECT ticker, period, count(*) AS nt, median(r) AS mr, median(d) AS md FROM ps GROUP BY 1, 2),
sc AS (SELECT ticker, period, nt, mr, md, 1.4826::DOUBLE * median(abs(r - mr)) AS sr, 1.4826::DOUBLE * median(abs(d - md)) AS sd FROM ps JOIN md USING (ticker, period) GROUP BY 1, 2, 3, 4, 5),
nw AS (SELECT s.*, (r - mr) / sr AS zr, (d - md) / sd AS zd, greatest(closed, 0) * mark AS usd FROM s JOIN sc USING (ticker, period) WHERE r IS NOT NULL AND nt >= 72 AND sr > 0 AND sd > 0),
jo AS (SELECT ticker, period, max(CASE WHEN zd < 0 THEN least(abs(zr), -zd) ELSE 0 END) AS jz FROM nw GROUP BY 1, 2),
ht AS (SELECT *, CASE WHEN zr < 0 THEN 'long' ELSE 'short' END AS side FROM nw WHERE zd <= -0.5 AND abs(zr) >= 0.5 AND usd >= 0.001::DOUBLE * oi * mark),
hn AS (SELECT *, CASE WHEN lag(side) OVER w = side AND t - lag(t) OVER w <= 3 * {H} THEN 0 ELSE 1 END AS new FROM ht WINDOW w AS (PARTITION BY ticker, period ORDER BY t)),
he AS (SELECT *, sum(new) OVER (PARTITION BY ticker, period ORDER BY t) AS ev FROM hn),
evs AS (SELECT ticker, period, ev, side, sum(usd) AS usd, sum(closed) AS coins, arg_min(oi + closed, t) AS stood FROM he GROUP BY 1, 2, 3, 4 HAVING sum(closed) >= 0.02::DOUBLE * arg_min(oi + closed, t)),
eg AS (SELECT ticker, period, sum(CASE WHEN side = 'long' THEN usd ELSE 0 END) AS lo, sum(CASE WHEN side = 'short' THEN usd ELSE 0 END) AS sh, count(*) AS k, max(usd) AS big FROM evs GROUP BY 1, 2),
g AS (SELECT hr.*, coalesce(nt, 0) AS nt, jz, lo, sh, k, big, coalesce(nt >= 72 AND sr > 0 AND sd > 0, false) AS steady FROM hr LEFT JOIN sc USING (ticker, period) LEFT JOIN jo USING (ticker, period) LEFT JOIN eg USING (ticker, period))
"""
_CW = "CASE WHEN nt < 72 THEN nt || ' consecutive steps in the trail, under 72' WHEN NOT steady THEN 'the trailing steps do not vary' WHEN n_r = 0 THEN 'no consecutive steps in the period' ELSE 'no open interest' END"


@query(f"WITH {_CAS.strip()} " + _rows("cascade", "1d", {k: (f"CASE WHEN steady AND n_r > 0 THEN {v} END", _CW) for k, v in {"liq_long_usd": "coalesce(lo, 0)", "liq_short_usd": "coalesce(sh, 0)", "liq_intensity": "(coalesce(lo, 0) + coalesce(sh, 0)) / oi_usd", "cascade_events": "coalesce(k, 0)", "largest_event_usd": "coalesce(big, 0)", "max_joint_z": "coalesce(jz, 0)"}.items()}, f"period + {D}", "n", "g", places=5), "marks_fx")
def signal_cascade(s, d):
    return r6(risk.cascade(fx.marks(s, d), H, D, 7, 72, 0.5, 0.0, 0.001, 2, 0.02, "1d"), "value", places=5)


# backtests


def _tests(name: str, source: str, alpha: float) -> str:
    """CTEs of the tests of forecasts (ticker, til, r, var, es) of ``source``."""
    a = f"{alpha}::DOUBLE"
    x = ["1", *[f"l{k}" for k in range(1, 5)], "var"]
    ll = lambda k, n, p: f"(CASE WHEN {k} > 0 THEN {k} * ln(nullif({p}, 0)) ELSE 0 END + CASE WHEN {n} - {k} > 0 THEN ({n} - {k}) * ln(nullif(1 - {p}, 0)) ELSE 0 END)"
    own = f"{ll('n01', '(n00 + n01)', '(n01 / nullif(n00 + n01, 0))')} + {ll('n11', '(n10 + n11)', '(n11 / nullif(n10 + n11, 0))')}"
    p = "((n01 + n11) / nullif(n00 + n01 + n10 + n11, 0))"
    return (
        f"{name}h AS (SELECT *, CASE WHEN r < -var THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit FROM {source}), {name}l AS (SELECT *, {', '.join(f'lag(hit, {k}) OVER (PARTITION BY ticker ORDER BY til) AS l{k}' for k in range(1, 5))} FROM {name}h), "
        f"{name}g AS (SELECT ticker, count(*) AS n, sum(hit) AS hits, {', '.join(f'count(*) FILTER (l1 = {i} AND hit = {j}) AS n{i}{j}' for i in (0, 1) for j in (0, 1))}, sum(CASE WHEN hit = 1 THEN r / es ELSE 0 END) AS z, {', '.join(f'(sum({x[i]} * {x[j]}) FILTER (l4 IS NOT NULL))::DOUBLE AS a{i}_{j}' for i in range(6) for j in range(6))}, {', '.join(f'(sum({x[i]} * (hit - {a})) FILTER (l4 IS NOT NULL))::DOUBLE AS a{i}_y' for i in range(6))} FROM {name}l GROUP BY 1), "
        f"{name}k AS (SELECT *, {', '.join(f'a{i}_y AS r{i}' for i in range(6))} FROM {name}g), {_solved(name + 'b', name + 'k', 6)}, "
        f"{name}s AS (SELECT ticker, n, hits / n AS hit_rate, hits, greatest(0, -2 * ({ll('hits', 'n', a)} - {ll('hits', 'n', '(hits / n)')})) AS uc, -2 * ({ll('n01', '(n00 + n01)', p)} + {ll('n11', '(n10 + n11)', p)} - ({own})) AS ind, greatest(0, ({' + '.join(f'b{i} * r{i}' for i in range(6))}) / ({a} * (1 - {a}))) AS dq, z / (n * {a}) + 1 AS z2 FROM {name}b), "
        f"{name} AS (SELECT ticker, n, hit_rate, CASE WHEN hits > 0 THEN {_tail1('uc')} END AS kupiec_p, CASE WHEN hits > 0 THEN exp(-greatest(0, uc + ind) / 2) END AS cc_p, CASE WHEN hits > 0 THEN {_tail6('dq')} END AS dq_p, z2 FROM {name}s)"
    )


@query(f"WITH m AS (SELECT ticker, t AS til, r, 0.5::DOUBLE AS var, 0.6::DOUBLE AS es FROM returns_fx), {_tests('bt', 'm', 0.025)} SELECT ticker, n, round(hit_rate, 9) AS hit_rate, round(kupiec_p, 6) AS kupiec_p, round(cc_p, 6) AS cc_p, round(z2, 6) AS z2 FROM bt WHERE n >= 250", "returns_fx")
def var_backtests(s, d):
    m = _returns(s, d).select("ticker", F.col("t").alias("asof"), "r", F.lit(0.5).alias("var"), F.lit(0.6).alias("es"))
    return r6(r6(models.var_backtest(m, 0.025).where("n >= 250").drop("dq_p"), "hit_rate", places=9), "kupiec_p", "cc_p", "z2")


def _tails(s, d):
    """Forecasts from each bar's EWMA volatility, which is known when it opens."""
    v = aggs.ewma_variance(_returns(s, d)).where("i > 30 AND s2 > 0 AND r IS NOT NULL")
    sd = F.sqrt("s2")
    return v.select("ticker", F.col("t").alias("asof"), (1.5 * sd).alias("var_975"), (2.0 * sd).alias("es_975"), (2.0 * sd).alias("var_99"))


_BT = f"{_Z}, mt AS (SELECT ticker, t AS til, r, sqrt(s2) AS sd FROM v WHERE r IS NOT NULL AND i > 30 AND s2 > 0), o AS (SELECT max(t) + {D} AS till FROM returns_fx), mn AS (SELECT * FROM mt CROSS JOIN o WHERE til >= till - 1200 * {D} AND til < till), ma AS (SELECT ticker, til, r, 1.5::DOUBLE * sd AS var, 2.0::DOUBLE * sd AS es FROM mn), mb AS (SELECT ticker, til, r, 2.0::DOUBLE * sd AS var, 2.0::DOUBLE * sd AS es FROM mn), {_tests('ta', 'ma', 0.025)}, {_tests('tb', 'mb', 0.01)}, g AS (SELECT ta.*, till, tb.hit_rate AS h99, tb.kupiec_p AS k99, tb.cc_p AS c99 FROM ta JOIN tb USING (ticker) CROSS JOIN o)"


def _bt(v: str, why: str = "not defined") -> tuple[str, str]:
    return f"CASE WHEN n >= 250 THEN {v} END", f"CASE WHEN n < 250 THEN n || ' forecasts matched with their bar in the 1200 days, under 250' ELSE '{why}' END"


_COVER = "no hit: coverage is undefined"


@query(f"WITH {_BT} " + _rows("backtest", "1d", {"n": _bt("n"), "hit_rate_975": _bt("hit_rate"), "kupiec_p_975": _bt("kupiec_p", _COVER), "cc_p_975": _bt("cc_p", _COVER), "dq_p_975": _bt("dq_p"), "z2_975": _bt("z2"), "hit_rate_99": _bt("h99"), "kupiec_p_99": _bt("k99", _COVER), "cc_p_99": _bt("c99", _COVER)}, "till", "n", "g"), "returns_fx")
def signal_backtest(s, d):
    return r6(risk.backtest(_tails(s, d), _returns(s, d), D, 1200, 250), "value")
