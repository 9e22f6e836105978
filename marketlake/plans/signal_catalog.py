"""Queries of the composed signals with all their measures, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import windows
from marketlake.plans import declared, signals
from marketlake.plans import fixtures as fx
from marketlake.plans.catalog import JUMPS, D, H, _returns, query, r6

THIN = "'too little of the hour is covered'"
FEW = "'not enough observations'"
RATES = declared.baselines({"baseline": {"main": 1e-6, "xyz": 5e-7}, "dex": {"xyz": ["click"]}})


def _rows(signal: str, horizon: str, measures: dict[str, tuple[str, str]], asof: str, n: str, source: str, i: str = "ticker") -> str:
    """Long rows in SQL; each measure has its value and its reason where there is none."""
    each = ", ".join(f"{{'measure': '{k}', 'v': ({v})::DOUBLE, 'why': {why}}}" for k, (v, why) in measures.items())
    return f"SELECT '{signal}' AS signal, '{horizon}' AS horizon, m.measure, {i} AS ticker_i, NULL::VARCHAR AS ticker_j, round(m.v, 6) AS value, CASE WHEN m.v IS NULL THEN m.why END AS absent, round({n}, 6)::DOUBLE AS n_eff, {asof} AS asof_micros FROM (SELECT *, unnest([{each}]) AS m FROM {source})"


def _z(x: str, past: str, keys: str, days: int, least: int, source: str) -> str:
    """``source`` with z and z_why of ``x`` against the ``days`` before."""
    inner = f"SELECT *, {x} AS zx, count({past}) OVER w AS zn, median({past}) OVER w AS zm, mad({past}) OVER w AS zd FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY period RANGE BETWEEN {days * D} PRECEDING AND 1 PRECEDING)"
    return f"SELECT *, CASE WHEN zn >= {least} AND zd > 0 THEN (zx - zm) / (1.4826::DOUBLE * zd) END AS z, CASE WHEN zx IS NULL THEN 'nothing this period' WHEN zn < {least} THEN 'too few periods before' ELSE 'the periods before do not vary' END AS z_why FROM ({inner})"


_BASIS = f"""
r AS (SELECT ticker, period, premium * 1e4 AS bps, (mark / oracle - 1) * 1e4 AS ov, open_interest AS oi, mark, t, event_id, w FROM stood_fx),
n AS (SELECT *, row_number() OVER (PARTITION BY ticker, period ORDER BY bps) - 1 AS i, count(*) OVER (PARTITION BY ticker, period) AS n FROM r),
q AS (SELECT ticker, period, max(bps) FILTER (i = floor(0.01::DOUBLE * (n - 1) + 0.5)) AS lo, max(bps) FILTER (i = floor(0.99::DOUBLE * (n - 1) + 0.5)) AS hi FROM n GROUP BY 1, 2),
c AS (SELECT *, sum(w) OVER (PARTITION BY ticker, period ORDER BY bps RANGE UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY ticker, period) AS a FROM r),
m AS (SELECT ticker, period, min(bps) AS med FROM c WHERE c >= 0.5 * a GROUP BY 1, 2),
g AS (SELECT ticker, period, sum(greatest(lo, least(hi, bps)) * w) / sum(w) AS twa, sum(ov * w) / sum(w) AS ov, count(*) FILTER (oi > 0) AS oi_n, ln(arg_max(oi, (t, event_id)) FILTER (oi > 0) / arg_min(oi, (t, event_id)) FILTER (oi > 0)) AS oi_log, arg_max(oi * mark, (t, event_id)) FILTER (oi > 0) AS oi_usd, sum(w) AS covered FROM r JOIN q USING (ticker, period) GROUP BY 1, 2),
l AS (SELECT g.*, med, covered >= 1800000000 AS ok, (make_timestamp(period) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ts FROM g JOIN m USING (ticker, period)),
x AS (SELECT *, CASE WHEN ok THEN twa END AS p, CASE WHEN CASE dayofweek(ts) WHEN 6 THEN false WHEN 0 THEN hour(ts) >= 18 WHEN 5 THEN hour(ts) < 17 ELSE hour(ts) <> 17 END THEN 1.0 ELSE 0.0 END AS share FROM l),
y AS (SELECT *, ticker <> 'click' OR share = 1 AS whole, CASE WHEN ticker <> 'click' OR share = 1 THEN p END AS past FROM x),
b AS ({_z("p", "past", "ticker", 5, 24, "y")})
"""
_OI = f"CASE WHEN ok THEN 'under two open-interest samples in the hour' ELSE {THIN} END"


@query("WITH " + _BASIS.strip() + " SELECT * FROM (" + _rows("basis", "1h", {
    "premium_twa_bps": ("p", THIN), "premium_median_bps": ("CASE WHEN ok THEN med END", THIN), "mark_oracle_bps": ("CASE WHEN ok THEN ov END", THIN),
    "open_interest_log_change": ("CASE WHEN ok AND oi_n >= 2 THEN oi_log END", _OI), "open_interest_usd": ("CASE WHEN ok AND oi_n >= 2 THEN oi_usd END", _OI),
    "external_share": ("share", THIN), "premium_z_30d": ("CASE WHEN whole THEN z END", "CASE WHEN whole THEN z_why ELSE 'the hour is not wholly in the external session' END"),
}, "(period + 3600000000)", "covered / 6e7::DOUBLE", "b") + ") WHERE measure <> 'external_share' OR ticker_i = 'click'", "stood_fx")
def signal_basis(s, d):
    return r6(signals.basis(fx.marks(s, d), 2 * H, 30, ("click",), 5, 24), "value", "n_eff")


def _trailing(hours: int, name: str) -> str:
    w = f"OVER (PARTITION BY ticker ORDER BY t RANGE BETWEEN {(hours - 1) * H} PRECEDING AND CURRENT ROW)"
    return f"count(rate) {w} AS n_{name}, CASE WHEN count(rate) {w} >= 0.5 * {hours} THEN avg(rate) {w} END AS mean_{name}, avg((rate > 0)::INT) {w} AS pos_{name}, avg((abs(rate - base) < 1e-9)::INT) {w} AS at_{name}"


_CARRY = f"""
o AS (SELECT *, CASE WHEN ticker = 'click' THEN 5e-7::DOUBLE ELSE 1e-6::DOUBLE END AS base FROM funding_fx),
f AS (SELECT ticker, t, base, {_trailing(24, "24h")}, {_trailing(168, "7d")}, {_trailing(720, "30d")} FROM o),
d AS (SELECT a.ticker, a.t, (b.t - 1) // {D} AS d, avg(b.rate) AS m FROM funding_fx a JOIN funding_fx b ON a.ticker = b.ticker AND b.t <= a.t - {168 * H} AND b.t > a.t - {168 * H + 10 * D} GROUP BY 1, 2, 3 HAVING count(*) >= 12),
e AS (SELECT ticker, t, count(*) AS days, avg(m) AS dm, stddev_samp(m) AS sd FROM d GROUP BY 1, 2),
v AS (SELECT a.ticker, a.t, count(b.r) AS vn, stddev_samp(b.r) AS vol FROM funding_fx a LEFT JOIN hour_returns_fx b ON a.ticker = b.ticker AND b.t + {H} <= a.t AND b.t + {H} >= a.t - {(31 * 24 - 2) * H} GROUP BY 1, 2),
l AS (SELECT a.ticker, a.t, arg_max(b.rate, b.recv_micros) AS now FROM funding_fx a JOIN live_fx b ON a.ticker = b.ticker AND b.recv_micros >= a.t - {H} AND b.recv_micros <= a.t GROUP BY 1, 2),
x AS (SELECT f.*, coalesce(days, 0) AS days, dm, sd, vn, vol, now FROM f LEFT JOIN e USING (ticker, t) LEFT JOIN v USING (ticker, t) LEFT JOIN l USING (ticker, t))
"""
_NONE = "'too few settled hours'"
_WEEK = {
    "carry_apr_7d": ("mean_7d * 8760", _NONE), "excess_apr_7d": ("(mean_7d - base) * 8760", _NONE), "positive_share_7d": ("CASE WHEN mean_7d IS NOT NULL THEN pos_7d END", _NONE), "baseline_share_7d": ("CASE WHEN mean_7d IS NOT NULL THEN at_7d END", _NONE),
    "zscore_7d": ("CASE WHEN days >= 5 AND sd > 1e-9 * greatest(abs(dm), 1e-12) THEN (mean_7d - dm) / sd END", f"CASE WHEN mean_7d IS NULL THEN {_NONE} WHEN days < 5 THEN 'too few covered days before the week' ELSE 'the daily means do not vary' END"),
    "carry_to_vol_7d": ("CASE WHEN vn >= 48 AND vol > 0 THEN mean_7d * 8760 / (vol * sqrt(8760)) END", f"CASE WHEN mean_7d IS NULL THEN {_NONE} WHEN vn < 48 THEN 'too few hourly returns' ELSE 'the hourly returns do not vary' END"),
    "nowcast_apr": ("now * 8760", "'no live rate received in the hour before'"),
}


@query("WITH " + _CARRY.strip() + " " + " UNION ALL ".join(_rows("carry", "1h", m, "t", f"n_{name}", "x") for name, m in {"24h": {"carry_apr_24h": ("mean_24h * 8760", _NONE)}, "7d": _WEEK, "30d": {"carry_apr_30d": ("mean_30d * 8760", _NONE)}}.items()), "funding_fx", "live_fx", "hour_returns_fx")
def signal_carry(s, d):
    returns = windows.log_returns(fx.hours(s, d), H)
    rows = signals.carry(fx.funding(s, d), 0.5, RATES.rate(F.col("ticker")), fx.live_rates(s, d), returns, 1e-9, 10, 5, 48)
    return r6(rows, "value", "n_eff")


_LIQUIDITY = f"""
v AS (SELECT *, (bid_px + ask_px) / 2 AS mid, (ask_px - bid_px) / ((bid_px + ask_px) / 2) * 1e4 AS spread, least(bid_px * bid_sz, ask_px * ask_sz) AS depth FROM quotes_fx WHERE ask_px > bid_px),
e AS (SELECT *, least(coalesce(lead(t) OVER (PARTITION BY venue, ticker ORDER BY t, event_id), t + {H}), t + {H}) AS until FROM v),
u AS (SELECT *, p AS period, least(until, p + {H}) - greatest(t, p) AS wt FROM e, unnest(range((t // {H}) * {H}, until, {H})) AS y(p) WHERE until > t),
k AS (SELECT *, sum(wt) OVER (PARTITION BY venue, ticker, period ORDER BY depth RANGE UNBOUNDED PRECEDING) AS upto, sum(wt) OVER (PARTITION BY venue, ticker, period) AS total FROM u),
s AS (SELECT venue, ticker, period, sum(spread * wt) / sum(wt) AS quoted, sum(wt) AS covered, min(depth) FILTER (upto >= 0.5 * total) AS mid_depth, min(depth) FILTER (upto >= 0.1 * total) AS low_depth FROM k GROUP BY 1, 2, 3),
a AS (SELECT venue, ticker, t, arg_max(mid, event_id) AS mid FROM v GROUP BY 1, 2, 3),
t1 AS (SELECT x.*, x.t + 600000000 AS later, a.mid FROM trades_one x ASOF LEFT JOIN a ON x.venue = a.venue AND x.ticker = a.ticker AND x.t >= a.t),
t2 AS (SELECT x.*, (x.t // {H}) * {H} AS period, x.price * x.size AS notional, CASE WHEN aggressor = 'bid' THEN 2.0 ELSE -2.0 END AS sgn, CASE WHEN x.later <= (x.t // {H}) * {H} + {H} THEN a.mid END AS mid2 FROM t1 x ASOF LEFT JOIN a ON x.venue = a.venue AND x.ticker = a.ticker AND x.later >= a.t),
t3 AS (SELECT *, sgn * (price - mid) / mid * 1e4 AS eff, sgn * (mid2 - mid) / mid * 1e4 AS imp FROM t2),
h AS (SELECT venue, ticker, period, sum(eff * notional) / sum(notional) FILTER (eff IS NOT NULL) AS eff_vw, avg(eff) AS eff_ew, sum(imp * notional) / sum(notional) FILTER (imp IS NOT NULL) AS imp_vw FROM t3 GROUP BY 1, 2, 3),
b AS (SELECT venue, ticker, (t // 60000000) * 60000000 AS bucket, sum(price * size) AS notional, arg_max(price, (t, trade_id)) AS last FROM trades_one GROUP BY 1, 2, 3),
f AS (SELECT venue, ticker, period, coalesce(covered, 0) AS covered, quoted, mid_depth, low_depth, eff_vw, eff_ew, imp_vw, coalesce(covered >= 1800000000, false) AS ok FROM s FULL JOIN h USING (venue, ticker, period)),
i AS (SELECT f.venue, f.ticker, f.period, b.notional, abs(ln(b.last / lag(b.last) OVER (PARTITION BY f.venue, f.ticker, f.period ORDER BY b.bucket))) * 1e4 AS r FROM f JOIN b ON f.venue = b.venue AND f.ticker = b.ticker AND b.bucket >= f.period - {23 * H} AND b.bucket < f.period + {H}),
j AS (SELECT venue, ticker, period, avg(r / (notional / 1e6)) AS amihud FROM i GROUP BY 1, 2, 3),
y AS (SELECT f.*, amihud, CASE WHEN ok AND quoted > 0 THEN ln(quoted) END AS lq FROM f LEFT JOIN j USING (venue, ticker, period)),
z AS ({_z("lq", "lq", "venue, ticker", 5, 12, "y")})
"""
_NO_TRADE = "'no trade with a quote before it'"


@query("WITH " + _LIQUIDITY.strip() + " " + _rows("liquidity", "1h", {
    "quoted_spread_bps": ("CASE WHEN ok THEN quoted END", THIN), "depth_usd_median": ("CASE WHEN ok THEN mid_depth END", THIN), "depth_usd_p10": ("CASE WHEN ok THEN low_depth END", THIN),
    "effective_spread_bps_vw": ("eff_vw", _NO_TRADE), "effective_spread_bps_ew": ("eff_ew", _NO_TRADE), "impact_bps_5s_vw": ("imp_vw", "'no trade whose horizon had passed'"),
    "amihud_24h": ("amihud", "'no bucket with a return and notional'"), "spread_z_7d": ("z", "z_why"),
}, f"(period + {H})", "covered / 6e7::DOUBLE", "z", "venue || '/' || ticker"), "quotes_fx", "trades_one")
def signal_liquidity(s, d):
    return r6(signals.liquidity(fx.quotes(s, d), fx.trades(s, d), H, 600_000_000, 30, 5, 12), "value", "n_eff")


_P = 30 * D
_MOMENTS = f"""
r AS (SELECT ticker, t, CASE WHEN ticker <> 'F' OR (t // {D} + 4) % 7 NOT IN (0, 6) THEN r END AS r FROM returns_fx),
g AS (SELECT ticker, (t // {_P}) * {_P} AS period, count(r) AS n, sum(r ** 2) AS s2, sum(r ** 3) AS s3, sum(r ** 4) AS s4 FROM r GROUP BY 1, 2),
m AS (SELECT ticker, period, n, CASE WHEN n >= 18 AND s2 > 0 THEN sqrt(s2) END AS vol, CASE WHEN n >= 18 AND s2 > 0 THEN sqrt(n) * s3 / pow(s2, 1.5::DOUBLE) END AS skew, CASE WHEN n >= 18 AND s2 > 0 THEN n * s4 / (s2 * s2) END AS kurt FROM g),
w AS (SELECT *, count(skew) OVER v AS c, avg(skew) OVER v AS ms, avg(kurt) OVER v AS mk FROM m WINDOW v AS (PARTITION BY ticker ORDER BY period RANGE BETWEEN {6 * _P} PRECEDING AND CURRENT ROW))
"""
_WEEKS = "'too few periods with moments'"


@query("WITH " + _MOMENTS.strip() + " " + _rows("moments", "30d", {"realized_vol_30d": ("vol", FEW), "realized_skew_30d": ("skew", FEW), "realized_kurt_30d": ("kurt", FEW), "realized_skew_210d": ("CASE WHEN c >= 4 THEN ms END", _WEEKS), "realized_kurt_210d": ("CASE WHEN c >= 4 THEN mk END", _WEEKS)}, f"period + {_P}", "n", "w"), "returns_fx")
def signal_moments(s, d):
    """The bars of F count in the session of the hours around midnight UTC alone: all but those that end on a Saturday or Sunday."""
    return r6(signals.moments(_returns(s, d), _P, 18, "30d", sessioned=("F",), width_us=H), "value", "n_eff")


_JUDGED = f"""
p AS (SELECT *, abs(r) * abs(lag(r) OVER (PARTITION BY ticker ORDER BY t)) AS p, count(*) OVER (PARTITION BY ticker) AS total FROM returns_fx),
o AS (SELECT ticker, t, r, total, CASE WHEN count(p) OVER w = 28 THEN r / sqrt(avg(p) OVER w) END AS L FROM p WINDOW w AS (PARTITION BY ticker ORDER BY t ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, abs(L) > sqrt(2 * ln(total)) / sqrt(2 / pi()) - (ln(pi()) + ln(ln(total))) / (2 * sqrt(2 / pi()) * sqrt(2 * ln(total))) - ln(-ln(0.1::DOUBLE)) / (sqrt(2 / pi()) * sqrt(2 * ln(total))) AS jump, (t // {_P}) * {_P} AS period FROM o),
a AS (SELECT ticker, period, count(r) AS n, arg_max(coalesce(L, 'nan'::DOUBLE), t) AS last_l, arg_max(coalesce(jump::INT, -1), t) AS last_jump, count(*) FILTER (jump AND r > 0) AS ups, count(*) FILTER (jump AND r < 0) AS downs, coalesce(sum(r * r) FILTER (jump AND r > 0), 0) AS vu, coalesce(sum(r * r) FILTER (jump AND r < 0), 0) AS vd FROM k GROUP BY 1, 2),
i AS (SELECT a.ticker, a.period, sum(exp(-(a.period + {_P} - k.t - {D}) / {10 * D}::DOUBLE)) FILTER (k.r > 0) AS iu, sum(exp(-(a.period + {_P} - k.t - {D}) / {10 * D}::DOUBLE)) FILTER (k.r < 0) AS idn FROM a JOIN k ON a.ticker = k.ticker AND k.jump AND k.t + {D} <= a.period + {_P} AND k.t + {D} > a.period + {_P} - 20 * {D} GROUP BY 1, 2),
x AS (SELECT a.*, j.m AS bars, j.rv, j.share, j.z, coalesce(iu, 0) AS iu, coalesce(idn, 0) AS idn FROM a LEFT JOIN j USING (ticker, period) LEFT JOIN i USING (ticker, period))
"""
_EARLY = "'too few returns before the bar'"


@query(f"WITH {JUMPS}, " + _JUDGED.strip() + " " + _rows("jumps", "24h", {
    "L_last": ("CASE WHEN NOT isnan(last_l) THEN last_l END", _EARLY), "jump_last": ("CASE WHEN last_jump >= 0 THEN last_jump END", _EARLY), "jumps_up_24h": ("CASE WHEN bars IS NOT NULL THEN ups END", FEW), "jumps_down_24h": ("CASE WHEN bars IS NOT NULL THEN downs END", FEW),
    "jump_share_24h": ("share", FEW), "rj_z_24h": ("z", FEW), "jump_var_up_24h": ("vu / rv", FEW), "jump_var_down_24h": ("vd / rv", FEW), "intensity_up": ("iu", FEW), "intensity_down": ("idn", FEW),
}, f"period + {_P}", "n", "x"), "returns_fx")
def signal_jumps(s, d):
    return r6(signals.jumps(_returns(s, d), _P, 10, 30, 0.9, None, D, 10 * D, 20), "value", "n_eff")
