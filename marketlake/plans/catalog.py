"""Queries of the operators over the given tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.operators import aggs, dedupe, filters, joins, ledger, models, quality, windows
from marketlake.plans import fixtures as fx
from marketlake.plans import signals

H, D, M = 3_600_000_000, 86_400_000_000, 60_000_000
_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = fx.with_views(sql, *views)
        return f

    return add


def _long(signal: str, horizon: str, measures: str, asof: str, n: str, source: str, i: str = "ticker", j: str = "NULL::VARCHAR", why: str = "not enough observations") -> str:
    """Long rows of a signal in SQL: ``measures`` are structs (measure, v), rounded here."""
    return f"SELECT '{signal}' AS signal, '{horizon}' AS horizon, m.measure, {i} AS ticker_i, {j} AS ticker_j, round(m.v, 6) AS value, CASE WHEN m.v IS NULL THEN '{why}' END AS absent, round({n}, 6)::DOUBLE AS n_eff, {asof} AS asof_micros FROM (SELECT *, unnest([{measures}]) AS m FROM {source})"


def _m(**of: str) -> str:
    return ", ".join(f"{{'measure': '{k}', 'v': ({v})::DOUBLE}}" for k, v in of.items())


def _z(name: str, x: str) -> str:
    """Tables of the seasonal z of column ``x`` of table h: ``name`` (ticker, hour, z)."""
    same = "a.ticker = b.ticker AND (a.hour - b.hour) % 24 = 0 AND b.hour < a.hour AND b.hour >= a.hour - 672 AND ((a.hour // 24 + 3) % 7 >= 5) = ((b.hour // 24 + 3) % 7 >= 5)"
    return f"{name}_m AS (SELECT a.ticker, a.hour, a.{x} AS x, median(ln(b.{x})) AS med FROM h a JOIN h b ON {same} GROUP BY 1, 2, 3 HAVING count(*) >= 5), {name} AS (SELECT a.ticker, a.hour, CASE WHEN median(abs(ln(b.{x}) - a.med)) > 0 THEN (ln(a.x) - a.med) / (1.4826::DOUBLE * median(abs(ln(b.{x}) - a.med))) END AS z FROM {name}_m a JOIN h b ON {same} GROUP BY a.ticker, a.hour, a.x, a.med)"


def r6(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


def _returns(s, d):
    return windows.log_returns(fx.candles(s, d), D)


def _stood(s, d):
    return windows.stood(fx.marks(s, d), ["ticker"], H, 2 * H, ["event_id"])


@query("SELECT ticker, period, round(sum(premium * 1e4 * w) / sum(w), 6) AS premium_twa_bps, sum(w)::BIGINT AS covered FROM stood_fx GROUP BY 1, 2", "stood_fx")
def premium_twa(s, d):
    return r6(aggs.time_weighted(_stood(s, d).withColumn("bps", F.col("premium") * 1e4), "bps", ["ticker", "period"]).withColumnRenamed("mean", "premium_twa_bps"), "premium_twa_bps")


@query("SELECT ticker, event_id, period, w FROM stood_fx", "stood_fx")
def standing_intervals(s, d):
    return _stood(s, d).select("ticker", "event_id", "period", "w")


@query("SELECT ticker, period, round(min(mark), 6) AS quantile FROM (SELECT *, sum(w) OVER (PARTITION BY ticker, period ORDER BY mark RANGE UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY ticker, period) AS a FROM stood_fx) WHERE c >= 0.5 * a GROUP BY 1, 2", "stood_fx")
def weighted_median_mark(s, d):
    return r6(aggs.weighted_quantile(_stood(s, d), "mark", 0.5, ["ticker", "period"]), "quantile")


@query("WITH n AS (SELECT ticker, premium, row_number() OVER (PARTITION BY ticker ORDER BY premium) - 1 AS i, count(*) OVER (PARTITION BY ticker) AS n FROM marks_fx), q AS (SELECT ticker, max(premium) FILTER (i = floor(0.05::DOUBLE * (n - 1) + 0.5)) AS lo, max(premium) FILTER (i = floor(0.95::DOUBLE * (n - 1) + 0.5)) AS hi FROM n GROUP BY 1) SELECT ticker, round(avg(greatest(lo, least(hi, premium))), 9) AS mean FROM marks_fx JOIN q USING (ticker) GROUP BY 1", "marks_fx")
def winsorised_premium(s, d):
    return r6(aggs.winsorise(fx.marks(s, d), "premium", 0.05, 0.95, ["ticker"]).groupBy("ticker").agg(F.avg("premium").alias("mean")), "mean", places=9)


@query("WITH m AS (SELECT ticker, median(premium) AS m, count(*) AS n FROM marks_fx GROUP BY 1), a AS (SELECT ticker, m, n, median(abs(premium - m)) AS dev FROM marks_fx JOIN m USING (ticker) GROUP BY 1, 2, 3) SELECT event_id, round((premium - m) / (1.4826 * dev), 6) AS z, n AS n_eff FROM marks_fx JOIN a USING (ticker)", "marks_fx")
def robust_z_premium(s, d):
    m = fx.marks(s, d).withColumn("value", F.col("premium"))
    return r6(aggs.robust_z(m, m, ["ticker"], 72).select("event_id", "z", "n_eff"), "z")


@query("SELECT ticker, t, round(r, 9) AS r FROM returns_fx", "returns_fx")
def log_returns(s, d):
    return r6(_returns(s, d), "r", places=9)


@query("SELECT ticker, ((t - 345600000000) // 604800000000) * 604800000000 + 345600000000 AS t, arg_min(open, t) AS open, max(high) AS high, min(low) AS low, arg_max(close, t) AS close FROM candles_fx c GROUP BY 1, ((t - 345600000000) // 604800000000) HAVING count(*) = 7", "candles_fx")
def weekly_bars(s, d):
    return aggs.build_bars(fx.candles(s, d), D, aggs.WEEK_US)


@query("SELECT ticker, round(stddev_samp(r) * sqrt(365.0), 6) AS volatility, count(*) AS n FROM returns_fx GROUP BY 1", "returns_fx")
def volatility(s, d):
    return r6(aggs.volatility(_returns(s, d), D, 30), "volatility")


@query("SELECT i, j, round(corr(ri, rj), 6) AS rho, count(*) AS n FROM pairs_fx WHERE i < j GROUP BY 1, 2 HAVING count(*) >= 30", "pairs_fx")
def pair_correlation(s, d):
    return r6(aggs.correlation(joins.pairs(_returns(s, d), own=False), 30, 1.96).select("i", "j", "rho", "n"), "rho")


@query("WITH c AS (SELECT i, j, corr(ri, rj) AS rho, count(*) AS n FROM pairs_fx WHERE i < j GROUP BY 1, 2 HAVING count(*) >= 30) SELECT i, j, round(tanh(atanh(rho) - 1.96 / sqrt(n - 3)), 6) AS lo, round(tanh(atanh(rho) + 1.96 / sqrt(n - 3)), 6) AS hi FROM c", "pairs_fx")
def correlation_interval(s, d):
    return r6(aggs.correlation(joins.pairs(_returns(s, d), own=False), 30, 1.96).select("i", "j", "lo", "hi"), "lo", "hi")


@query("WITH b AS (SELECT t, j AS ticker, rj AS r, ri AS ref FROM pairs_fx WHERE i = 'O' UNION ALL SELECT t, i, ri, rj FROM pairs_fx WHERE j = 'O' AND i <> 'O') SELECT ticker, round(regr_slope(r, ref), 6) AS beta, count(*) AS n FROM b GROUP BY 1", "pairs_fx")
def beta_to_reference(s, d):
    return r6(aggs.beta(joins.pairs(_returns(s, d)), "O", 2), "beta")


@query("WITH sl AS (SELECT t, row_number() OVER (ORDER BY t DESC) - 1 AS age FROM (SELECT DISTINCT t FROM pairs_fx)), w AS (SELECT i, j, ri, rj, power(0.94::DOUBLE, age) AS w FROM pairs_fx JOIN sl USING (t) WHERE age < 446) SELECT i, j, round(sum(w * ri * rj) / sum(w), 9) AS cov, round(sum(w) * sum(w) / sum(w * w), 6) AS n_eff FROM w GROUP BY 1, 2", "pairs_fx")
def ewma_covariance(s, d):
    return r6(r6(aggs.ewma_cov(joins.pairs(_returns(s, d)), 0.94, D), "cov", places=9), "n_eff")


@query("SELECT t, ticker, round(r, 9) AS r FROM returns_fx WHERE t IN (SELECT t FROM returns_fx GROUP BY t HAVING count(*) = 3)", "returns_fx")
def joint_returns(s, d):
    return r6(joins.joint_returns(_returns(s, d), 3).select("t", "ticker", "r"), "r", places=9)


@query("SELECT ticker, (t // 2592000000000) * 2592000000000 AS period, round(sum(r * r), 6) AS rv, count(*) AS n FROM returns_fx GROUP BY 1, 2 HAVING count(*) >= 10", "returns_fx")
def realized_variance(s, d):
    return r6(aggs.realized_variance(_returns(s, d), 30 * D, 10), "rv")


@query("SELECT ticker, (t // 2592000000000) * 2592000000000 AS period, count(*) AS n, round(sqrt(sum(r * r)), 6) AS vol, round(sqrt(count(*)) * sum(r * r * r) / power(sum(r * r), 1.5), 6) AS skew, round(count(*) * sum(r * r * r * r) / power(sum(r * r), 2), 6) AS kurt FROM returns_fx GROUP BY 1, 2 HAVING count(*) >= 10 AND sum(r * r) > 0", "returns_fx")
def realized_moments(s, d):
    return r6(aggs.realized_moments(_returns(s, d), 30 * D, 10), "vol", "skew", "kurt")


@query("WITH l AS (SELECT ticker, (t // 2592000000000) * 2592000000000 AS period, r, lag(r) OVER (PARTITION BY ticker, t // 2592000000000 ORDER BY t) AS r1 FROM returns_fx) SELECT ticker, period, count(*) AS m, round(sum(r * r), 6) AS rv, round(pi() / 2 * count(*) / (count(*) - 1.0) * sum(abs(r) * abs(r1)), 6) AS bv FROM l GROUP BY 1, 2 HAVING count(*) >= 10 AND sum(r * r) > 0", "returns_fx")
def bipower_variation(s, d):
    return r6(aggs.jump_ratio(_returns(s, d), 30 * D, 10).select("ticker", "period", "m", "rv", "bv"), "rv", "bv")


JUMPS = "l AS (SELECT ticker, (t // 2592000000000) * 2592000000000 AS period, r, lag(r) OVER w AS r1, lag(r, 2) OVER w AS r2 FROM returns_fx WINDOW w AS (PARTITION BY ticker, t // 2592000000000 ORDER BY t)), g AS (SELECT ticker, period, count(*) AS m, sum(r * r) AS rv, sum(abs(r) * abs(r1)) AS s2, sum(pow(abs(r) * abs(r1) * abs(r2), 4.0::DOUBLE / 3)) AS s3 FROM l GROUP BY 1, 2 HAVING count(*) >= 10 AND sum(r * r) > 0), b AS (SELECT *, pi() / 2 * m / (m - 1.0::DOUBLE) * s2 AS bv, m * pow(pow(2, 2.0::DOUBLE / 3) * gamma(7.0::DOUBLE / 6) / gamma(0.5::DOUBLE), -3) * m / (m - 2.0::DOUBLE) * s3 AS tq FROM g), j AS (SELECT *, (rv - bv) / rv AS rj, greatest((rv - bv) / rv, 0) AS share, ((rv - bv) / rv) / sqrt((pow(pi() / 2, 2) + pi() - 5) / m * greatest(1.0::DOUBLE, tq / (bv * bv))) AS z FROM b)"


@query(f"WITH {JUMPS} SELECT ticker, period, m, round(rv, 6) AS rv, round(bv, 6) AS bv, round(rj, 6) AS rj, round(share, 6) AS share, round(z, 6) AS z FROM j", "returns_fx")
def jump_ratio_z(s, d):
    return r6(aggs.jump_ratio(_returns(s, d), 30 * D, 10), "rv", "bv", "rj", "share", "z")


@query("WITH a AS (SELECT *, abs(r) * abs(lag(r) OVER (PARTITION BY ticker ORDER BY t)) AS p FROM returns_fx), b AS (SELECT ticker, t, r, count(p) OVER w AS n, avg(p) OVER w AS m FROM a WINDOW w AS (PARTITION BY ticker ORDER BY t ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)) SELECT ticker, t, CASE WHEN n = 28 THEN round(r / sqrt(m), 6) END AS L FROM b", "returns_fx")
def lee_mykland_statistic(s, d):
    return r6(windows.lee_mykland(_returns(s, d), 30).select("ticker", "t", "L"), "L")


@query("SELECT ticker, t, CASE WHEN count(r) OVER w = 30 THEN round(avg(r) OVER w, 9) END AS mean FROM returns_fx WINDOW w AS (PARTITION BY ticker ORDER BY t ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)", "returns_fx")
def rolling_mean_30(s, d):
    return r6(windows.rolling_mean(_returns(s, d).withColumnRenamed("r", "value"), 30).select("ticker", "t", "mean"), "mean", places=9)


@query("WITH n AS (SELECT ticker, premium, row_number() OVER (PARTITION BY ticker ORDER BY premium) - 1 AS i, count(*) OVER (PARTITION BY ticker) AS n FROM marks_fx) SELECT DISTINCT ticker, round(premium, 9) AS quantile FROM n WHERE i = floor(0.95::DOUBLE * (n - 1) + 0.5)", "marks_fx")
def nearest_rank_premium(s, d):
    return r6(windows.nearest_rank(fx.marks(s, d), "premium", 0.95, ["ticker"]), "quantile", places=9)


@query("SELECT venue, ticker, trade_id, min(recv_micros) AS recv_micros FROM trades_fx GROUP BY 1, 2, 3", "trades_fx")
def trades_once(s, d):
    return dedupe.dedupe_trades(fx.trades(s, d)).select("venue", "ticker", "trade_id", "recv_micros")


@query("WITH g AS (SELECT ticker, trade_id, count(*) - 1 AS again, max(recv_micros) AS last_at FROM trades_fx GROUP BY 1, 2) SELECT ticker, last_at // 60000000 AS minute, sum(again)::BIGINT AS redelivered, count(*) AS trades FROM g GROUP BY 1, 2 HAVING sum(again) > 0", "trades_fx")
def redelivery_report(s, d):
    return aggs.redelivery(fx.trades(s, d))


@query("SELECT venue, ticker, round(avg((recv_micros - t) / 1000), 6) AS avg_ms, round(quantile_cont((recv_micros - t) / 1000, 0.5), 6) AS p50_ms, round(quantile_cont((recv_micros - t) / 1000, 0.95), 6) AS p95_ms, round(quantile_cont((recv_micros - t) / 1000, 0.99), 6) AS p99_ms, max((recv_micros - t) / 1000) AS max_ms, count(*) AS n FROM trades_fx GROUP BY 1, 2", "trades_fx")
def two_clock_latency(s, d):
    return r6(aggs.latency(fx.trades(s, d).withColumnRenamed("t", "at_micros")), "avg_ms", "p50_ms", "p95_ms", "p99_ms")


@query("SELECT ticker, (t // 86400000000) * 86400000000 AS bucket, round(coalesce(sum(price * size) FILTER (aggressor = 'bid'), 0), 4) AS buy, round(coalesce(sum(price * size) FILTER (aggressor = 'ask'), 0), 4) AS sell, count(*) AS trades, round((coalesce(sum(price * size) FILTER (aggressor = 'bid'), 0) - coalesce(sum(price * size) FILTER (aggressor = 'ask'), 0)) / sum(price * size), 6) AS imbalance FROM trades_one GROUP BY 1, 2", "trades_one")
def trade_flow_daily(s, d):
    return r6(r6(aggs.trade_flow(dedupe.dedupe_trades(fx.trades(s, d)), D).drop("last"), "buy", "sell", places=4), "imbalance")


@query("SELECT ticker, round(sum(price * size) / sum(size), 6) AS vw, round(avg(price), 6) AS ew FROM trades_one GROUP BY 1", "trades_one")
def volume_weighted_price(s, d):
    return r6(aggs.vw_ew(dedupe.dedupe_trades(fx.trades(s, d)), "price", "size", ["ticker"]), "vw", "ew")


@query("WITH q AS (SELECT venue, ticker, t, event_id, (t // 86400000000) * 86400000000 AS bucket, bid_px b, ask_px a, bid_sz bs, ask_sz az, lag(bid_px) OVER w AS pb, lag(ask_px) OVER w AS pa, lag(bid_sz) OVER w AS pbs, lag(ask_sz) OVER w AS paz FROM quotes_fx WHERE ask_px > bid_px WINDOW w AS (PARTITION BY venue, ticker, t // 86400000000 ORDER BY t, event_id)) SELECT venue, ticker, bucket, round(sum(CASE WHEN pb IS NULL THEN 0 ELSE (CASE WHEN b >= pb THEN bs ELSE 0 END) - (CASE WHEN b <= pb THEN pbs ELSE 0 END) - (CASE WHEN a <= pa THEN az ELSE 0 END) + (CASE WHEN a >= pa THEN paz ELSE 0 END) END), 6) AS ofi, round(avg((bs + az) / 2), 6) AS depth, round(ln(arg_max((a + b) / 2, (t, event_id)) / arg_min((a + b) / 2, (t, event_id))) * 1e4, 6) AS return_bps, count(*) AS states FROM q GROUP BY 1, 2, 3", "quotes_fx")
def order_flow_imbalance(s, d):
    return r6(aggs.ofi(filters.valid_quotes(fx.quotes(s, d)), D), "ofi", "depth", "return_bps")


@query("SELECT ticker, round(regr_slope(mark, oracle), 6) AS slope, round(regr_r2(mark, oracle), 6) AS r2, count(*) AS n FROM marks_fx GROUP BY 1", "marks_fx")
def linear_fit_mark(s, d):
    return r6(aggs.linear_fit(fx.marks(s, d), "mark", "oracle", ["ticker"], 10), "slope", "r2")


@query("SELECT t.ticker, t.trade_id, q.event_id AS quote_id, q.t AS right_t FROM trades_one t ASOF LEFT JOIN (SELECT ticker, t, max(event_id) AS event_id FROM quotes_fx GROUP BY 1, 2) q ON t.ticker = q.ticker AND t.t >= q.t", "trades_one", "quotes_fx")
def prevailing_quote(s, d):
    q = fx.quotes(s, d).withColumn("quote_id", F.col("event_id"))
    return joins.asof_join(dedupe.dedupe_trades(fx.trades(s, d)), q, ["ticker"], ["quote_id"]).select("ticker", "trade_id", "quote_id", "right_t")


@query("SELECT t.ticker, t.trade_id, q.event_id AS quote_id FROM (SELECT *, t + 3600000000 AS later FROM trades_one) t ASOF LEFT JOIN (SELECT ticker, t, max(event_id) AS event_id FROM quotes_fx GROUP BY 1, 2) q ON t.ticker = q.ticker AND t.later >= q.t", "trades_one", "quotes_fx")
def quote_after_horizon(s, d):
    q = fx.quotes(s, d).withColumn("quote_id", F.col("event_id"))
    return joins.asof_join(dedupe.dedupe_trades(fx.trades(s, d)), q, ["ticker"], ["quote_id"], shift_us=H).select("ticker", "trade_id", "quote_id")


@query("SELECT t.block, t.seq, max(r.seq) AS reorg_seq FROM transfers_fx t LEFT JOIN reorgs_fx r ON t.block BETWEEN r.from_block AND r.to_block AND t.seq < r.seq GROUP BY 1, 2", "transfers_fx", "reorgs_fx")
def reorg_standing(s, d):
    return joins.standing(fx.transfers(s, d).select("block", "seq"), fx.reorgs(s, d))


@query("WITH m AS (SELECT ticker, (t // 3600000000) * 3600000000 AS bucket, venue, arg_max((bid_px + ask_px) / 2, (t, event_id)) AS mid FROM quotes_fx GROUP BY 1, 2, 3) SELECT a.ticker, a.bucket, round(a.mid, 6) AS mid_a, round(b.mid, 6) AS mid_b, round((a.mid / b.mid - 1) * 1e4, 6) AS diff_bps FROM m a JOIN m b ON a.ticker = b.ticker AND a.bucket = b.bucket AND a.venue = 'a' AND b.venue = 'b'", "quotes_fx")
def cross_venue_quotes(s, d):
    return r6(joins.cross_venue(fx.quotes(s, d), H), "mid_a", "mid_b", "diff_bps")


@query("SELECT ticker, t AS hour, round(avg(rate) OVER w * 8760, 6) AS apr, count(rate) OVER w AS n FROM funding_fx WINDOW w AS (PARTITION BY ticker ORDER BY t RANGE BETWEEN 82800000000 PRECEDING AND CURRENT ROW) QUALIFY count(rate) OVER w >= 0.5 * 24", "funding_fx")
def trailing_carry_24h(s, d):
    return r6(aggs.trailing_carry(fx.funding(s, d), 24, 0.5).select("ticker", "hour", "apr", "n"), "apr")


@query("WITH h AS (SELECT *, (t // 3600000000) % 24 AS hr, (t // 86400000000 + 3) % 7 >= 5 AS we FROM funding_fx) SELECT a.ticker, a.t, round(avg((b.rate < a.rate)::INT), 6) AS rank, count(*) AS n FROM h a JOIN h b ON a.ticker = b.ticker AND a.hr = b.hr AND a.we = b.we AND b.t < a.t AND b.t >= a.t - 2419200000000 GROUP BY 1, 2 HAVING count(*) >= 5", "funding_fx")
def seasonal_rank(s, d):
    hour, weekend = S.season(F.col("t") + H)
    f = fx.funding(s, d).select("ticker", "t", F.col("rate").alias("value"), hour.alias("hour"), weekend.alias("weekend"))
    return r6(aggs.seasonal_rank(f, 28, 5).select("ticker", "t", "rank", "n"), "rank")


@query("WITH c AS (SELECT ticker, t // 3600000000 AS hour, price * size AS n FROM trades_one), z AS (SELECT a.ticker, a.hour, b.n, row_number() OVER (PARTITION BY a.ticker, a.hour ORDER BY b.n) - 1 AS i, count(*) OVER (PARTITION BY a.ticker, a.hour) AS k FROM (SELECT DISTINCT ticker, hour FROM c) a JOIN c b ON a.ticker = b.ticker AND b.hour < a.hour AND b.hour >= a.hour - 24), q AS (SELECT ticker, hour, n AS cut FROM z WHERE k >= 20 AND i = floor(0.95::DOUBLE * (k - 1) + 0.5)) SELECT ticker, hour, round(sum(CASE WHEN n > cut THEN n ELSE 0 END) / sum(n), 6) AS large_share FROM c JOIN q USING (ticker, hour) GROUP BY 1, 2", "trades_one")
def large_trade_share(s, d):
    return r6(aggs.large_share(dedupe.dedupe_trades(fx.trades(s, d)), 0.95, 20), "large_share")


@query("WITH m AS (SELECT ticker, (t // 60000000) * 60000000 AS m, arg_max(mark, (t, event_id)) AS mark, arg_max(open_interest, (t, event_id)) AS oi FROM marks_fx GROUP BY 1, 2) SELECT a.ticker, a.m AS t, a.mark, a.oi AS open_interest, round(ln(a.mark / b.mark), 9) AS r, a.oi - b.oi AS d, greatest(b.oi - a.oi, 0) AS closed FROM m a LEFT JOIN m b ON a.ticker = b.ticker AND a.m = b.m + 60000000", "marks_fx")
def minute_states(s, d):
    out = windows.minute_changes(fx.marks(s, d))
    return r6(out.withColumn("closed", F.coalesce("closed", F.lit(0.0))), "r", places=9)


@query("WITH f AS (SELECT ticker, k % 2 AS side, (t // 60000000) * 60000000 AS t, count(*) AS notional FROM (SELECT event_type AS ticker, * FROM ev) GROUP BY 1, 2, 3), g AS (SELECT *, CASE WHEN t - lag(t) OVER w <= 1800000000 THEN 0 ELSE 1 END AS n FROM f WINDOW w AS (PARTITION BY ticker, side ORDER BY t)), h AS (SELECT *, sum(n) OVER (PARTITION BY ticker, side ORDER BY t) AS event FROM g) SELECT ticker, side, event::BIGINT AS event, min(t) AS start, max(t) AS \"end\", count(*) AS minutes, sum(notional)::BIGINT AS notional FROM h GROUP BY 1, 2, 3", "ev")
def sessionised_events(s, d):
    f = fx.ev(s, d).groupBy(F.col("event_type").alias("ticker"), (F.col("k") % 2).alias("side"), (F.floor(F.col("t") / M) * M).alias("t")).agg(F.count(F.lit(1)).alias("notional"))
    return windows.merge_events(f, 30 * M).withColumn("event", F.col("event").cast("long"))


@query("SELECT \"partition\", venue, prev_file, file, prev_last, first FROM (SELECT *, lag(file) OVER w AS prev_file, lag(last) OVER w AS prev_last FROM inventory_fx WINDOW w AS (PARTITION BY \"partition\", venue ORDER BY first, last, file)) WHERE first <= prev_last", "inventory_fx")
def overlapping_ranges(s, d):
    return windows.overlapping_ranges(fx.inventory(s, d))


_NEST = "n AS (SELECT *, max((last, file)) OVER (PARTITION BY \"partition\", venue ORDER BY first, last DESC, file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS w FROM inventory_fx), nf AS (SELECT \"partition\", venue, file, last, w[1] AS wl, w[2] AS wide FROM n)"


@query(f"WITH {_NEST} SELECT \"partition\", venue, file, wide FROM nf WHERE wl >= last", "inventory_fx")
def nested_files(s, d):
    return quality.nested_files(fx.inventory(s, d))


@query("SELECT \"partition\", count(*) AS files FROM inventory_fx GROUP BY 1 HAVING count(*) > 4 ORDER BY 2 DESC, 1 LIMIT 10", "inventory_fx")
def overfull_partitions(s, d):
    return quality.overfull(fx.inventory(s, d), 4)


@query("SELECT ticker, dayofweek(make_timestamp(t)) + 1 AS dow, hour(make_timestamp(t)) AS hour, count(*) AS n, sum(size) AS volume FROM trades_one GROUP BY 1, 2, 3", "trades_one")
def activity_grid(s, d):
    return aggs.activity_grid(dedupe.dedupe_trades(fx.trades(s, d)), "UTC")


POSITIONS = """
WITH a AS (SELECT *, coalesce(sum(CASE WHEN side = 'bid' THEN size ELSE -size END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, CASE WHEN side = 'bid' THEN size ELSE -size END AS signed, row_number() OVER w AS i
  FROM fills_fx WINDOW w AS (PARTITION BY account, ticker ORDER BY t, order_id, trade_id)),
b AS (SELECT *, start_position - before AS d FROM a),
c AS (SELECT *, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY account, ticker ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was FROM b),
e AS (SELECT *, CASE WHEN d IS NOT NULL AND (i = 1 OR abs(d - was) > 1e-9) THEN d END AS new_d FROM c),
p AS (SELECT *, before + signed + coalesce(last_value(new_d IGNORE NULLS) OVER (PARTITION BY account, ticker ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS position FROM e)
"""


@query(POSITIONS + "SELECT account, ticker, t, order_id, trade_id, position, CASE WHEN new_d IS NOT NULL THEN start_position END AS anchor FROM p", "fills_fx")
def ledger_positions(s, d):
    return ledger.positions(fx.fills(s, d)).select("account", "ticker", "t", "order_id", "trade_id", "position", "anchor")


@query(POSITIONS + ", q AS (SELECT *, lag(position) OVER (PARTITION BY account, ticker ORDER BY i) AS expected FROM p) SELECT account, ticker, t, order_id, trade_id, start_position, expected FROM q WHERE new_d IS NOT NULL AND i > 1", "fills_fx")
def ledger_breaks(s, d):
    return ledger.continuity_breaks(fx.fills(s, d), 1e-9).select("account", "ticker", "t", "order_id", "trade_id", "start_position", "expected")


BASIS = """
, n AS (SELECT account, ticker, i, signed, price, size, before, CASE WHEN new_d IS NOT NULL THEN start_position END AS anchor, position, lag(position) OVER w AS was FROM p WINDOW w AS (PARTITION BY account, ticker ORDER BY i)),
e AS (SELECT *, sum(CASE WHEN anchor IS NOT NULL AND i > 1 THEN 1 WHEN abs(was) < 1e-9 THEN 1 ELSE 0 END) OVER (PARTITION BY account, ticker ORDER BY i) AS episode FROM n),
f AS (
  SELECT account, ticker, 0::BIGINT AS i, 0::DOUBLE AS p, 0::DOUBLE AS b, 0::DOUBLE AS pnl, -1::HUGEINT AS episode FROM e WHERE i = 1
  UNION ALL
  SELECT account, ticker, i, CASE WHEN abs(p0 + signed) < 1e-9 THEN 0 ELSE p0 + signed END,
    CASE WHEN abs(p0 + signed) < 1e-9 THEN 0 WHEN p0 = 0 THEN price WHEN sign(p0) = sign(signed) THEN (abs(p0) * b0 + abs(signed) * price) / (abs(p0) + abs(signed)) WHEN abs(signed) > abs(p0) THEN price ELSE b0 END,
    pnl0 + CASE WHEN p0 = 0 OR sign(p0) = sign(signed) OR b0 IS NULL THEN 0 ELSE least(abs(p0), abs(signed)) * (price - b0) * sign(p0) END, episode
  FROM (SELECT e.*, CASE WHEN e.anchor IS NOT NULL THEN e.anchor WHEN e.episode <> f.episode THEN 0 ELSE f.p END AS p0,
          CASE WHEN e.anchor IS NOT NULL THEN CASE WHEN e.anchor = 0 THEN 0 END WHEN e.episode <> f.episode THEN 0 ELSE f.b END AS b0,
          CASE WHEN e.episode <> f.episode THEN 0 ELSE f.pnl END AS pnl0
        FROM f JOIN e ON e.account = f.account AND e.ticker = f.ticker AND e.i = f.i + 1))
SELECT account, ticker, episode::BIGINT AS episode, count(*) AS fills, round(arg_max(p, i), 4) AS position, round(max(b) FILTER (last), 6) AS basis, round(arg_max(pnl, i), 2) AS realised
FROM (SELECT *, i = max(i) OVER (PARTITION BY account, ticker, episode) AS last FROM f WHERE i > 0) GROUP BY 1, 2, 3
"""


@query("WITH RECURSIVE" + POSITIONS.strip()[4:].replace("e AS (SELECT *, CASE WHEN d IS", "k AS (SELECT *, CASE WHEN d IS").replace("FROM e)", "FROM k)") + BASIS, "fills_fx")
def ledger_basis(s, d):
    out = ledger.basis(ledger.positions(fx.fills(s, d))).withColumn("episode", F.col("episode").cast("long"))
    return r6(r6(r6(out, "position", places=4), "basis"), "realised", places=2)


@query("SELECT ticker, t // 2592000000000 AS epoch, t // 2592000000000 - 1 AS baseline, count(*) AS n FROM returns_fx GROUP BY 1, 2, 3", "returns_fx")
def calendar_epochs(s, d):
    return windows.epochs(_returns(s, d), 30).groupBy("ticker", "epoch", "baseline").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT venue, kind, top AS bound FROM (SELECT venue, 'all' AS kind, min(top) AS top FROM (SELECT venue, aggressor AS kind, max(trade_id) AS top FROM trades_one GROUP BY 1, 2) GROUP BY 1)", "trades_one")
def venue_bounds(s, d):
    t = fx.trades(s, d).select("venue", F.col("aggressor").alias("kind"), F.col("trade_id").alias("stream_seq"))
    return aggs.venue_bound(t, 2).where("missing = 0").select("venue", F.lit("all").alias("kind"), "bound")


@query("WITH h AS (SELECT ticker, (t // 3600000000) % 24 AS hour, median(abs(premium)) AS mad FROM marks_fx GROUP BY 1, 2), n AS (SELECT ticker, sqrt(avg(mad * mad)) AS norm FROM h GROUP BY 1) SELECT ticker, hour::INTEGER AS hour, round(mad / norm, 6) AS factor FROM h JOIN n USING (ticker)", "marks_fx")
def hour_factors(s, d):
    return r6(windows.periodicity(fx.marks(s, d).withColumn("r", F.col("premium")), 1 << 62), "factor")


@query("WITH m AS (SELECT *, r < -0.5 AS hit FROM returns_fx) SELECT ticker, count(*) AS n, round(avg(hit::INT), 9) AS hit_rate FROM m GROUP BY 1 HAVING count(*) >= 250", "returns_fx")
def var_hit_rate(s, d):
    m = _returns(s, d).select("ticker", F.col("t").alias("asof"), "r", F.lit(0.5).alias("var"), F.lit(0.6).alias("es"))
    return r6(models.var_backtest(m, 0.025).where("n >= 250").select("ticker", "n", "hit_rate"), "hit_rate", places=9)


@query("SELECT ticker, round(avg(close / open - ln(close / open) - 1), 6) AS qlike FROM candles_fx GROUP BY 1", "candles_fx")
def qlike_loss(s, d):
    return r6(aggs.qlike(fx.candles(s, d), "open", "close", ["ticker"]), "qlike")


_SAME = "a.ticker = b.ticker AND (a.hour - b.hour) % 24 = 0 AND b.hour < a.hour AND b.hour >= a.hour - 672 AND ((a.hour // 24 + 3) % 7 >= 5) = ((b.hour // 24 + 3) % 7 >= 5)"


@query(
    "WITH h AS (SELECT ticker, t // 3600000000 AS hour, sum(price * size) AS notional, count(*) AS cnt, sum(price * size) / count(*) AS size FROM trades_one GROUP BY 1, 2), " + _z("zn", "notional") + ", " + _z("zc", "cnt") + ", " + _z("zs", "size")
    + f", r AS (SELECT a.ticker, a.hour, avg((b.notional < a.notional)::INT) AS rank FROM h a JOIN h b ON {_SAME} GROUP BY 1, 2 HAVING count(*) >= 5), c AS (SELECT ticker, t // 3600000000 AS hour, price * size AS n FROM trades_one), q AS (SELECT a.ticker, a.hour, b.n, row_number() OVER (PARTITION BY a.ticker, a.hour ORDER BY b.n) - 1 AS i, count(*) OVER (PARTITION BY a.ticker, a.hour) AS k FROM (SELECT DISTINCT ticker, hour FROM c) a JOIN c b ON a.ticker = b.ticker AND b.hour < a.hour AND b.hour >= a.hour - 24), l AS (SELECT c.ticker, c.hour, sum(CASE WHEN c.n > q.n THEN c.n ELSE 0 END) / sum(c.n) AS large FROM c JOIN q ON c.ticker = q.ticker AND c.hour = q.hour AND k >= 20 AND i = floor(0.95::DOUBLE * (k - 1) + 0.5) GROUP BY 1, 2), "
    + "f AS (SELECT h.*, zn.z AS zn, zc.z AS zc, zs.z AS zs, rank, large FROM h LEFT JOIN zn USING (ticker, hour) LEFT JOIN zc USING (ticker, hour) LEFT JOIN zs USING (ticker, hour) LEFT JOIN r USING (ticker, hour) LEFT JOIN l USING (ticker, hour)) "
    + _long("activity", "1h", _m(notional_usd="notional", trade_count="cnt", avg_trade_usd="size", volume_z="zn", count_z="zc", size_z="zs", volume_pct="rank", large_share="large"), "(hour + 1) * 3600000000", "cnt", "f"), "trades_one")
def signal_activity(s, d):
    return r6(signals.activity(fx.trades(s, d), min_trades=20), "value", "n_eff")


_FLOW = """
v AS (SELECT *, (t // 900000000) * 900000000 AS bucket, bid_px AS b, ask_px AS a, bid_sz AS bs, ask_sz AS az FROM quotes_fx WHERE ask_px > bid_px),
w AS (SELECT *, lag(b) OVER x AS pb, lag(a) OVER x AS pa, lag(bs) OVER x AS pbs, lag(az) OVER x AS paz FROM v WINDOW x AS (PARTITION BY venue, ticker, bucket ORDER BY t, event_id)),
o AS (SELECT venue, ticker, bucket, sum(CASE WHEN pb IS NULL THEN 0 ELSE (CASE WHEN b >= pb THEN bs ELSE 0 END) - (CASE WHEN b <= pb THEN pbs ELSE 0 END) - (CASE WHEN a <= pa THEN az ELSE 0 END) + (CASE WHEN a >= pa THEN paz ELSE 0 END) END) AS ofi, avg((bs + az) / 2) AS depth, ln(arg_max((a + b) / 2, (t, event_id)) / arg_min((a + b) / 2, (t, event_id))) * 1e4 AS r FROM w GROUP BY 1, 2, 3),
f AS (SELECT venue, ticker, (t // 900000000) * 900000000 AS bucket, coalesce(sum(price * size) FILTER (aggressor = 'bid'), 0) AS buy, coalesce(sum(price * size) FILTER (aggressor = 'ask'), 0) AS sell FROM trades_one GROUP BY 1, 2, 3),
g AS (SELECT venue, ticker, (bucket // 3600000000) * 3600000000 AS period, sum(ofi) / avg(depth) AS norm, count(*) FILTER (r IS NOT NULL) AS n, regr_slope(r, ofi / depth) AS slope, regr_r2(r, ofi / depth) AS r2, regr_count(r, (buy - sell) / (buy + sell)) AS nt, regr_r2(r, (buy - sell) / (buy + sell)) AS r2t FROM o LEFT JOIN f USING (venue, ticker, bucket) GROUP BY 1, 2, 3),
i AS (SELECT venue, ticker, (bucket // 3600000000) * 3600000000 AS period, (sum(buy) - sum(sell)) / (sum(buy) + sum(sell)) AS imb FROM f GROUP BY 1, 2, 3),
e AS (SELECT *, (bs - az) / (bs + az) AS qi, least(coalesce(lead(t) OVER (PARTITION BY venue, ticker ORDER BY t, event_id), t + 3600000000), t + 3600000000) AS until FROM v),
u AS (SELECT *, least(until, p + 3600000000) - greatest(t, p) AS wt FROM e, unnest(range((t // 3600000000) * 3600000000, until, 3600000000)) AS y(p) WHERE until > t),
s AS (SELECT venue, ticker, p AS period, sum(qi * wt) / sum(wt) AS qi, sum(CASE WHEN abs(qi) > 0.5 THEN wt ELSE 0 END) / sum(wt) AS far FROM u GROUP BY 1, 2, 3),
k AS (SELECT * FROM g FULL JOIN i USING (venue, ticker, period) FULL JOIN s USING (venue, ticker, period))
"""


@query("WITH " + _FLOW.strip() + " " + _long("flow", "1h", _m(ofi_norm_1h="norm", ofi_beta_bps="CASE WHEN n >= 3 AND NOT isnan(slope) THEN slope END", ofi_r2="CASE WHEN n >= 3 AND NOT isnan(r2) THEN r2 END", trade_imbalance_1h="imb", trade_r2="CASE WHEN nt >= 3 AND NOT isnan(r2t) THEN r2t END", queue_imbalance_twa="qi", queue_imbalance_extreme_share="far"), "period + 3600000000", "coalesce(n, 0)", "k", "venue || '/' || ticker"), "quotes_fx", "trades_one")
def signal_flow(s, d):
    return r6(signals.flow(fx.quotes(s, d), fx.trades(s, d), 900_000_000, 3, 0.5), "value", "n_eff")


_EWMA = "g AS (SELECT *, dense_rank() OVER (ORDER BY t DESC) - 1 AS age FROM pairs_fx), c AS (SELECT i, j, sum(pow(0.94::DOUBLE, age) * ri * rj) / sum(pow(0.94::DOUBLE, age)) AS cov, sum(pow(0.94::DOUBLE, age)) ** 2 / sum(pow(0.94::DOUBLE, age) ** 2) AS n_eff FROM g WHERE age < 446 GROUP BY 1, 2), x AS (SELECT c.*, c.cov / sqrt(a.cov * b.cov) AS rho, (SELECT max(t) + 86400000000 FROM returns_fx) AS until FROM c JOIN c a ON a.i = c.i AND a.j = c.i JOIN c b ON b.i = c.j AND b.j = c.j)"


@query(f"WITH {_EWMA} " + _long("varcov", "1d", _m(covariance="cov"), "until", "n_eff", "x", "i", "j") + " UNION ALL " + _long("varcov", "1d", _m(correlation="rho"), "until", "n_eff", "(SELECT * FROM x WHERE i < j)", "i", "j"), "pairs_fx")
def signal_varcov(s, d):
    return r6(signals.varcov(_returns(s, d)), "value", "n_eff")


_FHS = """
n AS (SELECT ticker, t, r, row_number() OVER (PARTITION BY ticker ORDER BY t) AS i FROM returns_fx),
a AS (SELECT ticker, t, r, i FROM n UNION ALL SELECT ticker, max(t), NULL, max(i) + 1 FROM n GROUP BY 1),
v AS (SELECT a.ticker, a.t, a.r, a.i, 0.06::DOUBLE * coalesce(sum(pow(0.94::DOUBLE, a.i - b.i - 1) * b.r * b.r), 0) AS s2 FROM a LEFT JOIN n b ON a.ticker = b.ticker AND b.i < a.i AND b.i >= a.i - 700 GROUP BY 1, 2, 3, 4),
e AS (SELECT ticker, sqrt(s2) AS nx, i AS last_i, t AS until FROM v WHERE r IS NULL),
z AS (SELECT v.ticker, nx, until, v.r / sqrt(s2) AS z FROM v JOIN e USING (ticker) WHERE v.r IS NOT NULL AND i > 30 AND s2 > 0 AND i >= last_i - 365),
q AS (SELECT ticker, nx, until, count(*) AS n, quantile_cont(z, 0.01) AS a, quantile_cont(z, 0.025) AS b FROM z GROUP BY 1, 2, 3),
f AS (SELECT q.*, (SELECT avg(z.z) FROM z WHERE z.ticker = q.ticker AND z.z <= q.b) AS es FROM q)
"""


@query("WITH " + _FHS.strip() + " " + _long("tail", "1d", _m(**{k: f"CASE WHEN n >= 50 THEN {v} END" for k, v in {"sigma_next": "nx", "var_99": "-nx * a", "var_975": "-nx * b", "es_975": "-nx * es", "es_to_var": "es / a"}.items()}), "until", "n", "f"), "returns_fx")
def signal_tail(s, d):
    return r6(signals.tail(_returns(s, d), 50), "value", "n_eff")


@query("""
WITH g AS (SELECT *, dense_rank() OVER (ORDER BY t DESC) - 1 AS age FROM pairs_fx),
c AS (SELECT i, j, sum(pow(0.94, age) * ri * rj) / sum(pow(0.94, age)) AS cov, sum(pow(0.94, age)) ** 2 / sum(pow(0.94, age) ** 2) AS n_eff FROM g WHERE age < 446 GROUP BY 1, 2),
b AS (SELECT CASE WHEN c.i = 'O' THEN c.j ELSE c.i END AS ticker_i, c.cov, c.n_eff FROM c WHERE c.i <> c.j AND (c.i = 'O' OR c.j = 'O')),
f AS (SELECT b.*, v.cov AS v, r.cov AS v_ref FROM b JOIN c v ON v.i = b.ticker_i AND v.j = b.ticker_i JOIN c r ON r.i = 'O' AND r.j = 'O')
SELECT 'beta' AS signal, '1d' AS horizon, m.measure, ticker_i, 'O' AS ticker_j, m.v AS value, NULL::VARCHAR AS absent, round(n_eff, 6) AS n_eff, (SELECT max(t) + 86400000000 FROM returns_fx) AS asof_micros
FROM (SELECT *, unnest([{'measure': 'beta', 'v': round(cov / v_ref, 6)}, {'measure': 'idiosyncratic_share', 'v': round(1 - cov * cov / (v * v_ref), 6)}]) AS m FROM f)
""", "pairs_fx")
def signal_beta(s, d):
    return r6(signals.betas(_returns(s, d), "O"), "value", "n_eff")


@query("""
WITH e AS (SELECT ticker, count(r) AS n, stddev_samp(r) AS sd, max(t) + 86400000000 AS until FROM returns_fx GROUP BY 1),
c AS (SELECT i, j, count(*) AS n, corr(ri, rj) AS rho, regr_slope(ri, rj) AS i_on_j, regr_slope(rj, ri) AS j_on_i FROM pairs_fx WHERE i < j GROUP BY 1, 2),
p AS (SELECT a.ticker AS i, b.ticker AS j, a.n AS n_i, b.n AS n_j, greatest(a.until, b.until) AS until, coalesce(c.n, 0) AS n, rho, i_on_j, j_on_i, 0.5 * ln((1 + rho) / (1 - rho)) AS fz
  FROM e a JOIN e b ON a.ticker < b.ticker LEFT JOIN c ON c.i = a.ticker AND c.j = b.ticker),
r AS (SELECT CASE WHEN j = 'O' THEN i ELSE j END AS own, CASE WHEN j = 'O' THEN n_i ELSE n_j END AS n_own, CASE WHEN j = 'O' THEN n_j ELSE n_i END AS n_ref, CASE WHEN j = 'O' THEN i_on_j ELSE j_on_i END AS slope, n, until FROM p WHERE i = 'O' OR j = 'O'),
x AS (
  SELECT 'volatility' AS measure, ticker AS ticker_i, NULL::VARCHAR AS ticker_j, sd * sqrt(365.0::DOUBLE) AS v, n, until, ticker AS thin FROM e
  UNION ALL SELECT 'correlation', i, j, rho, n, until, CASE WHEN n_i <= n_j THEN i ELSE j END FROM p
  UNION ALL SELECT 'correlation_low', i, j, CASE WHEN n > 3 THEN tanh(fz - 1.96 / sqrt(n - 3)) END, n, until, CASE WHEN n_i <= n_j THEN i ELSE j END FROM p
  UNION ALL SELECT 'correlation_high', i, j, CASE WHEN n > 3 THEN tanh(fz + 1.96 / sqrt(n - 3)) END, n, until, CASE WHEN n_i <= n_j THEN i ELSE j END FROM p
  UNION ALL SELECT 'beta', own, 'O', slope, n, until, CASE WHEN n_own <= n_ref THEN own ELSE 'O' END FROM r)
SELECT 'derive' AS signal, 'all' AS horizon, measure, ticker_i, ticker_j, CASE WHEN n >= 100 THEN round(v, 6) END AS value,
       CASE WHEN n < 100 THEN thin || ' has ' || n || ' of 100 observations' END AS absent, n::DOUBLE AS n_eff, until AS asof_micros FROM x
""", "pairs_fx")
def signal_derive(s, d):
    return r6(signals.derive(_returns(s, d), D, 100, reference="O"), "value")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
