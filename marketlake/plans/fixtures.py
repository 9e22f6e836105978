"""Tape-shaped views over the given tables, as DataFrames and as the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SQL = {
    "ev": "SELECT event_id, epoch_us(ts) AS t, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "marks_fx": "SELECT event_type AS ticker, t, 100 + value / 100 AS mark, 100 + k / 100.0::DOUBLE AS oracle, (100 + value / 100) / (100 + k / 100.0::DOUBLE) - 1 AS premium, 1000.0::DOUBLE + user_id AS open_interest, event_id FROM ev",
    "quotes_fx": "SELECT CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue, event_type AS ticker, t, 100 + value / 100 - 0.01::DOUBLE * (1 + user_id % 5) AS bid_px, 100 + value / 100 + 0.01::DOUBLE * (1 + k % 5) AS ask_px, (1 + user_id % 7)::DOUBLE AS bid_sz, (1 + k % 7)::DOUBLE AS ask_sz, event_id FROM ev",
    "trades_one": "SELECT CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue, event_type AS ticker, t, 100 + value / 100 AS price, (1 + user_id % 9)::DOUBLE AS size, CASE WHEN k % 2 = 0 THEN 'bid' ELSE 'ask' END AS aggressor, event_id AS trade_id, t + 1000 * (1 + k) AS recv_micros FROM ev WHERE event_type IN ('purchase', 'click')",
    "trades_fx": "SELECT * FROM trades_one UNION ALL SELECT * REPLACE (recv_micros + 90000000 AS recv_micros) FROM trades_one WHERE trade_id % 50 = 0",
    "candles_fx": "SELECT o_orderstatus AS ticker, (epoch_us(o_orderdate) // 86400000000) * 86400000000 AS t, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS close FROM orders GROUP BY 1, 2",
    "returns_fx": "SELECT a.ticker, a.t, ln(a.close / b.close) AS r FROM candles_fx a JOIN candles_fx b ON a.ticker = b.ticker AND a.t = b.t + 86400000000",
    "pairs_fx": "SELECT a.t, a.ticker AS i, b.ticker AS j, a.r AS ri, b.r AS rj FROM returns_fx a JOIN returns_fx b ON a.t = b.t AND a.ticker <= b.ticker",
    "funding_fx": "SELECT event_type AS ticker, (t // 3600000000) * 3600000000 AS t, (avg(value) - 50) / 1e6 AS rate FROM ev GROUP BY 1, 2",
    "live_fx": "SELECT event_type AS ticker, t AS recv_micros, k / 1e7::DOUBLE AS rate FROM ev WHERE k % 4 = 1",
    "hours_fx": "SELECT event_type AS ticker, (t // 3600000000) * 3600000000 AS t, arg_max(100 + value / 100, (t, event_id)) AS close FROM ev GROUP BY 1, 2",
    "hour_returns_fx": "SELECT a.ticker, a.t, ln(a.close / b.close) AS r FROM hours_fx a JOIN hours_fx b ON a.ticker = b.ticker AND a.t = b.t + 3600000000",
    "fills_raw": "SELECT l_suppkey % 50 AS account, l_returnflag AS ticker, CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side, l_extendedprice / l_quantity AS price, l_quantity AS size, l_orderkey AS order_id, l_linenumber AS trade_id, epoch_us(l_shipdate) AS t, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem",
    "fills_fx": "SELECT *, CASE WHEN order_id % 40 = 0 THEN (order_id % 7)::DOUBLE END AS start_position FROM fills_raw QUALIFY row_number() OVER (PARTITION BY order_id, trade_id ORDER BY t, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1",
    "transfers_fx": "SELECT o_orderkey // 10 AS block, o_orderkey AS seq, o_totalprice AS amount FROM orders",
    "reorgs_fx": "SELECT 40 * n_nationkey AS from_block, 40 * n_nationkey + 10 AS to_block, 500 * n_nationkey AS seq FROM nation",
    "inventory_fx": "SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m') AS \"partition\", 'v' || (l_linenumber % 2) AS venue, 'f' || l_linenumber AS file, min(l_orderkey) AS first, max(l_orderkey) AS last, count(*) AS n_rows FROM lineitem GROUP BY 1, 2, 3",
    "stood_fx": "SELECT m.*, p AS period, least(e, p + 3600000000) - greatest(t, p) AS w FROM (SELECT *, least(coalesce(lead(t) OVER (PARTITION BY ticker ORDER BY t, event_id), t + 7200000000), t + 7200000000) AS e FROM marks_fx) m, unnest(range((t // 3600000000) * 3600000000, e, 3600000000)) AS u(p) WHERE e > t",
}
_NEEDS = {"marks_fx": ["ev"], "quotes_fx": ["ev"], "trades_one": ["ev"], "trades_fx": ["trades_one"], "returns_fx": ["candles_fx"], "pairs_fx": ["returns_fx"], "funding_fx": ["ev"], "live_fx": ["ev"], "hours_fx": ["ev"], "hour_returns_fx": ["hours_fx"], "fills_fx": ["fills_raw"], "stood_fx": ["marks_fx"]}


def with_views(sql: str, *names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for m in _NEEDS.get(n, []):
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    views = ", ".join(f"{n} AS ({SQL[n]})" for n in order)
    sql = sql.strip()
    if not order:
        return sql
    if sql.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views}, {sql[15:]}"
    return f"WITH {views}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {views} {sql}"


def _us(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", _us("ts").alias("t"), "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("long").alias("k"))


def marks(spark: SparkSession, sf: str) -> DataFrame:
    return ev(spark, sf).selectExpr("event_type AS ticker", "t", "100 + value / 100 AS mark", "100 + k / 100.0D AS oracle", "(100 + value / 100) / (100 + k / 100.0D) - 1 AS premium", "1000.0D + user_id AS open_interest", "event_id")


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    return ev(spark, sf).selectExpr("CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue", "event_type AS ticker", "t", "100 + value / 100 - 0.01D * (1 + user_id % 5) AS bid_px", "100 + value / 100 + 0.01D * (1 + k % 5) AS ask_px", "CAST(1 + user_id % 7 AS DOUBLE) AS bid_sz", "CAST(1 + k % 7 AS DOUBLE) AS ask_sz", "event_id")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    one = ev(spark, sf).where("event_type IN ('purchase', 'click')").selectExpr("CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue", "event_type AS ticker", "t", "100 + value / 100 AS price", "CAST(1 + user_id % 9 AS DOUBLE) AS size", "CASE WHEN k % 2 = 0 THEN 'bid' ELSE 'ask' END AS aggressor", "event_id AS trade_id", "t + 1000 * (1 + k) AS recv_micros")
    return one.unionByName(one.where("trade_id % 50 = 0").withColumn("recv_micros", F.col("recv_micros") + 90_000_000))


def candles(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("_o", F.struct("o_orderdate", "o_orderkey"))
    day = 86_400_000_000
    return o.groupBy(F.col("o_orderstatus").alias("ticker"), (F.floor(_us("o_orderdate") / day) * day).alias("t")).agg(F.min_by("o_totalprice", "_o").alias("open"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", "_o").alias("close"))


def funding(spark: SparkSession, sf: str) -> DataFrame:
    h = 3_600_000_000
    return ev(spark, sf).groupBy(F.col("event_type").alias("ticker"), (F.floor(F.col("t") / h) * h).alias("t")).agg(((F.avg("value") - 50) / 1e6).alias("rate"))


def live_rates(spark: SparkSession, sf: str) -> DataFrame:
    return ev(spark, sf).where("k % 4 = 1").selectExpr("event_type AS ticker", "t AS recv_micros", "k / 1e7D AS rate")


def hours(spark: SparkSession, sf: str) -> DataFrame:
    """Last price of each hour."""
    h = 3_600_000_000
    return ev(spark, sf).groupBy(F.col("event_type").alias("ticker"), (F.floor(F.col("t") / h) * h).alias("t")).agg(F.max_by(100 + F.col("value") / 100, F.struct("t", "event_id")).alias("close"))


def fills(spark: SparkSession, sf: str) -> DataFrame:
    """Account fills, one per (order, line): the least row by (ship date, part, supplier, quantity, price)."""
    rest = F.struct(_us("l_shipdate").alias("t"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    one = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("trade_id")).agg(F.min(rest).alias("s")).select("order_id", "trade_id", "s.*")
    return one.selectExpr("l_suppkey % 50 AS account", "l_returnflag AS ticker", "CASE WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side", "l_extendedprice / l_quantity AS price", "l_quantity AS size", "order_id", "trade_id", "t", "CASE WHEN order_id % 40 = 0 THEN CAST(order_id % 7 AS DOUBLE) END AS start_position")


def transfers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr("o_orderkey DIV 10 AS block", "o_orderkey AS seq", "o_totalprice AS amount")


def reorgs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").selectExpr("CAST(40 * n_nationkey AS BIGINT) AS from_block", "CAST(40 * n_nationkey + 10 AS BIGINT) AS to_block", "CAST(500 * n_nationkey AS BIGINT) AS seq")


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy(F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM").alias("partition"), F.expr("concat('v', l_linenumber % 2)").alias("venue"), F.expr("concat('f', l_linenumber)").alias("file")).agg(F.min("l_orderkey").alias("first"), F.max("l_orderkey").alias("last"), F.count(F.lit(1)).alias("n_rows"))
