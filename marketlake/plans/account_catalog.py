"""Queries over stated snapshots: accounts made from customers and their orders, contracts made from parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import snapshots
from marketlake.plans import fixtures as fx
from marketlake.plans.catalog import query
from marketlake.plans.record_catalog import doubles


def _envelope(df, key, symbol, channel, payload):
    return df.select(key.alias("seq"), (key * 1_000_000).alias("recv_micros"), F.lit("stream").alias("venue"), F.lit(channel).alias("channel"), symbol.alias("symbol"), F.lit("venue").alias("origin"), payload.alias("payload"))


def _snapshots(s, d):
    n, key = F.col("n").cast("string"), F.col("c_custkey")
    position = F.struct(F.concat(F.lit("xyz:"), "o_orderstatus").alias("coin"), F.when(F.col("o_custkey") % 11 == 0, "x").otherwise(n).alias("szi"), F.struct(F.lit("cross").alias("type"), F.col("n").alias("value")).alias("leverage"))
    held = fx.table(s, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).groupBy("o_custkey").agg(F.collect_list(F.struct(position.alias("position"))).alias("p"))
    mode = F.when(key % 5 == 0, "unifiedAccount").when(key % 5 == 1, "portfolioMargin").when(key % 5 == 2, "disabled").when(key % 5 == 3, "default").otherwise("novel")
    bal = F.col("c_acctbal").cast("string")
    state = F.struct((key * 1000).alias("time"), F.struct(bal.alias("accountValue"), F.lit("7.5").alias("totalNtlPos")).alias("marginSummary"), F.when(key % 2 == 0, "1.25").alias("withdrawable"), F.col("p").alias("assetPositions"))
    payload = F.to_json(F.struct(F.when(key % 3 == 0, "xyz").otherwise("").alias("dex"), F.when(key % 7 != 0, F.struct(mode.alias("answer"))).alias("mode"), state.alias("clearinghouseState")))
    cust = fx.table(s, d, "customer").select("c_custkey", "c_acctbal").join(held, key == F.col("o_custkey"), "left")
    return snapshots.account_snapshots(_envelope(cust, key, key.cast("string"), "clearinghouseState", payload))


_MODE = "CASE WHEN c_custkey % 7 = 0 THEN 'unknown' ELSE ['unified', 'portfolio_margin', 'disabled', 'default', 'unknown'][(c_custkey % 5 + 1)::INT] END"
_BROKEN = "(c_custkey % 11 = 0 AND c_custkey IN (SELECT o_custkey FROM orders))"


@query(f"WITH m AS (SELECT c_custkey AS seq, CASE WHEN c_custkey % 3 = 0 THEN 'xyz' END AS dex, c_custkey * 1000000 AS at_micros, {_MODE} AS mode, round(c_acctbal, 2)::DOUBLE AS account_value, 7.5::DOUBLE AS total_notional, CASE WHEN c_custkey % 2 = 0 THEN 1.25::DOUBLE END AS withdrawable FROM customer WHERE NOT {_BROKEN}) SELECT *, CASE mode WHEN 'unified' THEN 'collateral is spot (unifiedAccount), out of scope' WHEN 'portfolio_margin' THEN 'collateral is spot (portfolioMargin), out of scope' WHEN 'unknown' THEN 'account mode unknown' END AS equity_not_held FROM m")
def account_margins(s, d):
    m = _snapshots(s, d)[0].select("seq", "dex", "at_micros", "mode", "account_value", "total_notional", "withdrawable", "equity_not_held")
    return doubles(m, "account_value", "total_notional", "withdrawable")


@query("SELECT o_custkey AS seq, o_orderstatus AS ticker, count(*)::DOUBLE AS size, count(*)::DOUBLE AS leverage, 'cross' AS leverage_type FROM orders WHERE o_custkey % 11 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1, 2")
def account_positions(s, d):
    return doubles(_snapshots(s, d)[1].select("seq", "ticker", "size", "leverage", "leverage_type"), "size", "leverage")


@query(f"SELECT c_custkey AS archive_seq, 'clearinghouseState' AS channel FROM customer WHERE {_BROKEN}")
def account_unparsed(s, d):
    return _snapshots(s, d)[2].select("archive_seq", "channel")


def _word(x):
    return F.lpad(F.lower(F.hex(x)), 64, "0")


def _scaled_word(x, places: int):
    """Word of a whole number times 10^places, exact past a long: its upper bits and its lowest 60."""
    v = x.cast("decimal(19,0)") * F.lit(10**places).cast(f"decimal({places + 1},0)")
    low = (v % F.lit(1 << 60)).cast("long")
    high = ((v - low) / F.lit(1 << 60)).cast("long")
    return F.lpad(F.lower(F.concat(F.hex(high), F.lpad(F.hex(low), 15, "0"))), 64, "0")


@query("SELECT p_partkey AS seq, 'T' || p_partkey AS ticker, CASE WHEN p_partkey % 6 = 0 THEN 'T' || p_partkey ELSE p_name END AS base, pow(10.0::DOUBLE, -(CASE WHEN p_partkey % 3 = 0 THEN 6 ELSE p_partkey % 19 END)) AS tick_size, NOT (p_partkey % 6 = 0) AS active, CASE p_partkey % 4 WHEN 2 THEN p_partkey / 1000.0::DOUBLE WHEN 3 THEN 0.0::DOUBLE END AS ui_multiplier FROM part")
def chain_instruments(s, d):
    p, key = fx.table(s, d, "part"), F.col("p_partkey")
    raw = F.hex(F.encode("p_name", "UTF-8"))
    text = F.concat(F.lit("0x"), _word(F.lit(32)), _word(F.length(raw) / 2), F.rpad(raw, 448, "0"))
    scaled = F.concat(F.lit("0x"), _scaled_word(key, 15))
    multiplier = F.when(key % 4 == 1, "0x").when(key % 4 == 2, scaled).when(key % 4 == 3, F.concat(F.lit("0x"), _word(F.lit(0))))
    answers = F.struct(F.when(key % 6 != 0, text).alias("symbol"), F.when(key % 3 != 0, F.concat(F.lit("0x"), _word(key % 19))).alias("decimals"), multiplier.alias("uiMultiplier"))
    address = F.concat(F.lit("0x"), F.lpad(F.hex(key), 40, "0"))
    known = p.select(address.alias("address"), F.concat(F.lit("T"), key.cast("string")).alias("ticker"), F.lit(6).alias("decimals"))
    rows = snapshots.instruments(_envelope(p, key, address, "contract", F.to_json(answers)), known)[0]
    return doubles(rows.select("seq", "ticker", "base", "tick_size", "active", "ui_multiplier"), "tick_size", "ui_multiplier")
