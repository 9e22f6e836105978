"""Queries over the record: payloads to typed rows, stores, identity rules, gaps, checks and ledger sums, with their SQL.

The record is made by Spark from the events table (:func:`record`): one payload an event, by its id in
eight channels, some of them broken, with an unknown channel and with control frames.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.operators import aggs, dedupe, filters, joins, ledger, normalise, quality, windows
from marketlake.plans import fixtures as fx
from marketlake.plans import signals
from marketlake.plans.catalog import D, H, M, query, r6
from marketlake.sources import maintenance, store
from marketlake.streaming import live, ordered

HOUR_MS = 3_600_000


def folder(spark: SparkSession) -> str:
    """A new folder in the place that all executors share; a temporary one only where all tasks run in this process."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if at is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{at or 'file://' + tempfile.mkdtemp(prefix='spark-')}/{uuid.uuid4().hex}"


def _px(shift: int = 0) -> Column:
    return F.concat((F.col("user_id") + shift).cast("string"), F.lit("."), F.col("k").cast("string"))


def record(spark: SparkSession, sf: str) -> DataFrame:
    """The events as verbatim payloads of a venue called ``stream``."""
    c, k, ms = F.col("event_id") % 8, F.col("k"), F.floor(F.col("t") / 1000)
    coin, sz, none = F.col("event_type").alias("coin"), (1 + k % 7).cast("string").alias("sz"), F.lit(None).cast("string")
    px, start = _px().alias("px"), F.floor(F.col("t") / H) * HOUR_MS
    side = F.when(k % 3 == 0, "B").when(k % 3 == 1, "A").otherwise("X").alias("side")
    level = lambda s: F.struct(_px(s).alias("px"), sz, F.lit(1).alias("n"))
    rate = lambda r: F.struct(coin, r.alias("fundingRate"), ms.alias("time"))
    text = lambda x: x.cast("string")
    candle = F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in ("t", text(start), "T", text(start + HOUR_MS - 1), "s", F.col("event_type"), "i", F.lit("1h"), "o", _px(), "h", _px(3), "l", _px(), "c", _px(1), "v", text(k))])
    payload = (
        F.when(c == 0, F.to_json(F.array(F.struct(coin, side, px, sz, ms.alias("time"), F.col("event_id").alias("tid")))))
        .when(c == 1, F.to_json(F.struct(coin, ms.alias("time"), F.array(F.struct(px, sz), F.when(k % 4 != 0, F.struct(_px(1).alias("px"), sz))).alias("bbo"))))
        .when(c == 2, F.to_json(candle))
        .when(c == 3, F.to_json(F.array(rate(F.concat(F.lit("0.0000"), text(k))), rate(F.when(k % 5 == 0, "x").otherwise("0.5")))))
        .when(c == 4, F.to_json(F.struct(coin, F.struct(_px().alias("markPx"), _px(1).alias("oraclePx"), F.when(k % 2 == 1, "0.0001").otherwise(none).alias("funding"), text(k).alias("openInterest")).alias("ctx"))))
        .when(c == 5, F.to_json(F.struct(coin, ms.alias("time"), F.array(F.array(level(0)), F.array(level(1), level(2))).alias("levels"))))
        .when(c == 6, "{broken").otherwise("{}"))
    names = ("trades", "bbo", "candle", "fundingHistory", "activeAssetCtx", "l2Book", "trades")
    channel = F.when(c == 7, F.when(k % 2 == 0, "pong").otherwise("strange"))
    for i, n in enumerate(names):
        channel = channel.when(c == i, n)
    recv = F.when(c == 2, F.col("t") + F.when(k % 2 == 1, 2 * H).otherwise(M)).otherwise(F.col("t") + 1000 * (1 + k))
    return fx.ev(spark, sf).select(F.col("event_id").alias("seq"), recv.alias("recv_micros"), F.lit("stream").alias("venue"), F.lit("raw").alias("kind"), channel.alias("channel"), F.col("event_type").alias("symbol"), F.lit("venue").alias("origin"), payload.alias("payload"))


def _kind(s, d, kind: str) -> DataFrame:
    return normalise.normalise(record(s, d), "stream")[kind]


def doubles(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


PX, SZ = "(user_id || '.' || k)::DOUBLE", "(1 + k % 7)::DOUBLE"
PX1, PX2, PX3 = (f"((user_id + {i}) || '.' || k)::DOUBLE" for i in (1, 2, 3))


@query(f"SELECT event_id AS seq, event_type AS ticker, (t // 1000) * 1000 AS at_micros, {PX} AS price, {SZ} AS size, CASE k % 3 WHEN 0 THEN 'bid' ELSE 'ask' END AS aggressor, event_id AS trade_id FROM ev WHERE event_id % 8 = 0 AND k % 3 < 2", "ev")
def record_trades(s, d):
    return doubles(_kind(s, d, "trades").select("seq", "ticker", "at_micros", "price", "size", "aggressor", "trade_id"), "price", "size")


@query(f"SELECT event_id AS seq, event_type AS ticker, {PX} AS bid_px, {SZ} AS bid_sz, CASE WHEN k % 4 <> 0 THEN {PX1} END AS ask_px, CASE WHEN k % 4 <> 0 THEN {SZ} END AS ask_sz FROM ev WHERE event_id % 8 = 1", "ev")
def record_quotes(s, d):
    return doubles(_kind(s, d, "quotes").select("seq", "ticker", "bid_px", "bid_sz", "ask_px", "ask_sz"), "bid_px", "bid_sz", "ask_px", "ask_sz")


CANDLES = f"SELECT event_id AS seq, event_type AS ticker, '1h' AS interval, (t // 3600000000) * 3600000000 AS at_micros, {PX} AS open, {PX3} AS high, {PX1} AS close, t + CASE WHEN k % 2 = 1 THEN 7200000000 ELSE 60000000 END AS recv_micros FROM ev WHERE event_id % 8 = 2"


@query(f"SELECT seq, ticker, interval, at_micros, open, high, close, recv_micros >= at_micros + 3599999000 AS is_final FROM ({CANDLES})", "ev")
def record_candles(s, d):
    return doubles(_kind(s, d, "candles").select("seq", "ticker", "interval", "at_micros", "open", "high", "close", "is_final"), "open", "high", "close")


@query("SELECT event_id AS seq, event_type AS ticker, r.rate, count(*) AS n FROM (SELECT *, unnest([{'rate': ('0.0000' || k)::DOUBLE}, {'rate': CASE WHEN k % 5 <> 0 THEN 0.5 END}]) AS r FROM ev WHERE event_id % 8 = 3) WHERE r.rate IS NOT NULL GROUP BY 1, 2, 3", "ev")
def record_funding(s, d):
    return doubles(_kind(s, d, "funding").where("settled"), "rate").groupBy("seq", "ticker", "rate").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id AS seq, event_type AS ticker, 0.0001::DOUBLE AS rate FROM ev WHERE event_id % 8 = 4 AND k % 2 = 1", "ev")
def record_live_funding(s, d):
    return doubles(_kind(s, d, "funding").where("NOT settled").select("seq", "ticker", "rate"), "rate")


@query(f"SELECT event_id AS seq, event_type AS ticker, {PX} AS mark, {PX1} AS oracle, k::DOUBLE AS open_interest FROM ev WHERE event_id % 8 = 4", "ev")
def record_marks(s, d):
    return doubles(_kind(s, d, "marks").select("seq", "ticker", "mark", "oracle", "open_interest"), "mark", "oracle", "open_interest")


@query(f"SELECT event_id AS seq, event_type AS ticker, l.side, l.level, l.price, {SZ} AS size FROM (SELECT *, unnest([{{'side': 'bid', 'level': 0, 'price': {PX}}}, {{'side': 'ask', 'level': 0, 'price': {PX1}}}, {{'side': 'ask', 'level': 1, 'price': {PX2}}}]) AS l FROM ev WHERE event_id % 8 = 5)", "ev")
def record_book(s, d):
    return doubles(_kind(s, d, "book").select("seq", "ticker", "side", "level", "price", "size"), "price", "size")


BAD = "SELECT CASE WHEN event_id % 8 = 3 THEN 'fundingHistory' WHEN event_id % 8 = 7 THEN 'strange' ELSE 'trades' END AS channel, event_id AS archive_seq FROM ev WHERE (event_id % 8 = 0 AND k % 3 = 2) OR (event_id % 8 = 3 AND k % 5 = 0) OR event_id % 8 = 6 OR (event_id % 8 = 7 AND k % 2 = 1)"


@query(BAD, "ev")
def record_unparsed(s, d):
    return _kind(s, d, "unparsed").select("channel", "archive_seq")


@query(f"WITH b AS ({BAD}), r AS (SELECT CASE event_id % 8 WHEN 1 THEN 'bbo' WHEN 2 THEN 'candle' WHEN 3 THEN 'fundingHistory' WHEN 4 THEN 'activeAssetCtx' WHEN 5 THEN 'l2Book' WHEN 7 THEN CASE WHEN k % 2 = 0 THEN 'pong' ELSE 'strange' END ELSE 'trades' END AS channel FROM ev), n AS (SELECT channel, count(*) AS failed FROM b GROUP BY 1) SELECT r.channel, count(*) AS rows, coalesce(max(failed), 0) AS failed FROM r LEFT JOIN n USING (channel) GROUP BY 1", "ev")
def unparsed_share(s, d):
    r = record(s, d)
    return quality.unparsed_share(_kind(s, d, "unparsed"), r)


@query("SELECT count(*) AS n FROM ev WHERE NOT (event_id % 8 = 7 AND k % 2 = 0)", "ev")
def control_frames_dropped(s, d):
    return normalise.drop_control(record(s, d)).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT event_id AS seq, upper(event_type) AS ticker, (t // 1000000) * 1000000 AS at_micros, {PX} AS bid_px, {PX1} AS ask_px, {SZ} AS bid_sz, {SZ} AS ask_sz FROM ev WHERE event_type IN ('click', 'purchase')", "ev")
def polled_quotes(s, d):
    q = F.struct(F.struct(F.col("event_type").alias("symbol"), _px().alias("bid_inclusive_of_sell_spread"), _px(1).alias("ask_inclusive_of_buy_spread"), (1 + F.col("k") % 7).cast("string").alias("quantity"), F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")).alias("x"))
    ev = fx.ev(s, d)
    rows = ev.select(F.col("event_id").alias("seq"), F.col("t").alias("recv_micros"), F.lit("poll").alias("venue"), F.lit("best_bid_ask").alias("channel"), F.lit("").alias("symbol"), F.lit("venue").alias("origin"), F.to_json(F.struct(F.array(q["x"]).alias("results"))).alias("payload"))
    symbols = ev.where("event_type IN ('click', 'purchase')").select(F.col("event_type").alias("symbol"), F.upper("event_type").alias("ticker")).distinct()
    return doubles(normalise.polled_quotes(rows, symbols)[0].select("seq", "ticker", "at_micros", "bid_px", "ask_px", "bid_sz", "ask_sz"), "bid_px", "ask_px", "bid_sz", "ask_sz")


def _chain(s, d):
    o = fx.table(s, d, "orders")
    key = F.col("o_orderkey")
    word = lambda x: F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(x)), 64, "0"))
    topics = F.array(F.lit(normalise.TRANSFER), word(F.when(key % 7 == 0, 0).otherwise(key)), word(key + 1))
    topics = F.when(key % 10 == 9, F.concat(topics, F.array(word(key)))).otherwise(topics)
    log = F.struct(F.when(key % 3 == 0, "0xBB").otherwise("0xAA").alias("address"), topics.alias("topics"), F.concat(F.lit("0x"), F.hex(key * 3)).alias("data"), F.concat(F.lit("0x"), F.hex(F.floor(key / 10))).alias("blockNumber"), word(key).alias("transactionHash"), F.lit("0x1").alias("logIndex"))
    rows = o.select(key.alias("seq"), F.lit(0).cast("long").alias("recv_micros"), F.lit("chain").alias("venue"), F.lit("logs").alias("channel"), F.lit("").alias("symbol"), F.lit("venue").alias("origin"), F.to_json(F.array(log)).alias("payload"))
    known = fx.table(s, d, "region").where("r_regionkey = 0").select(F.lit("0xaa").alias("address"), F.lit("TOK").alias("ticker"), F.lit(1).alias("decimals"))
    return normalise.chain_logs(rows, known)


CHAIN = "FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 10 <> 9"


@query(f"SELECT o_orderkey AS seq, 'TOK' AS ticker, o_orderkey // 10 AS block, round(o_orderkey * 3 / 10, 1) AS amount {CHAIN} AND o_orderkey % 7 <> 0")
def chain_transfers(s, d):
    return doubles(_chain(s, d)[0].select("seq", "ticker", "block", "amount"), "amount")


@query(f"SELECT o_orderkey AS seq, o_orderkey // 10 AS block, 'issue' AS kind {CHAIN} AND o_orderkey % 7 = 0")
def chain_mints(s, d):
    return _chain(s, d)[1].select("seq", "block", "kind")


def _page(s, d, payload: Column, channel: str) -> DataFrame:
    f = fx.fills(s, d)
    return f.select((F.col("order_id") * 10 + F.col("trade_id")).alias("seq"), F.col("t").alias("recv_micros"), F.lit("stream").alias("venue"), F.lit(channel).alias("channel"), F.col("account").cast("string").alias("symbol"), F.lit("venue").alias("origin"), payload.alias("payload"))


@query("SELECT order_id * 10 + trade_id AS seq, CASE WHEN trade_id % 2 = 0 THEN 'xyz' ELSE '' END AS dex, ticker, side, size, t AS at_micros FROM fills_fx", "fills_fx")
def account_fills(s, d):
    coin = F.when(F.col("trade_id") % 2 == 0, F.concat(F.lit("xyz:"), "ticker")).otherwise(F.col("ticker"))
    one = F.struct(coin.alias("coin"), F.when(F.col("side") == "bid", "B").otherwise("A").alias("side"), F.lit("1.5").alias("px"), F.col("size").cast("string").alias("sz"), F.floor(F.col("t") / 1000).alias("time"), F.col("order_id").alias("oid"), F.col("trade_id").alias("tid"))
    return doubles(normalise.account_fills(_page(s, d, F.to_json(F.array(one)), "userFills"))[0].select("seq", "dex", "ticker", "side", "size", "at_micros"), "size")


@query("SELECT order_id * 10 + trade_id AS seq, ticker, -1.25 AS usdc, size, t AS at_micros FROM fills_fx", "fills_fx")
def account_payments(s, d):
    delta = F.struct(F.col("ticker").alias("coin"), F.lit("-1.25").alias("usdc"), F.col("size").cast("string").alias("szi"), F.lit("0.001").alias("fundingRate"))
    one = F.struct(F.floor(F.col("t") / 1000).alias("time"), delta.alias("delta"))
    return doubles(normalise.account_funding(_page(s, d, F.to_json(F.array(one)), "userFunding"))[0].select("seq", "ticker", "usdc", "size", "at_micros"), "usdc", "size")


@query("SELECT event_id AS seq, event_type AS series, t AS from_us, t + k AS to_us FROM ev WHERE k % 2 = 0", "ev")
def generated_events(s, d):
    ev = fx.ev(s, d)
    p = F.to_json(F.struct(F.col("event_type").alias("series"), F.col("t").alias("from_us"), (F.col("t") + F.col("k")).alias("to_us")))
    rows = ev.select(F.col("event_id").alias("seq"), F.col("t").alias("recv_micros"), F.lit("stream").alias("venue"), F.lit("gaps").alias("channel"), F.lit("").alias("symbol"), F.when(F.col("k") % 2 == 0, "generated").otherwise("venue").alias("origin"), p.alias("payload"))
    return normalise.generated(rows, "series string, from_us long, to_us long")[0].select("seq", "series", "from_us", "to_us")


@query("SELECT venue, ticker, trade_id, price, 'markets.' || venue || '.' || ticker || '.trades' AS topic FROM trades_one", "trades_one")
def bus_roundtrip(s, d):
    t = dedupe.dedupe_trades(fx.trades(s, d)).select("venue", "ticker", F.lit("trades").alias("kind"), "trade_id", "price")
    sent = normalise.encode_envelopes(t)
    good, _ = normalise.decode_envelopes(sent, {"venue": "string", "ticker": "string", "kind": "string", "trade_id": "long", "price": "double"})
    return good.select("venue", "ticker", "trade_id", "price", F.concat_ws(".", F.lit("markets"), "venue", "ticker", "kind").alias("topic"))


# stores

@query("SELECT event_id AS seq FROM ev WHERE (CASE WHEN event_id % 8 = 2 THEN t + CASE WHEN k % 2 = 1 THEN 7200000000 ELSE 60000000 END ELSE t + 1000 * (1 + k) END) BETWEEN 1704844800000000 AND 1705276799999999", "ev")
def stored_record_range(s, d):
    at = folder(s)
    store.write_record(record(s, d), at)
    return store.read_record(s, at, ["stream/raw"], 1_704_844_800_000_000, 1_705_276_800_000_000).select("seq")


@query("SELECT event_id AS seq FROM ev WHERE event_id % 8 = 0 AND k % 3 < 2 AND event_type = 'click' AND (t // 1000) * 1000 BETWEEN 1704844800000000 AND 1705276799999999", "ev")
def stored_tape_window(s, d):
    at = folder(s)
    store.write_tape(_kind(s, d, "trades"), at, "trades")
    return store.read_tape(s, at, "trades", 1_704_844_800_000_000, 1_705_276_800_000_000, "click").select("seq")


_REC = "r AS (SELECT event_id AS seq, event_type, CASE WHEN event_id % 8 = 2 THEN t + CASE WHEN k % 2 = 1 THEN 7200000000 ELSE 60000000 END ELSE t + 1000 * (1 + k) END AS recv FROM ev), rd AS (SELECT *, strftime(make_timestamp(recv), '%Y-%m-%d') AS day FROM r)"


def _stored(s, d) -> str:
    at = folder(s)
    store.write_record(record(s, d), at)
    return at


@query(f"WITH {_REC} SELECT 'stream/raw/' || day AS \"partition\", count(*) AS n_rows, min(seq) AS first, max(seq) AS last, min(recv) AS recv_first, max(recv) AS recv_last FROM rd GROUP BY 1", "ev")
def stored_file_inventory(s, d):
    """Files of the record from their footers, put together by partition."""
    return maintenance.inventory(s, _stored(s, d)).groupBy("partition").agg(F.sum("n_rows").alias("n_rows"), *[f(c).alias(c) for f, c in ((F.min, "first"), (F.max, "last"), (F.min, "recv_first"), (F.max, "recv_last"))])


@query(f"WITH {_REC} SELECT day, count(*) AS n_rows, sum(seq)::BIGINT AS total, CASE WHEN day < '2024-01-15' THEN 1 END AS files FROM rd GROUP BY 1", "ev")
def stored_compaction(s, d):
    """The record after its closed days were compacted in place: rows and, of closed days, files."""
    at = _stored(s, d)
    maintenance.compact_closed_days(s, at, "2024-01-15")
    rows = s.read.parquet(at).groupBy(F.col("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("seq").alias("total"))
    files = maintenance.listing(s, at).where("recognised").groupBy(F.col("date").cast("string").alias("day")).agg(F.count(F.lit(1)).cast("int").alias("files"))
    return rows.join(files, "day").withColumn("files", F.when(F.col("day") < "2024-01-15", F.col("files")))


@query(f"WITH {_REC} SELECT count(*) AS n_rows, sum(seq)::BIGINT AS total, 1 AS most FROM rd WHERE day = '2024-01-15'", "ev")
def stored_closed_hours(s, d):
    """Today's record, flushed every two hours, after its hours before noon were compacted: rows, and the most files that end in one closed hour."""
    at, noon = folder(s), 1_705_320_000_000_000
    today = record(s, d).where((F.col("recv_micros") >= noon - 12 * H) & (F.col("recv_micros") < noon + 12 * H))
    for k in range(12):
        store.write_record(today.where(F.floor((F.col("recv_micros") - noon) / (2 * H)) == k - 6), at)
    maintenance.compact_closed_hours(s, at, "2024-01-15", noon)
    most = maintenance.inventory(s, at).where(F.col("recv_last") < noon).groupBy(F.floor(F.col("recv_last") / H)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").cast("int").alias("most"))
    rows = s.read.parquet(at).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("seq").alias("total"))
    return rows.withColumn("_k", F.lit(0)).join(most.withColumn("_k", F.lit(0)), "_k").drop("_k")


@query(f"WITH {_REC} SELECT DISTINCT 'stream/raw/' || day AS subject, 'stream' AS venue, CASE WHEN day <= '2024-01-14' THEN 'expired' ELSE 'kept' END AS verdict FROM rd", "ev")
def retention_report(s, d):
    return maintenance.retention(maintenance.listing(s, _stored(s, d)), {"stream": 10}, 1_706_140_800_000_000).select("subject", "venue", "verdict")


@query("SELECT ticker AS ticker_i, t AS asof_micros, round(premium, 9) AS value FROM marks_fx WHERE t >= 1704844800000000 AND t < 1705276800000000", "marks_fx")
def stored_signals(s, d):
    """Rows committed after their checks, read back by the date of their asof."""
    text, none = F.lit, F.lit(None).cast("string")
    rows = fx.marks(s, d).select(text("basis").alias("signal"), text("1h").alias("horizon"), text("premium").alias("measure"), F.col("ticker").alias("ticker_i"), none.alias("ticker_j"), F.round("premium", 9).alias("value"), none.alias("absent"), F.lit(1.0).alias("n_eff"), F.col("t").alias("asof_micros"), F.lit(1).cast("long").alias("computed_micros"), text("run-1").alias("run_id"), text("{}").alias("params"))
    at = folder(s)
    store.commit_signals(rows, at)
    return store.read_signals(s, at, 1_704_844_800_000_000, 1_705_276_800_000_000).select("ticker_i", "asof_micros", "value")


@query("SELECT account, count(*) AS n, round(sum(size), 6) AS size FROM fills_fx GROUP BY 1", "fills_fx")
def stored_ledger(s, d):
    at = folder(s)
    store.write_ledger({"fills": fx.fills(s, d).withColumn("venue", F.lit("v"))}, at)
    return r6(s.read.parquet(f"{at}/fills").groupBy(F.col("account").cast("long").alias("account")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")), "size")


@query("SELECT trade_id, CASE WHEN recv_micros // 86400000000 BETWEEN 19732 AND 19733 THEN price * 2 ELSE price END AS price FROM trades_one WHERE NOT (recv_micros // 86400000000 BETWEEN 19732 AND 19733 AND trade_id % 5 = 0)", "trades_one")
def source_days_replaced(s, d):
    """Two days of a venue written anew with other prices and fewer rows; all other days as they were."""
    t = dedupe.dedupe_trades(fx.trades(s, d)).withColumn("at_micros", F.col("t")).withColumn("seq", F.col("trade_id"))
    at = folder(s)
    store.replace_source_days(t, at, "v", "2020-01-01", "2030-01-01")
    days = F.floor(F.col("recv_micros") / D).between(19732, 19733)
    store.replace_source_days(t.where(days & (F.col("trade_id") % 5 != 0)).withColumn("price", F.col("price") * 2), at, "v", "2024-01-10", "2024-01-12")
    return s.read.parquet(at).select("trade_id", "price")


# filters and identity

@query("SELECT trade_id FROM trades_one WHERE (trade_id % 11 = 0 OR (t >= 1704844800000000 AND t < 1705276800000000)) AND ticker = 'click'", "trades_one")
def rows_in_window(s, d):
    t = dedupe.dedupe_trades(fx.trades(s, d)).withColumn("at_micros", F.when(F.col("trade_id") % 11 != 0, F.col("t")))
    return filters.in_window(t, 1_704_844_800_000_000, 1_705_276_800_000_000, "click").select("trade_id")


@query("SELECT trade_id, venue FROM trades_one WHERE venue = 'a' AND trade_id <= (SELECT max(trade_id) // 2 FROM trades_one WHERE venue = 'a')", "trades_one")
def rows_up_to_bound(s, d):
    t = dedupe.dedupe_trades(fx.trades(s, d)).withColumn("stream_seq", F.col("trade_id"))
    bound = t.where("venue = 'a'").groupBy("venue").agg(F.floor(F.max("trade_id") / 2).alias("bound"))
    return filters.apply_bound(t, bound).select("trade_id", "venue")


@query(f"SELECT seq FROM ({CANDLES}) WHERE recv_micros >= at_micros + 3600000000 AND at_micros >= 1704844800000000 AND at_micros + 3600000000 <= 1705276800000000", "ev")
def closing_bars(s, d):
    return filters.closing_bars(_kind(s, d, "candles"), H, 1_704_844_800_000_000, 1_705_276_800_000_000).select("seq")


@query("WITH l AS (SELECT event_id, (make_timestamp(t) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ts FROM ev) SELECT event_id FROM l WHERE CASE dayofweek(ts) WHEN 6 THEN false WHEN 0 THEN hour(ts) >= 18 WHEN 5 THEN hour(ts) < 17 ELSE hour(ts) <> 17 END", "ev")
def rows_in_session(s, d):
    return fx.ev(s, d).where(filters.external(F.col("t"))).select("event_id")


@query("SELECT ticker, t FROM funding_fx WHERE (t // 3600000000) % 3 <> 0", "funding_fx")
def only_new_periods(s, d):
    f = fx.funding(s, d).select("ticker", F.col("t").alias("asof_micros"), F.lit("x").alias("signal"), F.lit("1h").alias("horizon"))
    held = f.where(F.floor(F.col("asof_micros") / H) % 3 == 0)
    return filters.only_new(f, held, ("signal", "horizon", "ticker", "asof_micros")).select("ticker", F.col("asof_micros").alias("t"))


@query("SELECT venue, ticker, count(*) AS n FROM trades_fx WHERE (venue = 'a' AND ticker = 'click') OR venue = 'b' GROUP BY 1, 2", "trades_fx")
def rows_in_scope(s, d):
    return filters.in_scope(fx.trades(s, d), ["a/click", "b"], ("venue", "ticker")).groupBy("venue", "ticker").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT ticker, at_micros, max(recv_micros) AS recv_micros FROM ({CANDLES}) GROUP BY 1, 2", "ev")
def candles_once(s, d):
    return dedupe.latest_candles(_kind(s, d, "candles")).select("ticker", "at_micros", "recv_micros")


@query("SELECT account, order_id, trade_id FROM fills_fx", "fills_fx")
def fills_once(s, d):
    f = fx.fills(s, d)
    return dedupe.dedupe_events(f.unionByName(f.where("order_id % 3 = 0")), "fills").select("account", "order_id", "trade_id")


@query("SELECT DISTINCT event_type, user_id FROM ev WHERE event_type <> 'click' AND user_id NOT IN (SELECT user_id FROM ev WHERE event_type = 'click' AND k < 3)", "ev")
def missing_pairs(s, d):
    ev = fx.ev(s, d)
    return dedupe.missing(ev.where("event_type <> 'click'").select("event_type", "user_id").distinct(), ev.where("event_type = 'click' AND k < 3"), ["user_id"]).select("event_type", "user_id")


@query("SELECT 'trade' AS what, venue, ticker, count(*) AS n, sum(price) IS NULL AS no_price FROM trades_fx GROUP BY 2, 3 UNION ALL SELECT 'quote', venue, ticker, count(*), true FROM quotes_fx GROUP BY 2, 3", "trades_fx", "quotes_fx")
def venues_unified(s, d):
    both = dedupe.unify(fx.trades(s, d).withColumn("what", F.lit("trade")), fx.quotes(s, d).withColumn("what", F.lit("quote")))
    return both.groupBy("what", "venue", "ticker").agg(F.count(F.lit(1)).alias("n"), (F.count("price") == 0).alias("no_price"))


@query("SELECT DISTINCT o_orderkey AS seq FROM orders")
def chain_events_once(s, d):
    t = fx.transfers(s, d).select("seq", F.col("seq").alias("tx_hash"), F.lit(1).alias("log_index"), F.lit(None).cast("long").alias("reorg_seq"))
    return dedupe.dedupe_chain(t.unionByName(t)).select("seq")


# joins and windows of the tape

@query("SELECT a.ticker, a.t AS asof, round(b.r, 9) AS r FROM returns_fx a JOIN returns_fx b ON a.ticker = b.ticker AND a.t = b.t", "returns_fx")
def matched_tails(s, d):
    r = windows.log_returns(fx.candles(s, d), D)
    return r6(joins.match_tails(r.select("ticker", F.col("t").alias("asof")), r), "r", places=9)


@query("SELECT event_id, upper(event_type) AS ticker FROM ev WHERE event_type IN ('click', 'purchase')", "ev")
def symbols_resolved(s, d):
    ev = fx.ev(s, d).select("event_id", F.lit("trades").alias("channel"), F.col("event_type").alias("symbol"))
    known = ev.where("symbol IN ('click', 'purchase')").select("channel", "symbol", F.upper("symbol").alias("ticker")).distinct()
    return joins.resolve_symbols(ev, known)[0].select("event_id", "ticker")


@query("SELECT event_id, CASE WHEN user_id < 50 THEN 'own-' || user_id END AS alias FROM ev", "ev")
def counterparties_aliased(s, d):
    ev = fx.ev(s, d).select("event_id", "user_id", F.col("user_id").cast("string").alias("counterparty"))
    ours = ev.where("user_id < 50").select(F.col("counterparty").alias("fingerprint"), F.concat(F.lit("own-"), "counterparty").alias("alias")).distinct()
    return joins.alias_counterparties(ev, ours).select("event_id", "alias")


@query("SELECT t.ticker, t.trade_id, round(t.size * coalesce(m.multiplier, 1), 6) AS shares FROM trades_one t ASOF LEFT JOIN (SELECT ticker, t, arg_max(1 + k / 100.0::DOUBLE, event_id) AS multiplier FROM (SELECT event_type AS ticker, * FROM ev WHERE event_id % 97 = 0) GROUP BY 1, 2) m ON t.ticker = m.ticker AND t.t >= m.t", "trades_one")
def underlying_shares(s, d):
    t = dedupe.dedupe_trades(fx.trades(s, d)).select("ticker", "t", "trade_id", F.col("size").alias("amount"))
    m = fx.ev(s, d).where("event_id % 97 = 0").selectExpr("event_type AS ticker", "t", "event_id", "1 + k / 100.0D AS multiplier")
    return r6(joins.underlying(t, m).select("ticker", "trade_id", "shares"), "shares")


@query("WITH e AS (SELECT event_type AS ticker, t FROM ev WHERE k % 50 = 0), a AS (SELECT DISTINCT event_type AS ticker, (t // 86400000000 + 1) * 86400000000 AS asof FROM ev) SELECT a.ticker, a.asof, round(sum(exp(-(a.asof - e.t) / 86400000000.0::DOUBLE)), 6) AS intensity FROM a JOIN e ON a.ticker = e.ticker AND e.t < a.asof AND e.t >= a.asof - 3 * 86400000000 GROUP BY 1, 2", "ev")
def event_intensity(s, d):
    ev = fx.ev(s, d).withColumn("ticker", F.col("event_type"))
    asofs = ev.select("ticker", ((F.floor(F.col("t") / D) + 1) * D).alias("asof")).distinct()
    return r6(aggs.decay_intensity(ev.where("k % 50 = 0").select("ticker", "t"), asofs, D, 3), "intensity")


@query("WITH f AS (SELECT ticker, (t // 3600000000) * 3600000000 AS bucket, sum(price * size) AS notional, arg_max(price, (t, trade_id)) AS last FROM trades_one GROUP BY 1, 2), r AS (SELECT *, abs(ln(last / lag(last) OVER (PARTITION BY ticker, bucket // 86400000000 ORDER BY bucket))) * 1e4 AS r FROM f) SELECT ticker, (bucket // 86400000000) * 86400000000 AS period, round(avg(r / (notional / 1e6)), 2) AS amihud FROM r WHERE r IS NOT NULL GROUP BY 1, 2", "trades_one")
def amihud_daily(s, d):
    return r6(aggs.amihud(aggs.trade_flow(dedupe.dedupe_trades(fx.trades(s, d)), H), D), "amihud", places=2)


@query(f"WITH c AS ({CANDLES}), f AS (SELECT * FROM c WHERE recv_micros < at_micros + 3599999000), e AS (SELECT DISTINCT ticker, at_micros FROM c WHERE recv_micros >= at_micros + 3599999000) SELECT ticker, at_micros, EXISTS (SELECT 1 FROM f WHERE f.ticker = e.ticker AND abs(f.recv_micros - (e.at_micros + 3600000000)) <= 3600000000) AS live FROM e", "ev")
def bars_heard_live(s, d):
    b = _kind(s, d, "candles").withColumn("width", F.lit(H))
    return windows.heard_live(b).select("ticker", "at_micros", "live").distinct()


@query(f"""
WITH c AS ({CANDLES}), e AS (SELECT *, EXISTS (SELECT 1 FROM c f WHERE f.ticker = c.ticker AND f.recv_micros < f.at_micros + 3599999000 AND abs(f.recv_micros - (c.at_micros + 3600000000)) <= 3600000000) AS live FROM c WHERE recv_micros >= at_micros + 3599999000),
o AS (SELECT ticker, at_micros AS t, arg_max(close, recv_micros) AS close, NOT bool_or(live) AS late FROM e GROUP BY 1, 2),
r AS (SELECT a.ticker, a.t, ln(a.close::DOUBLE / b.close::DOUBLE) AS r, a.late OR b.late AS late FROM o a JOIN o b ON a.ticker = b.ticker AND a.t = b.t + 3600000000),
g AS (SELECT ticker, count(*) AS n, avg(late::INT) AS share, max(t) + 3600000000 AS until FROM r GROUP BY 1),
p AS (SELECT a.ticker AS i, b.ticker AS j, count(*) AS n, avg((a.late OR b.late)::INT) AS share FROM r a JOIN r b ON a.t = b.t AND a.ticker < b.ticker GROUP BY 1, 2)
SELECT ticker AS ticker_i, NULL::VARCHAR AS ticker_j, CASE WHEN n >= 2 THEN round(share, 6) END AS value, n::DOUBLE AS n_eff, until AS asof_micros FROM g
UNION ALL SELECT a.ticker, b.ticker, CASE WHEN coalesce(p.n, 0) >= 2 THEN round(p.share, 6) END, coalesce(p.n, 0)::DOUBLE, greatest(a.until, b.until) FROM g a JOIN g b ON a.ticker < b.ticker LEFT JOIN p ON p.i = a.ticker AND p.j = b.ticker
""", "ev")
def backfilled_shares(s, d):
    """Of instruments and pairs, the share of hourly returns that touch a bar which was not heard live."""
    root = folder(s)  # the statistics read the returns several times: they are written once
    windows.live_returns(_kind(s, d, "candles").withColumn("width", F.lit(H)), H).write.parquet(root)
    rows = signals.derive(s.read.parquet(root), H, 2).where("measure = 'backfilled_share'")
    return r6(rows.select("ticker_i", "ticker_j", "value", "n_eff", "asof_micros"), "value")


@query("SELECT ticker, t FROM funding_fx QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY t DESC) <= 2", "funding_fx")
def newest_two(s, d):
    return windows.newest(fx.funding(s, d), ["ticker"], ["t"], 2).select("ticker", "t")


@query("WITH r AS (SELECT event_type AS ticker, user_id % 7 AS b, max(t) AS last, count(*) AS n FROM ev GROUP BY 1, 2) SELECT ticker, b, last, n FROM r", "ev")
def newest_by_key(s, d):
    ev = fx.ev(s, d).select(F.col("event_type").alias("ticker"), (F.col("user_id") % 7).alias("b"), "t", "event_id")
    n = ev.groupBy("ticker", "b").agg(F.count(F.lit(1)).alias("n"))
    return aggs.latest_by(ev, ["ticker", "b"], ["t", "event_id"]).select("ticker", "b", F.col("t").alias("last")).join(n, ["ticker", "b"])


# gaps, status and reorganisations

LOSSES = "l AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue, t AS lost, t + 600000000 AS until FROM ev WHERE event_id % 997 = 0)"


@query(f"WITH {LOSSES}, m AS (SELECT DISTINCT venue, ticker FROM trades_fx), g AS (SELECT l.venue, m.ticker, lost, until, (SELECT max(recv_micros) FROM trades_fx x WHERE x.venue = l.venue AND x.ticker = m.ticker AND x.recv_micros <= lost) AS c FROM l JOIN m USING (venue)), h AS (SELECT *, greatest(c, coalesce(max(until) OVER (PARTITION BY venue, ticker ORDER BY lost, until ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), c)) AS from_us FROM g WHERE c IS NOT NULL) SELECT venue, ticker, from_us, until AS to_us FROM h WHERE from_us < until", "trades_fx")
def coverage_gaps(s, d):
    losses = fx.ev(s, d).where("event_id % 997 = 0").selectExpr("CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue", "t AS from_us", "t + 600000000 AS to_us", "'restart' AS cause")
    return live.coverage_gaps(fx.trades(s, d).withColumn("series", F.lit("trades")), losses).select("venue", "ticker", "from_us", "to_us")


@query("SELECT venue, max(recv_micros) AS from_us, 1800000000000000 AS to_us, CASE venue WHEN 'a' THEN 'downtime' ELSE 'crash' END AS cause FROM trades_fx GROUP BY 1", "trades_fx")
def restart_gaps(s, d):
    t = fx.trades(s, d)
    marks = t.where("venue = 'a'").select("venue", F.lit(None).cast("long").alias("unflushed_us"), F.lit(True).alias("clean")).distinct()
    return live.restart_gaps(t, marks, 1_800_000_000_000_000)


_GAPS = f"WITH {LOSSES}, m AS (SELECT DISTINCT venue, ticker FROM trades_fx), g AS (SELECT l.venue, m.ticker, lost, until, (SELECT max(recv_micros) FROM trades_fx x WHERE x.venue = l.venue AND x.ticker = m.ticker AND x.recv_micros <= lost) AS c FROM l JOIN m USING (venue)), h AS (SELECT *, greatest(c, coalesce(max(until) OVER (PARTITION BY venue, ticker ORDER BY lost, until ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), c)) AS from_us FROM g WHERE c IS NOT NULL) SELECT venue, ticker, from_us, until AS to_us FROM h WHERE from_us < until"


@query(_GAPS, "trades_fx")
def gaps_streamed(s, d):
    """Messages and losses as one stream of shuffled files, with keyed state."""
    t = fx.trades(s, d).select("venue", "ticker", F.lit("trades").alias("series"), F.col("recv_micros").alias("at_us"), F.col("trade_id").alias("seq"), F.lit("message").alias("what"), F.lit(None).cast("long").alias("to_us"), F.lit(None).cast("string").alias("cause"))
    pairs = t.select("venue", "ticker", "series").distinct()
    lost = fx.ev(s, d).where("event_id % 997 = 0").selectExpr("CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS venue", "t AS at_us", "1000000000 + event_id AS seq", "'loss' AS what", "t + 600000000 AS to_us", "'restart' AS cause")
    end = pairs.select("*", F.lit(4_000_000_000_000_000).alias("at_us"), F.lit(0).cast("long").alias("seq"), F.lit("message").alias("what"), F.lit(None).cast("long").alias("to_us"), F.lit(None).cast("string").alias("cause"))
    rows = t.unionByName(ordered.controls(pairs, lost))
    return _run(s, live.stream_gaps(_streamed(s, rows, 6, end), "100 days")).select("venue", "ticker", "from_us", "to_us")


@query("SELECT venue, ticker, trade_id, price FROM trades_one", "trades_one")
def trades_once_streamed(s, d):
    t = fx.trades(s, d).withColumn("ts", F.timestamp_micros("recv_micros"))
    return _run(s, live.dedupe_stream(_streamed(s, t, 4), "100 days")).select("venue", "ticker", "trade_id", "price")


@query("SELECT 'stream' AS venue, event_type AS ticker, '1h' AS interval, (t // 3600000000) * 3600000000 AS at_micros, arg_max(mark, (t, event_id)) AS close FROM (SELECT event_type, t, event_id, 100 + value / 100 AS mark FROM ev) GROUP BY 2, 4", "ev")
def live_bars_streamed(s, d):
    e = fx.ev(s, d).select(F.lit("stream").alias("venue"), F.col("event_type").alias("ticker"), F.lit("1h").alias("interval"), (F.floor(F.col("t") / H) * H).alias("at_micros"), *[(100 + F.col("value") / 100).alias(c) for c in ("open", "high", "low", "close")], F.lit(False).alias("is_final"), F.struct("t", "event_id").alias("recv_micros"))
    return _run(s, live.live_bars(_streamed(s, e, 4), "100 days"), "complete").select("venue", "ticker", "interval", "at_micros", "close")


@query("WITH g AS (SELECT ticker, max(recv_micros) AS last, count(*) FILTER (recv_micros >= 1706400000000000) AS n FROM trades_fx GROUP BY 1) SELECT d.ticker, coalesce(n, 0) AS n, last, CASE WHEN last IS NULL THEN 'never heard' WHEN last >= 1706400000000000 THEN 'live' ELSE 'stale' END AS state FROM (SELECT DISTINCT event_type AS ticker FROM ev) d LEFT JOIN g USING (ticker)", "trades_fx")
def pair_status(s, d):
    declared = fx.ev(s, d).select(F.col("event_type").alias("ticker"), F.lit("trades").alias("series")).distinct()
    return live.pair_status(fx.trades(s, d).withColumn("series", F.lit("trades")), declared, 1_706_500_000_000_000, 100_000_000_000).select("ticker", "n", "last", "state")


_CHAIN = """
WITH RECURSIVE b AS (SELECT c_custkey AS seq, 'h' || c_custkey AS hash, c_custkey % 100 AS height, CASE WHEN c_custkey % 13 = 0 THEN 'other' ELSE 'h' || (c_custkey - 1) END AS parent FROM customer),
f AS (
  SELECT min(seq) - 1 AS seq, []::STRUCT(h BIGINT, x VARCHAR)[] AS trail, NULL::BIGINT AS from_block, NULL::BIGINT AS to_block, NULL::VARCHAR AS old_hash, NULL::VARCHAR AS new_hash FROM b
  UNION ALL
  SELECT seq, list_filter(t, lambda e: e.h >= list_max(list_transform(t, lambda g: g.h)) - 64), CASE WHEN broke THEN height - 1 END, CASE WHEN broke THEN greatest(tip, height - 1) END, CASE WHEN broke THEN held END, CASE WHEN broke THEN parent END
  FROM (SELECT *, CASE WHEN broke THEN list_filter(trail, lambda e: e.h < height - 1) ELSE list_filter(trail, lambda e: e.h <> height) END || [{'h': height, 'x': hash}] AS t
        FROM (SELECT *, held IS NOT NULL AND lower(held) <> lower(parent) AS broke
              FROM (SELECT b.*, f.trail, list_filter(f.trail, lambda e: e.h = b.height - 1)[1].x AS held, list_max(list_transform(f.trail, lambda e: e.h)) AS tip FROM f JOIN b ON b.seq = f.seq + 1))))
SELECT seq, from_block, to_block, old_hash, new_hash FROM f WHERE from_block IS NOT NULL
"""


def _heights(s, d):
    return fx.table(s, d, "customer").selectExpr("'v' AS venue", "c_custkey AS seq", "concat('h', c_custkey) AS hash", "c_custkey % 100 AS height", "CASE WHEN c_custkey % 13 = 0 THEN 'other' ELSE concat('h', c_custkey - 1) END AS parent")


@query(_CHAIN)
def reorgs_detected(s, d):
    return live.detect_reorgs(_heights(s, d)).drop("venue")


def _streamed(s, rows, files: int, last=None):
    """The rows as a stream of several files, whose order is not theirs; ``last``: rows of the newest file, which move the watermark past all others."""
    at = folder(s)
    rows.repartition(files).write.parquet(at)
    if last is not None:
        last.select(*rows.columns).coalesce(1).write.mode("append").parquet(at)
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(at)


def _delivered(s, rows, slice_us: int, last):
    """The rows as a stream in order of ``at_us`` but for two slices of time: a row comes with its own slice or the one before.

    However long the rows reach, one comes less than ``2 * slice_us`` after later ones.  ``last`` as in :func:`_streamed`.
    """
    dealt, at, names = folder(s), folder(s), rows.columns
    early = F.pmod(F.xxhash64("at_us", "seq"), F.lit(2))
    rows.withColumn("slice", F.floor(F.col("at_us") / slice_us) - early).repartition("slice").write.partitionBy("slice").parquet(dealt)
    kept = s.read.schema(rows.withColumn("slice", F.lit(0).cast("long")).schema).parquet(dealt)
    for (k,) in sorted(kept.select("slice").distinct().collect()):
        kept.where(F.col("slice") == k).select(*names).orderBy(F.xxhash64("seq")).coalesce(1).write.mode("append").parquet(at)
    last.select(*names).coalesce(1).write.mode("append").parquet(at)
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(at)


def _run(s, stream, mode: str = "append"):
    """What a stream over all its files writes, read back from the shared folder."""
    out, kept = folder(s), folder(s)
    if mode == "append":
        q = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", kept).trigger(availableNow=True).start(out)
    else:
        q = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", kept).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.schema(stream.schema).parquet(out)


@query(_CHAIN)
def reorgs_streamed(s, d):
    """The chain out of order within a day, however long it is, with keyed state."""
    c = _heights(s, d).withColumn("at_us", F.col("seq") * 1_000_000)
    end = c.groupBy("venue").agg(F.lit(-1).cast("long").alias("seq"), F.lit("end").alias("hash"), F.lit(-10).cast("long").alias("height"), F.lit("").alias("parent"), (F.max("at_us") + 10 * D).alias("at_us"))
    return _run(s, live.stream_reorgs(_delivered(s, c, 12 * H, end), delay="1 day")).drop("venue")


@query("WITH n AS (SELECT user_id % 30 AS alias, arg_max(k, (t, event_id)) AS newest FROM ev GROUP BY 1) SELECT alias, newest FROM n WHERE newest <> 50", "ev")
def changed_fingerprints(s, d):
    e = fx.ev(s, d).select((F.col("user_id") % 30).alias("alias"), F.col("k").alias("fingerprint"), F.struct("t", "event_id").alias("t"))
    return quality.changed_fingerprints(e, e.select("alias", F.lit(50).cast("long").alias("fingerprint")).distinct()).select("alias", "newest")


# ledger

_BAD = "b AS (SELECT account, ticker, min((t, order_id, trade_id)) AS p FROM fills_fx WHERE size = 7 GROUP BY 1, 2)"


def _poisoned_fills(s, d):
    return fx.fills(s, d).withColumn("price", F.when(F.col("size") == 7, 0.0).otherwise(F.col("price")))


@query(f"WITH {_BAD} SELECT f.account, f.ticker, (SELECT min(t) FROM fills_fx x WHERE x.size = 7 AND x.account = f.account AND x.ticker = f.ticker) AS since, count(*) FILTER ((t, order_id, trade_id) > p) AS not_applied FROM fills_fx f JOIN b ON b.account = f.account AND b.ticker = f.ticker GROUP BY 1, 2", "fills_fx")
def poisoned_books(s, d):
    return ledger.poisoned(_poisoned_fills(s, d))


@query(f"WITH {_BAD} SELECT order_id, trade_id, CASE WHEN p IS NULL OR (t, order_id, trade_id) < p THEN round(sum(CASE WHEN side = 'bid' THEN size ELSE -size END) OVER (PARTITION BY f.account, f.ticker ORDER BY t, order_id, trade_id ROWS UNBOUNDED PRECEDING), 6) END AS position FROM fills_fx f LEFT JOIN b ON b.account = f.account AND b.ticker = f.ticker", "fills_fx")
def sound_positions(s, d):
    return r6(ledger.sound_positions(_poisoned_fills(s, d).drop("start_position")).select("order_id", "trade_id", "position"), "position")


@query("WITH a AS (SELECT account, CASE WHEN count(*) FILTER (order_id % 5000 = 0) = 0 THEN round(sum(size), 6) END AS fees FROM fills_fx WHERE account % 7 <> 0 GROUP BY 1), p AS (SELECT account, round(sum(size) * 2, 6) AS funding FROM fills_fx WHERE account % 5 <> 0 GROUP BY 1) SELECT account, fees, funding FROM a FULL JOIN p USING (account)", "fills_fx")
def fees_and_funding(s, d):
    f = fx.fills(s, d).withColumn("fee", F.when(F.col("order_id") % 5000 != 0, F.col("size"))).withColumn("usdc", F.col("size") * 2)
    return r6(ledger.fees_and_funding(f.where("account % 7 <> 0"), f.where("account % 5 <> 0")), "fees", "funding")


@query("WITH f AS (SELECT account, min(t) AS first_fill, max(t) AS newest_fill FROM fills_fx WHERE account % 7 <> 0 GROUP BY 1), p AS (SELECT account, min(t) AS first_funding FROM fills_fx WHERE account % 5 <> 0 AND trade_id = 2 GROUP BY 1) SELECT account, first_fill, newest_fill, first_funding, CASE WHEN first_fill IS NULL OR first_funding < first_fill THEN 'lost' ELSE 'consistent' END AS reach FROM f FULL JOIN p USING (account)", "fills_fx")
def history_reach(s, d):
    f = fx.fills(s, d)
    return ledger.history_reach(f.where("account % 7 <> 0"), f.where("account % 5 <> 0 AND trade_id = 2"))


@query("WITH g AS (SELECT account, order_id % 10 AS page, count(*) AS n, min(t) AS first FROM fills_fx GROUP BY 1, 2), h AS (SELECT account, quantile_disc(t, 0.01) AS newest FROM fills_fx GROUP BY 1) SELECT account, page, first, newest FROM g JOIN h USING (account) WHERE n >= 100 AND first > newest", "fills_fx")
def pages_beyond_reach(s, d):
    f = fx.fills(s, d)
    held = f.groupBy("account").agg(F.expr("percentile_disc(0.01) WITHIN GROUP (ORDER BY t)").alias("newest"))
    return ledger.beyond_reach(f.withColumn("page", F.col("order_id") % 10), held, 100)


SNAPS = "s AS (SELECT account, ticker, t, 0.0 AS stated FROM fills_fx WHERE order_id % 50 = 0 AND trade_id = 1)"


@query(f"WITH p AS (SELECT *, sum(CASE WHEN side = 'bid' THEN size ELSE -size END) OVER (PARTITION BY account, ticker ORDER BY t, order_id, trade_id ROWS UNBOUNDED PRECEDING) AS position FROM fills_fx), {SNAPS} SELECT s.account, s.ticker, s.t, x.position, abs(x.position) <= 1e-9 AS agrees, count(*) AS n FROM s ASOF LEFT JOIN (SELECT account, ticker, t, arg_max(position, (order_id, trade_id)) AS position FROM p GROUP BY 1, 2, 3) x ON s.account = x.account AND s.ticker = x.ticker AND s.t >= x.t GROUP BY 1, 2, 3, 4, 5", "fills_fx")
def snapshot_checks(s, d):
    f = fx.fills(s, d).drop("start_position")
    snaps = f.where("order_id % 50 = 0 AND trade_id = 1").select("account", "ticker", "t", F.lit(0.0).alias("stated"))
    out = ledger.snapshot_checks(ledger.positions(f), snaps, 1e-9)
    return out.groupBy("account", "ticker", "t", "position", "agrees").agg(F.count(F.lit(1)).alias("n"))


# scalars

@query("SELECT event_id, strftime(make_timestamp(t - 1800000000000000), '%Y-%m-%d') AS day, (k + 1) * 60000000 AS width, CASE WHEN k % 2 = 0 THEN (user_id || '.' || k)::DOUBLE END AS exact, user_id * 16 + 5 AS word, k % 3 = 0 AS token FROM ev", "ev")
def scalar_helpers(s, d):
    k = F.col("k").cast("string")
    number = F.when(F.col("k") % 2 == 0, _px()).otherwise(F.concat(_px(), F.lit("0" * 17 + "1")))
    token = F.when(F.col("k") % 3 == 0, F.lit("a.b-C_1")).when(F.col("k") % 3 == 1, F.lit("a b")).otherwise(F.lit("x" * 65))
    return fx.ev(s, d).select("event_id", S.date_of(F.col("t") - 1_800_000_000_000_000).cast("string").alias("day"), S.width_micros(F.concat((F.col("k") + 1).cast("string"), F.lit("m"))).alias("width"), S.exact_decimal(F.when(F.col("k") % 2 == 0, number).otherwise(F.concat(number, F.lit("0"), k))).cast("double").alias("exact"), S.hex_word(F.concat(F.lit("0x00"), F.hex("user_id"), F.lit("5"))).cast("long").alias("word"), S.valid_token(token).alias("token"))


# ledger updates, coverage of fetched pages, frontier, session shares, backfill

UPDATE_KINDS = ("deposit", "withdraw", "accountClassTransfer", "internalTransfer", "send", "spotTransfer", "vaultWithdraw", "liquidation", "mystery", "subAccountTransfer")


@query("""
WITH u AS (SELECT *, order_id % 10 AS c, trade_id % 2 = 0 AS even FROM fills_fx),
e AS (SELECT *, CASE c WHEN 0 THEN size WHEN 1 THEN -size WHEN 2 THEN CASE WHEN even THEN size ELSE -size END WHEN 3 THEN CASE WHEN even THEN -size ELSE size END
  WHEN 4 THEN CASE WHEN even THEN -size ELSE size END WHEN 5 THEN 0 WHEN 6 THEN size + 1 WHEN 9 THEN CASE WHEN even THEN -size ELSE size END END AS effect FROM u)
SELECT order_id * 10 + trade_id AS seq, ['deposit', 'withdraw', 'accountClassTransfer', 'internalTransfer', 'send', 'spotTransfer', 'vaultWithdraw', 'liquidation', 'mystery', 'subAccountTransfer'][c + 1] AS kind, effect::DOUBLE AS effect,
  CASE WHEN c = 4 THEN CASE WHEN even THEN 'd1' ELSE '' END WHEN c IN (5, 7, 8) THEN NULL ELSE '' END AS dex, c IN (3, 4, 5, 6, 7, 9) AS has_other, t AS at_micros FROM e
""", "fills_fx")
def ledger_updates(s, d):
    c, even, size = F.col("order_id") % 10, F.col("trade_id") % 2 == 0, F.col("size").cast("string")
    kind, me, you = F.array(*[F.lit(k) for k in UPDATE_KINDS])[c.cast("int")], F.lit("0xAB "), F.lit("0xcd")
    delta = F.struct(
        kind.alias("type"), F.when(c != 4, size).alias("usdc"), F.when(c == 4, size).alias("amount"), F.when(c == 4, "USDC").alias("token"), F.when(c == 2, even).alias("toPerp"),
        F.when(c.isin(3, 4, 5, 9), F.when(even, me).otherwise(you)).alias("user"), F.when(c.isin(3, 4, 5, 9), F.when(even, you).otherwise(me)).alias("destination"),
        F.when(c == 4, "d1").alias("sourceDex"), F.when(c == 4, "").alias("destinationDex"), F.when(c.isin(6, 7), "0xee").alias("vault"), (F.col("size") + 1).cast("string").alias("netWithdrawnUsd"),
    )
    page = _page(s, d, F.to_json(F.array(F.struct(F.floor(F.col("t") / 1000).alias("time"), delta.alias("delta")))), "userNonFundingLedgerUpdates")
    rows = normalise.ledger_updates(page, "k", S.pseudonym("k", F.lit("0xab")))[0]
    total = F.when(F.size("effects") > 0, F.col("effects")[0]["usdc"]).when(F.size("effects") == 0, F.lit(0))
    dex = F.when(F.size("effects") > 0, F.col("effects")[0]["dex"])
    return rows.select("seq", "kind", total.cast("double").alias("effect"), dex.alias("dex"), F.col("counterparty").isNotNull().alias("has_other"), "at_micros")


@query("SELECT coalesce(CASE WHEN k % 9 <> 0 THEN event_type END, '<none>') AS symbol, count(*) AS pages, (2 * count(*) FILTER (k % 4 <> 0))::BIGINT AS n_rows, min(CASE WHEN k % 4 <> 0 THEN t // 1000 * 1000 END) AS first_micros, max(CASE WHEN k % 4 <> 0 THEN t // 1000 * 1000 + 60000000 END) AS last_micros FROM ev WHERE k % 3 = 0 GROUP BY 1", "ev")
def fetched_coverage(s, d):
    k, ms = F.col("k"), F.floor(F.col("t") / 1000)
    page = F.when(k % 4 != 0, F.to_json(F.array(F.struct(ms.alias("t")), F.struct((ms + 60_000).alias("t"))))).when(k % 8 == 0, "[]").otherwise("{broken")
    rows = fx.ev(s, d).select(F.when(k % 3 == 0, "fetched").otherwise("stream").alias("origin"), F.when(k % 9 != 0, F.col("event_type")).alias("symbol"), page.alias("payload"))
    return normalise.fetched_coverage(rows)


@query("SELECT min(e) AS frontier_us FROM (SELECT event_type, max(t) AS e FROM ev WHERE event_type IN (SELECT DISTINCT event_type FROM ev ORDER BY 1 LIMIT 3) GROUP BY 1)", "ev")
def tape_frontier(s, d):
    e = fx.ev(s, d).select(F.col("event_type").alias("kind"), S.date_of(F.col("t")).alias("date"), F.col("t").alias("recv_micros"))
    kinds = [r["kind"] for r in e.select("kind").distinct().orderBy("kind").limit(3).collect()]
    return filters.frontier(e, kinds)


@query("""
WITH i AS (SELECT event_id, t AS a, t + k * 1800000000 AS b FROM ev),
m AS (SELECT event_id, (make_timestamp(x) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ts FROM i, unnest(range(a, b, 60000000)) AS u(x)),
f AS (SELECT event_id, avg(CASE WHEN CASE dayofweek(ts) WHEN 6 THEN false WHEN 0 THEN hour(ts) >= 18 WHEN 5 THEN hour(ts) < 17 ELSE hour(ts) <> 17 END THEN 1.0 ELSE 0.0 END) AS share FROM m GROUP BY 1)
SELECT i.event_id, round(share, 6) AS external_share FROM i LEFT JOIN f USING (event_id)
""", "ev")
def external_shares(s, d):
    i = fx.ev(s, d).select("event_id", F.col("t").alias("start_us"), (F.col("t") + F.col("k") * 1_800_000_000).alias("end_us"))
    return r6(filters.external_shares(i).select("event_id", "external_share"), "external_share")


@query("""
WITH g AS (SELECT event_type AS ticker, CASE WHEN k % 2 = 0 THEN 'trades' ELSE 'candles' END AS series, CASE WHEN k % 2 = 1 THEN 86400000000 END AS width, t AS a, t + k * 1000000 AS b FROM ev WHERE k % 10 < 3),
l AS (SELECT ticker, max(t) AS a FROM candles_fx GROUP BY 1)
SELECT ticker, series, width, min(a) AS from_us, max(b) AS to_us FROM (
  SELECT ticker, series, width, a - coalesce(width, 60000000) AS a, b FROM g
  UNION ALL SELECT ticker, 'candles', 86400000000, a, 1800000000000000 FROM l WHERE a + 172800000000 <= 1800000000000000) GROUP BY 1, 2, 3
""", "ev", "candles_fx")
def backfill_worklist(s, d):
    k = F.col("k")
    gaps = fx.ev(s, d).where(k % 10 < 3).select(F.col("event_type").alias("ticker"), F.when(k % 2 == 0, "trades").otherwise("candles").alias("series"), F.when(k % 2 == 1, F.lit(D)).alias("width"), F.col("t").alias("from_us"), (F.col("t") + k * 1_000_000).alias("to_us"))
    c = fx.candles(s, d).select("ticker", F.lit(D).alias("width"), F.col("t").alias("at_micros"), F.lit(True).alias("is_final"))
    return aggs.backfill_worklist(gaps, c, 1_800_000_000_000_000)
