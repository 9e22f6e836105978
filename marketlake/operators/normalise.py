"""Payloads of the record to typed rows of the tape, as JSON projections.

Numbers arrive as strings and become decimal(38,18) exactly; a row that does not parse goes to the
dead letters (``split_failures``), never to zero.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalars import address_of, exact_decimal, hex_word, millis_to_micros, pseudonym, shifted_decimal

ENVELOPE = ("seq", "recv_micros", "venue", "channel", "symbol", "origin")
TRADES = "array<struct<coin:string,side:string,px:string,sz:string,time:bigint,tid:bigint>>"
BBO = "struct<coin:string,time:bigint,bbo:array<struct<px:string,sz:string>>>"
CANDLE = "map<string,string>"  # its fields t and T differ by case alone
FUNDING = "array<struct<coin:string,fundingRate:string,premium:string,time:bigint>>"
CONTEXT = "struct<coin:string,ctx:struct<markPx:string,oraclePx:string,midPx:string,funding:string,openInterest:string,premium:string>>"
BOOK = "struct<coin:string,time:bigint,levels:array<array<struct<px:string,sz:string,n:int>>>>"
LOGS = "array<struct<address:string,topics:array<string>,data:string,blockNumber:string,transactionHash:string,logIndex:string>>"
QUOTES = "struct<results:array<struct<symbol:string,bid_inclusive_of_sell_spread:string,sell_spread:string,ask_inclusive_of_buy_spread:string,buy_spread:string,quantity:string,timestamp:string>>>"
FILLS = "array<struct<coin:string,side:string,px:string,sz:string,time:bigint,startPosition:string,closedPnl:string,fee:string,oid:bigint,tid:bigint>>"
PAYMENTS = "array<struct<time:bigint,hash:string,delta:struct<coin:string,usdc:string,szi:string,fundingRate:string,nSamples:int>>>"
UPDATES = "array<struct<time:bigint,delta:struct<type:string,usdc:string,fee:string,toPerp:string,user:string,destination:string,token:string,amount:string,sourceDex:string,destinationDex:string,vault:string,netWithdrawnUsd:string>>>"
#: Topic of the standard token transfer event, and the zero address (fixed values).
TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
ZERO = "0x" + "0" * 40


def parse(df: DataFrame, schema: str) -> DataFrame:
    """``data``: the payload as ``schema``; null where it isn't that."""
    return df.withColumn("data", F.from_json(F.col("payload").cast("string"), schema, {"mode": "PERMISSIVE"}))


def split_failures(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that hold, dead letters: channel, sequence and error without the payload)."""
    good = F.coalesce(ok, F.lit(False))
    bad = df.where(~good).select("venue", "channel", "recv_micros", F.col("seq").alias("archive_seq"), F.lit("the payload does not parse").alias("error"))
    return df.where(good), bad


def _side(s: Column) -> Column:
    return F.when(s == "B", "bid").when(s == "A", "ask")


def trades(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = parse(df, TRADES).select(*ENVELOPE, F.explode_outer("data").alias("x"))
    rows = rows.select(*ENVELOPE, F.col("x.coin").alias("ticker"), millis_to_micros(F.col("x.time")).alias("at_micros"), exact_decimal(F.col("x.px")).alias("price"), exact_decimal(F.col("x.sz")).alias("size"), _side(F.col("x.side")).alias("aggressor"), F.col("x.tid").alias("trade_id"))
    return split_failures(rows, F.col("price").isNotNull() & F.col("size").isNotNull() & F.col("aggressor").isNotNull())


def quotes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An absent side is null, not zero."""
    x, side = F.col("data"), lambda i, f: exact_decimal(F.get(F.col("data.bbo"), F.lit(i))[f])
    rows = parse(df, BBO).select(*ENVELOPE, x["coin"].alias("ticker"), millis_to_micros(x["time"]).alias("at_micros"), side(0, "px").alias("bid_px"), side(0, "sz").alias("bid_sz"), side(1, "px").alias("ask_px"), side(1, "sz").alias("ask_sz"))
    return split_failures(rows, F.col("ticker").isNotNull())


def candles(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One candle or a snapshot of many; final when heard at or after its close."""
    one, many = F.from_json(F.col("payload").cast("string"), CANDLE), F.from_json(F.col("payload").cast("string"), f"array<{CANDLE}>")
    rows = df.withColumn("x", F.explode_outer(F.when(F.col("payload").cast("string").rlike(r"^\s*\["), many).otherwise(F.array(one))))
    price = {n: exact_decimal(F.col("x")[c]) for n, c in (("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"), ("volume", "v"))}
    rows = rows.select(*ENVELOPE, F.col("x")["s"].alias("ticker"), F.col("x")["i"].alias("interval"), millis_to_micros(F.col("x")["t"].try_cast("long")).alias("at_micros"), *[v.alias(k) for k, v in price.items()], (F.col("recv_micros") >= millis_to_micros(F.col("x")["T"].try_cast("long"))).alias("is_final"))
    return split_failures(rows, F.col("close").isNotNull() & F.col("at_micros").isNotNull())


def funding(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = parse(df, FUNDING).select(*ENVELOPE, F.explode_outer("data").alias("x"))
    rows = rows.select(*ENVELOPE, F.col("x.coin").alias("ticker"), millis_to_micros(F.col("x.time")).alias("at_micros"), exact_decimal(F.col("x.fundingRate")).alias("rate"), F.lit(True).alias("settled"))
    return split_failures(rows, F.col("rate").isNotNull())


def contexts(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(marks with any figure, live funding with a rate, failures); neither has a venue time."""
    rows, bad = split_failures(parse(df, CONTEXT), F.col("data.coin").isNotNull())
    c, at = F.col("data.ctx"), F.lit(None).cast("long").alias("at_micros")
    marks = rows.select(*ENVELOPE, F.col("data.coin").alias("ticker"), at, exact_decimal(c["markPx"]).alias("mark"), exact_decimal(c["oraclePx"]).alias("oracle"), exact_decimal(c["premium"]).alias("premium"), exact_decimal(c["openInterest"]).alias("open_interest"))
    live = rows.select(*ENVELOPE, F.col("data.coin").alias("ticker"), at, exact_decimal(c["funding"]).alias("rate"), F.lit(False).alias("settled")).where("rate IS NOT NULL")
    return marks.where("coalesce(mark, oracle, premium, open_interest) IS NOT NULL"), live, bad


def book(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each level of each side; a size of 0 removes the level."""
    rows, bad = split_failures(parse(df, BOOK), F.col("data.coin").isNotNull())
    side = rows.select(*ENVELOPE, F.col("data.coin").alias("ticker"), millis_to_micros(F.col("data.time")).alias("at_micros"), F.posexplode("data.levels").alias("_s", "_levels"))
    level = side.select("*", F.posexplode("_levels").alias("level", "_l"))
    return level.select(*ENVELOPE, "ticker", "at_micros", F.when(F.col("_s") == 0, "bid").otherwise("ask").alias("side"), "level", exact_decimal(F.col("_l.px")).alias("price"), exact_decimal(F.col("_l.sz")).alias("size")), bad


def polled_quotes(df: DataFrame, symbols: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spread-inclusive quotes of a poll; unknown symbols are skipped (symbols: symbol, ticker)."""
    rows, bad = split_failures(parse(df, QUOTES), F.col("data.results").isNotNull())
    rows = rows.select(*[c for c in ENVELOPE if c != "symbol"], F.explode("data.results").alias("x")).withColumn("symbol", F.col("x.symbol")).join(symbols.select("symbol", "ticker"), "symbol")
    q = exact_decimal(F.col("x.quantity"))
    return rows.select("seq", "recv_micros", "venue", "ticker", F.unix_micros(F.try_to_timestamp(F.col("x.timestamp"))).alias("at_micros"), exact_decimal(F.col("x.bid_inclusive_of_sell_spread")).alias("bid_px"), exact_decimal(F.col("x.ask_inclusive_of_buy_spread")).alias("ask_px"), q.alias("bid_sz"), q.alias("ask_sz"), exact_decimal(F.col("x.sell_spread")).alias("sell_spread"), exact_decimal(F.col("x.buy_spread")).alias("buy_spread")), bad


def chain_logs(df: DataFrame, contracts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(transfers, mints, failures) of a page of logs: the transfer topic with exactly three topics, contracts (address, ticker, decimals) known.

    Amounts are decimal(38,18), exactly; one that doesn't fit is a dead letter.
    """
    rows, bad = split_failures(parse(df, LOGS), F.col("data").isNotNull())
    x = rows.select("seq", "recv_micros", "venue", F.explode("data").alias("x")).where((F.col("x.topics")[0] == TRANSFER) & (F.size("x.topics") == 3))
    x = x.withColumn("address", F.lower("x.address")).join(contracts.select(F.lower("address").alias("address"), "ticker", "decimals"), "address")
    x = x.withColumn("amount", shifted_decimal(hex_word(F.col("x.data")), F.col("decimals").cast("int")))
    x, unfit = split_failures(x.withColumn("channel", F.lit("logs")), F.col("amount").isNotNull())
    x = x.select("seq", "recv_micros", "venue", "ticker", hex_word(F.col("x.blockNumber")).cast("long").alias("block"), F.col("x.transactionHash").alias("tx_hash"), hex_word(F.col("x.logIndex")).cast("long").alias("log_index"), address_of(F.col("x.topics")[1]).alias("from_address"), address_of(F.col("x.topics")[2]).alias("to_address"), "amount")
    zero = (F.col("from_address") == ZERO) | (F.col("to_address") == ZERO)
    mints = x.where(zero).withColumn("kind", F.when(F.col("from_address") == ZERO, "issue").otherwise("redemption"))
    return x.where(~zero), mints, bad.unionByName(unfit)


def account_fills(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fills of an account page, ``dex:ticker`` split."""
    rows = parse(df, FILLS).select(*ENVELOPE, F.explode_outer("data").alias("x"))
    coin = F.split("x.coin", ":")
    num = {n: exact_decimal(F.col(f"x.{c}")) for n, c in (("price", "px"), ("size", "sz"), ("start_position", "startPosition"), ("closed_pnl", "closedPnl"), ("fee", "fee"))}
    rows = rows.select(*ENVELOPE, F.when(F.size(coin) == 2, coin[0]).otherwise("").alias("dex"), F.element_at(coin, -1).alias("ticker"), _side(F.col("x.side")).alias("side"), *[v.alias(k) for k, v in num.items()], F.col("x.oid").alias("order_id"), F.col("x.tid").alias("trade_id"), millis_to_micros(F.col("x.time")).alias("at_micros"))
    return split_failures(rows, F.col("price").isNotNull() & F.col("size").isNotNull() & F.col("side").isNotNull())


def ledger_updates(df: DataFrame, key: str, own: Column) -> tuple[DataFrame, DataFrame]:
    """Updates of an account's ledger page: ``effects``, an array of (dex, usdc) on perp margin, and ``counterparty``.

    ``own`` is the account's pseudonym under ``key``; dex '' is the main one.  ``effects`` is null where the update
    doesn't say what it did to margin (unknown types too), and empty where nothing in margin moved.  A row with a number
    that does not parse is a dead letter.
    """
    rows = parse(df, UPDATES).select(*ENVELOPE, own.alias("own"), F.explode_outer("data").alias("x")).select("*", "x.delta.*", F.col("x.time").alias("time")).drop("x")
    texts = ("usdc", "fee", "amount", "netWithdrawnUsd")
    n = {c: exact_decimal(F.col(c)) for c in texts}
    parsed = F.col("time").isNotNull()
    for c in texts:
        parsed = parsed & (F.col(c).isNull() | n[c].isNotNull())
    kind, usdc = F.col("type"), n["usdc"]
    sent = F.coalesce(pseudonym(key, F.col("user")) == F.col("own"), F.lit(False))
    received = F.coalesce(pseudonym(key, F.col("destination")) == F.col("own"), F.lit(False))
    between, nothing = kind.isin("internalTransfer", "subAccountTransfer"), kind.isin("spotTransfer", "spotGenesis", "cStakingTransfer", "borrowLend", "rewardsClaim")
    moved = (
        F.when((kind == "deposit") | ((kind == "accountClassTransfer") & (F.col("toPerp") == "true")) | (between & ~sent), usdc)
        .when(kind.isin("withdraw", "vaultDeposit", "vaultCreate") | ((kind == "accountClassTransfer") & (F.col("toPerp") == "false")) | (between & sent), -usdc)
        .when(kind == "vaultWithdraw", n["netWithdrawnUsd"])
    )
    one = lambda dex, v: F.struct(dex.alias("dex"), v.cast("decimal(38,18)").alias("usdc"))
    leg = lambda mine, dex, v: F.when(mine & (F.col("token") == "USDC") & v.isNotNull() & (F.coalesce(dex, F.lit("")) != "spot"), one(F.coalesce(dex, F.lit("")), v))
    legs = F.array_compact(F.array(leg(sent, F.col("sourceDex"), -n["amount"]), leg(received, F.col("destinationDex"), n["amount"])))
    none = F.array().cast("array<struct<dex:string,usdc:decimal(38,18)>>")
    effects = F.when(kind == "send", legs).when(nothing, none).when(moved.isNotNull(), F.array(one(F.lit(""), moved)))
    other = (
        F.when((kind == "send") & sent & received, None)
        .when((between & usdc.isNotNull()) | kind.isin("send", "spotTransfer"), pseudonym(key, F.when(sent, F.col("destination")).otherwise(F.col("user"))))
        .when(kind.isin("vaultDeposit", "vaultCreate", "vaultWithdraw", "liquidation", "vaultDistribution", "activateDexAbstraction"), pseudonym(key, F.col("vault")))
    )
    token = F.when(nothing | ((kind == "send") & (F.col("token") != "USDC")), F.col("token"))
    amount = F.when(nothing | (kind == "send"), n["amount"])
    rows = rows.withColumn("_ok", parsed)
    good, bad = split_failures(rows, F.col("_ok"))
    return good.select(*ENVELOPE, F.coalesce(kind, F.lit("")).alias("kind"), effects.alias("effects"), other.alias("counterparty"), token.alias("token"), amount.alias("amount"), n["fee"].alias("fee"), millis_to_micros(F.col("time")).alias("at_micros")), bad


def account_funding(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payments of an account's funding page; the venue's sign stays (negative: paid), ``samples`` may be null."""
    rows = parse(df, PAYMENTS).select(*ENVELOPE, F.explode_outer("data").alias("x"))
    coin = F.split("x.delta.coin", ":")
    num = {n: exact_decimal(F.col(f"x.delta.{c}")) for n, c in (("usdc", "usdc"), ("size", "szi"), ("rate", "fundingRate"))}
    rows = rows.select(*ENVELOPE, F.when(F.size(coin) == 2, coin[0]).otherwise("").alias("dex"), F.element_at(coin, -1).alias("ticker"), *[v.alias(k) for k, v in num.items()], F.col("x.delta.nSamples").alias("samples"), millis_to_micros(F.col("x.time")).alias("at_micros"))
    return split_failures(rows, F.col("usdc").isNotNull() & F.col("size").isNotNull() & F.col("rate").isNotNull() & F.col("ticker").isNotNull())


def generated(df: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Events the capture wrote itself are decoded by origin, whatever the venue."""
    rows, bad = split_failures(parse(df.where("origin = 'generated'"), schema), F.col("data").isNotNull())
    return rows.select(*ENVELOPE, "data.*"), bad


def drop_control(df: DataFrame, control: tuple[str, ...] = ("pong", "subscriptionResponse")) -> DataFrame:
    return df.where(~F.col("channel").isin(*control))


def encode_envelopes(df: DataFrame) -> DataFrame:
    """(topic, value): JSON with numbers as text; topic markets.<venue>.<ticker>.<kind>."""
    text = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return df.select(F.concat_ws(".", F.lit("markets"), "venue", "ticker", "kind").alias("topic"), F.to_json(text).alias("value"))


def decode_envelopes(df: DataFrame, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    x = df.withColumn("x", F.from_json("value", ", ".join(f"{c} string" for c in columns)))
    good = F.col("x").isNotNull() & F.coalesce(*[F.col(f"x.{c}") for c in columns]).isNotNull()
    return x.where(good).select(*[F.expr(f"try_cast(x.{c} AS {t})").alias(c) for c, t in columns.items()]), x.where(~good).select("value", F.lit("undecodable").alias("error"))


_VENUES: dict[str, Callable[[DataFrame], dict[str, DataFrame]]] = {}


def register_venue(name: str, fn: Callable[[DataFrame], dict[str, DataFrame]]) -> None:
    """A venue is a function of its record rows to kinds of the tape: no clock, no reads, no writes."""
    _VENUES[name] = fn


def normalise(record: DataFrame, venue: str) -> dict[str, DataFrame]:
    if venue not in _VENUES:
        raise KeyError(f"no venue {venue!r} is registered")
    return _VENUES[venue](drop_control(record.where(F.col("venue") == venue)))


def _streamed_venue(df: DataFrame) -> dict[str, DataFrame]:
    """Channels trades, bbo, candle, fundingHistory, activeAssetCtx and l2Book; anything else fails."""
    of = lambda *c: df.where(F.col("channel").isin(*c))
    out, bad = {}, []
    for kind, fn, channels in (("trades", trades, ("trades",)), ("quotes", quotes, ("bbo",)), ("candles", candles, ("candle", "candleSnapshot")), ("funding", funding, ("fundingHistory",)), ("book", book, ("l2Book",))):
        out[kind], failed = fn(of(*channels))
        bad.append(failed)
    out["marks"], live, failed = contexts(of("activeAssetCtx"))
    out["funding"] = out["funding"].unionByName(live)
    known = ("trades", "bbo", "candle", "candleSnapshot", "fundingHistory", "l2Book", "activeAssetCtx")
    other = df.where(~F.col("channel").isin(*known)).select("venue", "channel", "recv_micros", F.col("seq").alias("archive_seq"), F.lit("unknown channel").alias("error"))
    for b in [*bad, failed]:
        other = other.unionByName(b)
    return out | {"unparsed": other}


register_venue("stream", _streamed_venue)


def fetched_coverage(record: DataFrame) -> DataFrame:
    """What fetched pages cover for each symbol: pages, rows, first and last venue time (null where no page has rows).

    A page is an array of objects with a time in ``t`` or ``time`` (milliseconds); other payloads are pages without rows.
    """
    at = F.transform(F.from_json(F.col("payload").cast("string"), "array<map<string,string>>"), lambda x: F.coalesce(x["t"], x["time"]).cast("long"))
    rows = record.where("origin = 'fetched'").select(F.coalesce("symbol", F.lit("<none>")).alias("symbol"), F.filter(F.coalesce(at, F.array().cast("array<bigint>")), lambda x: x.isNotNull()).alias("at"))
    first, last = F.min(F.array_min("at")), F.max(F.array_max("at"))
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.size("at")).cast("long").alias("n_rows"), millis_to_micros(first).alias("first_micros"), millis_to_micros(last).alias("last_micros"))
