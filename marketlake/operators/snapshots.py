"""What an account or a contract states about itself, as rows: margin and positions, and instruments of a chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalars import exact_decimal, hex_word, millis_to_micros, shifted_decimal
from marketlake.operators.normalise import ENVELOPE, parse, split_failures

HELD = "coin:string,szi:string,entryPx:string,positionValue:string,unrealizedPnl:string,returnOnEquity:string,liquidationPx:string,leverage:struct<type:string,value:string>,maxLeverage:int,marginUsed:string,cumFunding:struct<allTime:string,sinceOpen:string,sinceChange:string>"
STATE = f"struct<time:bigint,marginSummary:struct<accountValue:string,totalNtlPos:string,totalRawUsd:string,totalMarginUsed:string>,crossMaintenanceMarginUsed:string,withdrawable:string,assetPositions:array<struct<position:struct<{HELD}>>>>"
SNAPSHOT = f"struct<dex:string,mode:struct<answer:string>,clearinghouseState:{STATE}>"
ANSWERS = "struct<symbol:string,decimals:string,uiMultiplier:string>"
#: Account modes of the venue and what they are called here (fixed values).
MODES = {"unifiedAccount": "unified", "portfolioMargin": "portfolio_margin", "disabled": "disabled", "default": "default"}
#: Why an account value is no equity, by mode (fixed values); other modes hold their equity.
NOT_EQUITY = {"unified": "collateral is spot (unifiedAccount), out of scope", "portfolio_margin": "collateral is spot (portfolioMargin), out of scope", "unknown": "account mode unknown"}
MARGIN = {"account_value": "marginSummary.accountValue", "total_notional": "marginSummary.totalNtlPos", "total_raw_usd": "marginSummary.totalRawUsd", "margin_used": "marginSummary.totalMarginUsed", "maintenance_margin_used": "crossMaintenanceMarginUsed", "withdrawable": "withdrawable"}
POSITION = {"size": "szi", "entry_price": "entryPx", "position_value": "positionValue", "unrealised_pnl": "unrealizedPnl", "return_on_equity": "returnOnEquity", "liquidation_price": "liquidationPx", "leverage": "leverage.value", "margin_used": "marginUsed", "funding_all_time": "cumFunding.allTime", "funding_since_open": "cumFunding.sinceOpen", "funding_since_change": "cumFunding.sinceChange"}


def _mapped(of: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[key]


def account_snapshots(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(margin, positions, failures): one margin row for each snapshot and one row for each position it holds.

    A mode that wasn't heard or isn't known is ``unknown``, never another one; where collateral lies elsewhere or the
    mode is unknown, ``equity_not_held`` says why the account value is no equity.  Figures that the venue leaves out
    are null (a position's mark is never derived).  A snapshot with any number that does not parse, or a position
    without ticker or size, is one dead letter and gives no rows.
    """
    x = parse(df, SNAPSHOT).withColumn("_s", F.col("data.clearinghouseState"))
    held = F.coalesce(F.col("_s.assetPositions.position"), F.array().cast(f"array<struct<{HELD}>>"))
    bare = lambda p: F.regexp_replace(p["coin"], "^[^:]*:", "")

    def text(p: Column, path: str) -> Column:
        for part in path.split("."):
            p = p[part]
        return p

    fits = lambda p, paths: [text(p, c).isNull() | exact_decimal(text(p, c)).isNotNull() for c in paths]
    sound = lambda p: _all([F.length(bare(p)) > 0, text(p, "szi").isNotNull(), *fits(p, POSITION.values())])
    ok = _all([F.col("data.dex").isNotNull(), F.col("_s.marginSummary").isNotNull(), *fits(F.col("_s"), MARGIN.values()), F.forall(held, sound)])
    rows, bad = split_failures(x.withColumn("_held", held), ok)
    keep = [*ENVELOPE, F.when(F.col("data.dex") != "", F.col("data.dex")).alias("dex"), millis_to_micros(F.col("_s.time")).alias("at_micros")]
    mode = F.coalesce(_mapped(MODES, F.coalesce(F.col("data.mode.answer"), F.lit(""))), F.lit("unknown"))
    margin = rows.select(*keep, mode.alias("mode"), *[exact_decimal(text(F.col("_s"), c)).alias(k) for k, c in MARGIN.items()])
    margin = margin.withColumn("equity_not_held", _mapped(NOT_EQUITY, F.col("mode")))
    p = F.col("_p")
    held_rows = rows.select(*keep, F.explode("_held").alias("_p"))
    positions = held_rows.select(*[c for c in held_rows.columns if c != "_p"], bare(p).alias("ticker"), *[exact_decimal(text(p, c)).alias(k) for k, c in POSITION.items()], F.lit(None).cast("decimal(38,18)").alias("mark"), p["leverage"]["type"].alias("leverage_type"), p["maxLeverage"].alias("max_leverage"))
    return margin, positions, bad


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def abi_text(answer: Column) -> Column:
    """Text of an ABI-encoded dynamic string (offset, length, bytes); null where the answer is short or no hex."""
    digits = F.regexp_replace(answer, "^0x", "")
    size = F.conv(F.substring(digits, 121, 8), 16, 10).cast("long")
    whole = digits.rlike("^([0-9a-fA-F]{2}){64,}$") & (F.length(digits) >= 128 + 2 * size)
    raw = F.unhex(F.substr(digits, F.lit(129), (2 * size).cast("int")))
    return F.when(whole, F.regexp_replace(F.make_valid_utf8(raw.cast("string")), "\u0000+$", ""))


def small_word(answer: Column) -> Column:
    """Value of a hex word below 2^32; null for a revert (null, empty) and for larger ones."""
    value = hex_word(F.concat(F.lit("0x"), F.regexp_replace(answer, "^0x", "")))
    return F.when(value < (1 << 32), value).cast("long")


def multiplier(answer: Column, decimals: int = 18) -> Column:
    """Display multiplier as decimal(38,18); a revert (null or empty) stays null, never 1, and a zero word is 0."""
    return shifted_decimal(hex_word(F.concat(F.lit("0x"), F.regexp_replace(answer, "^0x", ""))), F.lit(decimals))


def instruments(df: DataFrame, declared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(instrument rows, failures) of contract answers; ``declared``: address, ticker, decimals (used where the contract answers none).

    A token's only increment is one base unit, so tick, lot and least size are 10^-decimals (at most 18).  ``active``: the contract answered at all.
    """
    # a payload that is no JSON parses to a struct of nulls, as a contract that answers nothing does
    rows, bad = split_failures(parse(df, ANSWERS), F.get_json_object(F.col("payload").cast("string"), "$").isNotNull())
    known = declared.select(F.lower("address").alias("_a"), "ticker", F.col("decimals").alias("_d"))
    rows = rows.withColumn("_a", F.lower("symbol")).join(known, "_a")
    scale = F.least(F.coalesce(small_word(F.col("data.decimals")), F.col("_d").cast("long")), F.lit(18)).cast("int")
    rows = rows.withColumn("_u", shifted_decimal(F.lit(1).cast("decimal(38,0)"), scale))
    answered = F.col("data.symbol").isNotNull() | F.col("data.decimals").isNotNull()
    unit = [F.col("_u").alias(c) for c in ("tick_size", "lot_size", "min_size")]
    out = rows.select("seq", "venue", "ticker", *unit, F.lit("token").alias("contract_type"), F.coalesce(abi_text(F.col("data.symbol")), F.col("ticker")).alias("base"), F.lit("").alias("quote"), F.lit("continuous").alias("hours"), answered.alias("active"), F.lit(None).cast("int").alias("venue_index"), multiplier(F.col("data.uiMultiplier")).alias("ui_multiplier"), F.col("recv_micros").alias("observed_at"))
    return out, bad
