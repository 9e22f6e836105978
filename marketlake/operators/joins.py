"""Joins of the tape: as-of, reorganisations, joint returns and pairs, overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], values: list[str], bucket_us: int = 86_400_000_000, shift_us: int = 0, tolerance_us: int | None = None, order: str = "event_id") -> DataFrame:
    """``left`` with the ``values`` of the last right row at or before ``t + shift_us`` and its time ``right_t``.

    Both sides are windowed together by (by, time bucket).  A bucket begins with the last right row of
    the buckets before it, which is found on one row for each bucket: no window runs over a whole key.
    Ties of right times go to the row last in ``order``.
    """
    key = F.floor(F.col("_at") / bucket_us)
    state = F.struct(F.col("t").alias("right_t"), F.col(order).alias("_o"), *values)
    r = right.select(*by, F.col("t").alias("_at"), state.alias("_s")).withColumn("_b", key)
    last = r.groupBy(*by, "_b").agg(F.max_by("_s", F.struct("_at", "_s._o")).alias("_s"))
    l = left.withColumn("_at", F.col("t") + shift_us).withColumn("_b", key)
    grid = last.unionByName(l.select(*by, "_b").distinct().withColumn("_s", F.lit(None).cast(last.schema["_s"].dataType)))
    grid = grid.groupBy(*by, "_b").agg(F.max("_s").alias("_s"))
    carry = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select(*by, "_b", F.last("_s", ignorenulls=True).over(carry).alias("_carry"))
    packed = F.struct(*[F.col(c) for c in left.columns if c not in by]).alias("_l")
    both = r.select(*by, "_b", "_at", "_s", F.lit(0).alias("_side")).unionByName(l.select(*by, "_b", "_at", packed, F.lit(1).alias("_side")), allowMissingColumns=True)
    w = Window.partitionBy(*by, "_b").orderBy("_at", "_side", F.col("_s._o")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_hit", F.last("_s", ignorenulls=True).over(w)).where("_side = 1").join(grid, [*by, "_b"], "left")
    hit = F.coalesce("_hit", "_carry")
    if tolerance_us is not None:
        hit = F.when(F.col("_at") - hit["right_t"] <= tolerance_us, hit)
    both = both.withColumn("_hit", hit)
    return both.select(*by, *[F.col(f"_l.{c}").alias(c) for c in left.columns if c not in by], F.col("_hit.right_t").alias("right_t"), *[F.col(f"_hit.{v}").alias(v) for v in values])


def standing(rows: DataFrame, reorgs: DataFrame, span: int = 1000) -> DataFrame:
    """``rows`` (block, seq) with ``reorg_seq``: the latest reorganisation that covers the block and came after the row.

    Ranges are spread over spans of blocks, so it is an equi-join with a residual condition; null: uncontradicted.
    """
    r = reorgs.select(F.col("from_block").alias("_f"), F.col("to_block").alias("_t"), F.col("seq").alias("_q"))
    r = r.withColumn("_k", F.explode(F.sequence(F.floor(F.col("_f") / span), F.floor(F.col("_t") / span))))
    rows = rows.withColumn("_k", F.floor(F.col("block") / span))
    hit = rows.join(r, "_k").where("block BETWEEN _f AND _t AND seq < _q").groupBy("block", "seq").agg(F.max("_q").alias("reorg_seq"))
    return rows.drop("_k").join(hit, ["block", "seq"], "left")


def joint_returns(returns: DataFrame, tickers: int) -> DataFrame:
    """Returns at slots where all ``tickers`` instruments have one."""
    full = returns.groupBy("t").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == tickers).drop("_n")
    return returns.join(full, "t")


def pairs(returns: DataFrame, own: bool = True) -> DataFrame:
    """All pairs i <= j (i < j without ``own``) of instruments at each slot."""
    a = returns.select("t", F.col("ticker").alias("i"), F.col("r").alias("ri"))
    b = returns.select("t", F.col("ticker").alias("j"), F.col("r").alias("rj"))
    return a.join(b, "t").where("i <= j" if own else "i < j")


def match_tails(tails: DataFrame, returns: DataFrame) -> DataFrame:
    """A forecast at ``asof`` with the return of the bar that starts there."""
    return tails.join(returns.select("ticker", F.col("t").alias("asof"), "r"), ["ticker", "asof"])


def resolve_symbols(df: DataFrame, symbols: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved rows with ``ticker``, rows whose (channel, symbol) isn't declared)."""
    out = df.join(symbols.select("channel", "symbol", "ticker"), ["channel", "symbol"], "left")
    return out.where("ticker IS NOT NULL"), out.where("ticker IS NULL").drop("ticker")


def alias_counterparties(updates: DataFrame, ours: DataFrame) -> DataFrame:
    return updates.join(ours.select("fingerprint", "alias"), updates["counterparty"] == ours["fingerprint"], "left").drop("fingerprint")


def cross_venue(quotes: DataFrame, bucket_us: int) -> DataFrame:
    """Last mid of each venue by (ticker, bucket), side by side, and the difference in basis points."""
    mid = (F.col("bid_px") + F.col("ask_px")) / 2
    last = quotes.groupBy("ticker", (F.floor(F.col("t") / bucket_us) * bucket_us).alias("bucket"), "venue").agg(F.max_by(mid, F.struct("t", "event_id")).alias("mid"))
    a, b = (last.where(F.col("venue") == v).select("ticker", "bucket", F.col("mid").alias(f"mid_{v}")) for v in ("a", "b"))
    return a.join(b, ["ticker", "bucket"]).withColumn("diff_bps", (F.col("mid_a") / F.col("mid_b") - 1) * 1e4)


def underlying(transfers: DataFrame, instruments: DataFrame) -> DataFrame:
    """Transferred amounts times the multiplier in force at their time; 1 where none is known."""
    out = asof_join(transfers, instruments, ["ticker"], ["multiplier"])
    return out.withColumn("shares", F.col("amount") * F.coalesce("multiplier", F.lit(1.0)))
