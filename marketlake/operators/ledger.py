"""Account ledger: positions, weighted-average basis, realised P&L and checks over fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.joins import asof_join

ORDER = ("t", "order_id", "trade_id")


def book_of(df: DataFrame) -> list[str]:
    """A book is (account, dex, ticker); a table without ``dex`` has one."""
    return [c for c in ("account", "dex", "ticker") if c in df.columns]


def positions(fills: DataFrame, tolerance: float = 1e-9, order: tuple[str, ...] = ORDER) -> DataFrame:
    """``signed`` size, running ``position`` of each book after the fill, and ``anchor``; windows run inside one book.

    A book begins at its first fill's ``start_position`` (0 where it has none).  A later stated start that
    is off the running position by more than ``tolerance`` anchors the book anew; ``anchor`` is the stated
    start where that happens, at the first fill too.
    """
    book = book_of(fills)
    signed = F.when(F.col("side") == "bid", F.col("size")).otherwise(-F.col("size"))
    start = F.col("start_position") if "start_position" in fills.columns else F.lit(None).cast("double")
    w = Window.partitionBy(*book).orderBy(*order)
    ahead, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    rows = fills.withColumn("signed", signed).withColumn("_before", F.coalesce(F.sum("signed").over(ahead), F.lit(0.0)))
    rows = rows.withColumn("_d", start - F.col("_before")).withColumn("_first", F.row_number().over(w) == 1)
    rows = rows.withColumn("_was", F.coalesce(F.last("_d", ignorenulls=True).over(ahead), F.lit(0.0)))
    anew = F.col("_d").isNotNull() & (F.col("_first") | (F.abs(F.col("_d") - F.col("_was")) > tolerance))
    rows = rows.withColumn("anchor", F.when(anew, start)).withColumn("_at", F.when(anew, F.col("_d")))
    offset = F.coalesce(F.last("_at", ignorenulls=True).over(upto), F.lit(0.0))
    return rows.withColumn("position", F.col("_before") + F.col("signed") + offset).drop("_before", "_d", "_was", "_first", "_at")


def continuity_breaks(fills: DataFrame, tolerance: float, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Fills whose stated ``start_position`` differs from the position after the fill before them (``expected``)."""
    w = Window.partitionBy(*book_of(fills)).orderBy(*order)
    pos = positions(fills, tolerance, order).withColumn("expected", F.lag("position").over(w))
    return pos.where(F.col("expected").isNotNull() & F.col("anchor").isNotNull()).drop("signed", "position", "anchor")


def episodes(pos: DataFrame, order: tuple[str, ...] = ORDER, flat: float = 1e-9) -> DataFrame:
    """``episode``: number of times the book was flat before the fill, or was anchored anew at or before it."""
    w = Window.partitionBy(*book_of(pos)).orderBy(*order)
    was_flat = F.when(F.abs(F.lag("position").over(w)) < flat, 1).otherwise(0)
    rows = pos.withColumn("_new", F.when(F.col("anchor").isNotNull() & (F.row_number().over(w) > 1), 1).otherwise(was_flat))
    return rows.withColumn("episode", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def basis(pos: DataFrame, flat: float = 1e-9) -> DataFrame:
    """Final position, weighted-average basis and realised P&L of each episode (flat to flat, or from an anchor).

    The basis is an ordered recursion: one JVM fold over the fills of an episode (memory: one episode).
    It is 0 when flat and null when unknown: a book anchored at a position that is not flat has a basis
    nobody has stated, and what is closed against it is not counted.  Same side: weighted average;
    reducing: realised = closed * (price - basis) * sign; a flip starts at its price.
    """
    book = book_of(pos)
    row = F.struct(*ORDER, "signed", "price", "anchor")
    g = episodes(pos, flat=flat).groupBy(*book, "episode").agg(F.array_sort(F.collect_list(row)).alias("fills"))
    zero = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).cast("double").alias("b"), F.lit(0.0).alias("pnl"))

    def step(acc, x):
        p = F.coalesce(x["anchor"], acc["p"])
        b = F.when(x["anchor"].isNull(), acc["b"]).when(x["anchor"] == 0, F.lit(0.0))
        q, px = x["signed"], x["price"]
        same = (p == 0) | (F.signum(p) == F.signum(q))
        now = p + q
        closed = F.least(F.abs(p), F.abs(q))
        pnl = acc["pnl"] + F.when(same | b.isNull(), F.lit(0.0)).otherwise(closed * (px - b) * F.signum(p))
        nb = F.when(p == 0, px).when(same, (F.abs(p) * b + F.abs(q) * px) / (F.abs(p) + F.abs(q))).when(F.abs(q) > F.abs(p), px).otherwise(b)
        return F.struct(F.when(F.abs(now) < flat, F.lit(0.0)).otherwise(now).alias("p"), F.when(F.abs(now) < flat, F.lit(0.0)).otherwise(nb).alias("b"), pnl.alias("pnl"))

    s = F.aggregate("fills", F.struct(zero["p"].alias("p"), F.when(F.lit(True), zero["b"]).alias("b"), zero["pnl"].alias("pnl")), step)
    return g.select(*book, "episode", F.size("fills").alias("fills"), s["p"].alias("position"), s["b"].alias("basis"), s["pnl"].alias("realised"))


def poisoned(fills: DataFrame) -> DataFrame:
    """Books with a fill of size 0 or a price that isn't positive: since when, and how many fills after it were not applied."""
    bad = fills.where("size = 0 OR price <= 0").groupBy(*book_of(fills)).agg(F.min(F.struct(*ORDER)).alias("at"))
    after = fills.join(bad, book_of(fills)).withColumn("since", F.col("at.t"))
    return after.groupBy(*book_of(fills), "since").agg(F.count_if(F.struct(*ORDER) > F.col("at")).alias("not_applied"))


def sound_positions(fills: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """:func:`positions`, with ``position`` unknown (null) from a book's poisoning fill on."""
    at = fills.where("size = 0 OR price <= 0").groupBy(*book_of(fills)).agg(F.min(F.struct(*ORDER)).alias("_at"))
    pos = positions(fills, tolerance).join(at, book_of(fills), "left")
    return pos.withColumn("position", F.when(F.col("_at").isNull() | (F.struct(*ORDER) < F.col("_at")), F.col("position"))).drop("_at")


def realised_agrees(fills: DataFrame, relative: float) -> DataFrame:
    """Stated P&L against the folded one: agreements and skews by book."""
    ok = F.abs(F.col("stated") - F.col("folded")) <= relative * F.col("closing") * F.col("price")
    return fills.groupBy(*book_of(fills)).agg(F.count_if(ok).alias("agreements"), F.count_if(~ok).alias("skews"))


def cash_flow(updates: DataFrame) -> DataFrame:
    """USDC by account and dex from ledger effects (array of dex, usdc; null: unknown), unknown effects counted."""
    rows = updates.select("account", F.explode_outer("effects").alias("e"))
    return rows.groupBy("account", F.col("e.dex").alias("dex")).agg(F.sum("e.usdc").alias("usdc"), F.count_if(F.col("e").isNull()).alias("unknown"))


def fees_and_funding(fills: DataFrame, funding: DataFrame) -> DataFrame:
    """Fees by account, null while any is unrecorded, and the sum of funding payments; accounts with either."""
    fees = fills.groupBy("account").agg(F.when(F.count_if(F.col("fee").isNull()) == 0, F.sum("fee")).alias("fees"))
    return fees.join(funding.groupBy("account").agg(F.sum("usdc").alias("funding")), "account", "full")


def snapshot_checks(pos: DataFrame, snapshots: DataFrame, tolerance: float) -> DataFrame:
    """Venue positions at their moment against the book after fills at or before it; a book without fills is flat."""
    held = asof_join(snapshots, pos.withColumn("_last", F.struct("order_id", "trade_id")), book_of(pos), ["position"], order="_last").drop("right_t")
    return held.withColumn("agrees", F.abs(F.col("stated") - F.coalesce("position", F.lit(0.0))) <= tolerance)


def history_reach(fills: DataFrame, funding: DataFrame) -> DataFrame:
    """By account, whether the fills reach back far enough, by evidence: a funding payment proves a fill at or before it.

    ``lost``: funding before the first fill, or without one; ``consistent``: fills and nothing against them; an account with neither has no row (unknown).
    """
    f = fills.groupBy("account").agg(F.min("t").alias("first_fill"), F.max("t").alias("newest_fill"))
    p = funding.groupBy("account").agg(F.min("t").alias("first_funding"))
    reach = F.when(F.col("first_fill").isNull() | (F.col("first_funding") < F.col("first_fill")), "lost").otherwise("consistent")
    return f.join(p, "account", "full").withColumn("reach", reach)


def beyond_reach(pages: DataFrame, held: DataFrame, page_size: int) -> DataFrame:
    """Pages (account, page, t) that begin beyond what the venue still holds: full, and their first event is later than the newest one held (account, newest)."""
    g = pages.groupBy("account", "page").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first")).join(held.select("account", "newest"), "account")
    return g.where((F.col("n") >= page_size) & (F.col("first") > F.col("newest"))).select("account", "page", "first", "newest")
