"""Ordered operators.  Windows run inside (keys, time bucket) with a carried row where a key can be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_next(df: DataFrame, keys: list[str], order: list[str], bucket_us: int, t: str = "t") -> DataFrame:
    """``df`` with ``next_t``: the time of the key's next row.

    Rows are windowed by (keys, time bucket); a bucket's last row looks up the first time of the next
    bucket that has rows, which is found on one row for each bucket.
    """
    df = df.withColumn("_b", F.floor(F.col(t) / bucket_us))
    first = df.groupBy(*keys, "_b").agg(F.min(t).alias("_first"))
    nxt = first.withColumn("_after", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_b"))).drop("_first")
    w = Window.partitionBy(*keys, "_b").orderBy(t, *order)
    return df.withColumn("_own", F.lead(t).over(w)).join(nxt, [*keys, "_b"]).withColumn("next_t", F.coalesce("_own", "_after")).drop("_own", "_after", "_b")


def stood(df: DataFrame, keys: list[str], period_us: int, max_stand_us: int, order: list[str], t: str = "t", bucket_us: int | None = None) -> DataFrame:
    """Standing intervals: a state lasts to the key's next, at most ``max_stand_us``, split over the periods it touches.

    Adds ``period`` (start) and ``w`` (micros stood in it).  The cap bounds how many periods a state touches.
    """
    rows = with_next(df, keys, order, bucket_us or max(period_us, 86_400_000_000), t)
    end = F.least(F.coalesce(F.col("next_t"), F.col(t) + max_stand_us), F.col(t) + max_stand_us)
    rows = rows.withColumn("_end", end).where(F.col("_end") > F.col(t))
    lo, hi = F.floor(F.col(t) / period_us), F.floor((F.col("_end") - 1) / period_us)
    rows = rows.withColumn("_k", F.explode(F.sequence(lo, hi))).withColumn("period", F.col("_k") * period_us).drop("_k")
    w = F.least("_end", F.col("period") + period_us) - F.greatest(F.col(t), F.col("period"))
    return rows.withColumn("w", w).drop("_end", "next_t")


def log_returns(bars: DataFrame, bucket_us: int, keys: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Log returns between a bar and the one exactly one bucket before: an equi-join, so no window over a key."""
    before = bars.select(*keys, (F.col("t") + bucket_us).alias("t"), F.col("close").alias("before"))
    return bars.join(before, [*keys, "t"]).select(*keys, "t", F.log(F.col("close") / F.col("before")).alias("r"))


def minute_changes(marks: DataFrame) -> DataFrame:
    """Last mark and open interest of each minute; return and interest change between adjacent minutes; interest closed."""
    minute = 60_000_000
    last = marks.groupBy("ticker", (F.floor(F.col("t") / minute) * minute).alias("t")).agg(F.max_by(F.struct("mark", "open_interest"), F.struct("t", "event_id")).alias("s"))
    last = last.select("ticker", "t", "s.mark", "s.open_interest")
    before = last.select("ticker", (F.col("t") + minute).alias("t"), F.col("mark").alias("m0"), F.col("open_interest").alias("o0"))
    out = last.join(before, ["ticker", "t"], "left")
    d = F.col("open_interest") - F.col("o0")
    return out.select("ticker", "t", "mark", "open_interest", F.log(F.col("mark") / F.col("m0")).alias("r"), d.alias("d"), F.greatest(-d, F.lit(0.0)).alias("closed"))


def merge_events(flagged: DataFrame, gap_us: int, keys: tuple[str, ...] = ("ticker", "side")) -> DataFrame:
    """Flagged minutes at most ``gap_us`` apart are one event: start, end, minutes, notional."""
    w = Window.partitionBy(*keys).orderBy("t")
    new = F.when(F.col("t") - F.lag("t").over(w) <= gap_us, 0).otherwise(1)
    rows = flagged.withColumn("_n", new).withColumn("event", F.sum("_n").over(w))
    return rows.groupBy(*keys, "event").agg(F.min("t").alias("start"), F.max("t").alias("end"), F.count(F.lit(1)).alias("minutes"), F.sum("notional").alias("notional"))


def rolling_mean(df: DataFrame, n: int, value: str = "value", keys: tuple[str, ...] = ("ticker",), order: str = "t") -> DataFrame:
    """Mean of the last ``n`` rows; null until there are ``n``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumn("mean", F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def lee_mykland(returns: DataFrame, k: int = 270, alpha: float = 0.01) -> DataFrame:
    """Return over the local bipower scale of the ``k`` returns before it; ``jump`` by the Gumbel threshold."""
    import math

    by = Window.partitionBy("ticker").orderBy("t")
    rows = returns.withColumn("_p", F.abs("r") * F.abs(F.lag("r").over(by)))
    prior = by.rowsBetween(-(k - 2), -1)
    rows = rows.withColumn("_n", F.count("_p").over(prior)).withColumn("scale", F.sqrt(F.avg("_p").over(prior)))
    n, c = F.count(F.lit(1)).over(Window.partitionBy("ticker")), math.sqrt(2 / math.pi)
    root = F.sqrt(2 * F.log(n))
    cn = root / c - (math.log(math.pi) + F.log(F.log(n))) / (2 * c * root)
    cut = cn + (-math.log(-math.log(1 - alpha))) / (c * root)
    stat = F.when(F.col("_n") == k - 2, F.col("r") / F.col("scale"))
    return rows.withColumn("L", stat).withColumn("jump", F.abs("L") > cut).drop("_p", "_n")


def newest(df: DataFrame, keys: list[str], order: list[str], n: int = 1) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def overlapping_ranges(inventory: DataFrame) -> DataFrame:
    """Neighbours, by first, within (partition, venue) where the next begins before the one before has ended."""
    w = Window.partitionBy("partition", "venue").orderBy("first", "last", "file")
    rows = inventory.withColumn("prev_file", F.lag("file").over(w)).withColumn("prev_last", F.lag("last").over(w))
    return rows.where("first <= prev_last").select("partition", "venue", "prev_file", "file", "prev_last", "first")


def epochs(df: DataFrame, days: int, t: str = "t") -> DataFrame:
    width = days * 86_400_000_000
    return df.withColumn("epoch", F.floor(F.col(t) / width)).withColumn("baseline", F.floor(F.col(t) / width) - 1)


def nearest_rank(df: DataFrame, value: str, q: float, keys: list[str]) -> DataFrame:
    """The value whose index is q (n - 1), rounded half up."""
    rows = df.where(F.col(value).isNotNull())
    w = Window.partitionBy(*keys).orderBy(value)
    rows = rows.withColumn("_i", F.row_number().over(w) - 1).join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
    return rows.where(F.col("_i") == F.floor(F.lit(q) * (F.col("_n") - 1) + 0.5)).select(*keys, F.col(value).alias("quantile"))


def heard_live(bars: DataFrame) -> DataFrame:
    """Final bars with ``live``: a forming row of some bar was heard within one width of its end."""
    forming = bars.where("NOT is_final").select("ticker", "width", F.floor(F.col("recv_micros") / F.col("width")).alias("_k"), F.col("recv_micros").alias("_r"))
    ends = bars.where("is_final").withColumn("_end", F.col("at_micros") + F.col("width"))
    near = ends.withColumn("_k", F.explode(F.array(F.floor(F.col("_end") / F.col("width")) - 1, F.floor(F.col("_end") / F.col("width")), F.floor(F.col("_end") / F.col("width")) + 1)))
    heard = near.join(forming, ["ticker", "width", "_k"]).where(F.abs(F.col("_r") - F.col("_end")) <= F.col("width")).select("ticker", "width", "at_micros").distinct().withColumn("live", F.lit(True))
    return ends.drop("_end").join(heard, ["ticker", "width", "at_micros"], "left").withColumn("live", F.coalesce("live", F.lit(False)))


def live_returns(bars: DataFrame, bucket_us: int) -> DataFrame:
    """Log returns of closing bars (ticker, width, at_micros, recv_micros, close, is_final), with ``backfilled``: one of the two was not heard live.

    A bar heard final several times is the one heard last; ``bars`` needs the forming rows too, which say what was live.
    """
    once = heard_live(bars).groupBy("ticker", (F.col("at_micros") + F.col("width")).alias("_end")).agg(F.max_by(F.struct("close", "live"), F.struct("recv_micros", "width")).alias("_s"))
    one = once.select("ticker", (F.floor((F.col("_end") - 1) / bucket_us) * bucket_us).alias("t"), "_end", F.col("_s.close").cast("double").alias("close"), (~F.col("_s.live")).alias("late")).where(F.col("_end") == F.col("t") + bucket_us).drop("_end")
    before = one.select("ticker", (F.col("t") + bucket_us).alias("t"), F.col("close").alias("_c"), F.col("late").alias("_l"))
    return one.join(before, ["ticker", "t"]).select("ticker", "t", F.log(F.col("close") / F.col("_c")).alias("r"), (F.col("late") | F.col("_l")).alias("backfilled"))


def periodicity(returns: DataFrame, cut_us: int) -> DataFrame:
    """Scale factor of each UTC hour from median absolute returns before ``cut_us``, with mean square 1."""
    hour = F.floor(F.pmod("t", F.lit(86_400_000_000)) / 3_600_000_000).cast("int")
    rows = returns.where(F.col("t") < cut_us).withColumn("hour", hour)
    mad = rows.groupBy("ticker", "hour").agg(F.expr("percentile(abs(r), 0.5)").alias("mad"))
    norm = mad.groupBy("ticker").agg(F.sqrt(F.avg(F.col("mad") * F.col("mad"))).alias("norm"))
    return mad.join(norm, "ticker").select("ticker", "hour", (F.col("mad") / F.col("norm")).alias("factor"))
