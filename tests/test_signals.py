"""Measures of the composed signals against values by hand and by numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.functions.scalars import bound
from marketlake.operators import aggs, windows
from marketlake.plans import signals

H, D, M = 3_600_000_000, 86_400_000_000, 60_000_000


def by_measure(rows, **where):
    return {(r["ticker_i"], r["asof_micros"], r["measure"]): (r["value"], r["absent"]) for r in rows.collect() if all(r[k] == v for k, v in where.items())}


def test_median_and_bound(spark):
    got = spark.createDataFrame([([3.0, 1.0, 2.0],), ([4.0, 1.0],), ([],)], "a array<double>").select(aggs.median_of(F.col("a")), bound(F.size("a"), lambda n: n * n)).collect()
    assert [tuple(r) for r in got] == [(2.0, 9), (2.5, 4), (None, 0)]


def test_trailing_z(spark):
    rng = np.random.default_rng(3)
    rows = [("A", int(h) * H, float(rng.normal()), None if h % 5 == 0 else float(rng.normal())) for h in sorted(rng.choice(80, 60, replace=False))] + [("B", h * H, 1.0, 1.0) for h in range(12)]
    got = {(r["ticker"], r["period"]): (r["z"], r["z_n"], r["z_why"]) for r in aggs.trailing_z(spark.createDataFrame(rows, "ticker string, period long, v double, p double"), "v", "p", ["ticker"], 24 * H, 8).collect()}
    for k, t, v, _ in rows:
        past = np.array([p for j, u, _, p in rows if j == k and t - 24 * H <= u < t and p is not None])
        mad = np.median(abs(past - np.median(past))) if len(past) else 0
        z, n, why = got[k, t]
        assert n == len(past)
        if len(past) < 8:
            assert z is None and why == "too few periods before"
        elif mad == 0:
            assert z is None and why == "the periods before do not vary"
        else:
            assert z == pytest.approx((v - np.median(past)) / (1.4826 * mad)) and why is None


def test_basis_compares_sessioned_hours_with_whole_ones_only(spark):
    # 1970-01-02 was a Friday: the session closes at 22:00 UTC (17:00 in New York) until Sunday
    rows = [(k, h * H + m * M, 100.0 + (h % 7) / 10 + m / 1e4, 100.0, (100.0 + (h % 7) / 10 + m / 1e4) / 100 - 1, (0.0 if m < 2 else 50.0 + m) if h != 40 else (7.0 if m == 30 else 0.0), 100 * h + m) for k in "AX" for h in range(24, 60) for m in range(60) if h != 33 or m < 20]
    df = spark.createDataFrame(rows, "ticker string, t long, mark double, oracle double, premium double, open_interest double, event_id long")
    got = by_measure(signals.basis(df, 60_000_000, 48, ("X",), 30, 5))
    at = lambda k, h, m: got.get((k, (h + 1) * H, m))
    assert at("A", 30, "external_share") is None and at("X", 30, "external_share") == (1.0, None) and at("X", 47, "external_share") == (0.0, None)
    assert at("A", 33, "premium_twa_bps") == (None, "too little of the hour is covered") and at("A", 33, "open_interest_usd")[0] is None
    assert at("A", 30, "open_interest_log_change")[0] == pytest.approx(np.log(109 / 52))
    assert at("A", 40, "open_interest_usd") == (None, "under two open-interest samples in the hour") and at("A", 40, "premium_twa_bps")[0] is not None
    assert at("X", 47, "premium_z_30d") == (None, "the hour is not wholly in the external session") and at("A", 47, "premium_z_30d")[0] is not None
    assert at("X", 33, "premium_z_30d")[1] == "nothing this period"


def test_carry(spark):
    rng = np.random.default_rng(5)
    hours = [h for h in range(24 * 40) if rng.random() > 0.03 or h > 24 * 38]
    rate = {h: float(rng.normal(1e-5, 1e-5)) for h in hours}
    settled = spark.createDataFrame([("A", h * H + 20, rate[h]) for h in hours] + [("A", h * H + 900, 9.0) for h in hours[::50]], "ticker string, t long, rate double")
    live = spark.createDataFrame([("A", 900 * H, 0.5), ("A", 900 * H + 5, 0.25), ("A", 903 * H, None)], "ticker string, recv_micros long, rate double")
    r = {h: float(rng.normal()) for h in range(100, 950)}
    returns = spark.createDataFrame([("A", h * H, x) for h, x in r.items()], "ticker string, t long, r double")
    got = by_measure(signals.carry(settled, 0.9, 1e-5, live, returns, z_days=20, z_min=10))
    at = lambda h, m: got.get(("A", h * H, m))
    for h in (700, 701, 719, 720, 721, 900, 950, 955):
        if h not in rate:
            continue
        week = [rate[x] for x in range(h - 167, h + 1) if x in rate]
        days = {}
        for x in rate:
            if h - 168 - 480 < x <= h - 168:
                days.setdefault((x - 1) // 24, []).append(rate[x])
        means = [np.mean(v) for v in days.values() if len(v) >= 0.9 * 24]
        vols = [r[x] for x in r if x + 1 <= h and x + 1 >= h - 31 * 24 + 2]
        assert at(h, "carry_apr_7d")[0] == pytest.approx(np.mean(week) * 8760)  # the rate settled at the hour itself counts
        assert at(h, "zscore_7d")[0] == pytest.approx((np.mean(week) - np.mean(means)) / np.std(means, ddof=1))
        assert at(h, "carry_to_vol_7d")[0] == pytest.approx(np.mean(week) * 8760 / (np.std(vols, ddof=1) * 8760**0.5))
    assert at(900, "nowcast_apr")[0] == 0.5 * 8760 and at(901, "nowcast_apr")[0] == 0.25 * 8760 and at(950, "nowcast_apr")[0] is None
    first = min(hours)
    assert at(first, "carry_apr_7d") == (None, "too few settled hours") and at(200, "zscore_7d")[1] == "too few covered days before the week"


def test_trailing_amihud(spark):
    rng = np.random.default_rng(11)
    rows = [("v", k, int(t), float(rng.uniform(90, 110)), float(rng.integers(1, 9)), "bid" if i % 2 else "ask", i) for k in "AB" for i, t in enumerate(sorted(rng.choice(70 * 60, 160, replace=False) * M))]
    df = spark.createDataFrame(rows, "venue string, ticker string, t long, price double, size double, aggressor string, trade_id long")
    asofs = spark.createDataFrame([("v", k, h * H) for k in "AB" for h in range(100)], "venue string, ticker string, period long")
    got = {(r["ticker"], r["period"] // H): (r["amihud"], r["amihud_n"]) for r in aggs.trailing_amihud(df, asofs, 6).collect()}
    assert len(got) == 200
    for (k, h), (value, n) in got.items():
        buckets = [(t, p, p * s) for _, j, t, p, s, *_ in rows if j == k and (h - 5) * H <= t < (h + 1) * H]
        want = [abs(np.log(b[1] / a[1])) * 1e4 / (b[2] / 1e6) for a, b in zip(buckets, buckets[1:])]
        assert (n or 0) == len(want) and (value == pytest.approx(np.mean(want), rel=1e-9) if want else value is None)


def test_moments_of_sessioned_days(spark):
    # a week from Monday 1970-01-05 of 5-minute returns: none of X's on Saturday, all of A's
    start, rng = 4 * D, np.random.default_rng(2)
    r = {(k, start + i * 5 * M): float(rng.normal()) for k in "AX" for i in range(7 * 288)}
    df = spark.createDataFrame([(k, t, v) for (k, t), v in r.items()], "ticker string, t long, r double")
    got = by_measure(signals.moments(df, sessioned=("X",)))
    sat = start + 6 * D  # the end of Saturday
    assert got["X", sat, "realized_vol_1d"] == (None, "not enough observations") and got["A", sat, "realized_vol_1d"][0] > 0
    def skew(k, day, keep=lambda t: True):
        v = np.array([x for (j, t), x in r.items() if j == k and start + day * D <= t < start + (day + 1) * D and keep(t)])
        return np.sqrt(len(v)) * (v**3).sum() / (v**2).sum() ** 1.5
    assert got["A", start + 4 * D, "realized_skew_7d"][0] == pytest.approx(np.mean([skew("A", x) for x in range(4)]))
    assert got["A", start + 3 * D, "realized_skew_7d"] == (None, "too few periods with moments")
    # the daily break is 22:00 to 23:00 UTC in winter: its bars and the return after it do not count
    open_ = lambda t: not 22 * H <= t % D <= 23 * H
    assert got["X", start + D, "realized_skew_1d"][0] == pytest.approx(skew("X", 0, open_))


def test_jumps(spark):
    rng = np.random.default_rng(9)
    n, up, down = 3 * 288, 2 * 288 + 100, 3 * 288 - 1
    r = rng.normal(0, 1e-3, n)
    r[up], r[down] = 0.05, -0.05
    df = spark.createDataFrame([("A", i * 5 * M, float(v)) for i, v in enumerate(r)] + [("B", i * 5 * M, 0.001) for i in range(5)], "ticker string, t long, r double")
    got = by_measure(signals.jumps(df))
    at = lambda m, k="A", d=3: got[k, d * D, m][0]
    assert (at("jumps_up_24h"), at("jumps_down_24h"), at("jump_last")) == (1, 1, 1) and at("L_last") < -10 and at("jumps_up_24h", d=2) == 0
    day = r[2 * 288 :]
    assert at("jump_var_up_24h") == pytest.approx(0.05**2 / (day**2).sum()) and at("jump_share_24h") > 0.5
    # the last bar ends at the asof and counts in full
    assert at("intensity_down") == pytest.approx(1) and at("intensity_up") == pytest.approx(np.exp(-(n - up - 1) * 5 * M / (6 * H)))
    assert got["B", D, "jumps_up_24h"] == (None, "not enough observations") and at("L_last", "B", 1) is None and at("intensity_up", "B", 1) == 0
    # the same hour's scale doubled: the statistic does not change, the variance shares neither
    factors = windows.periodicity(df.where("ticker = 'A'"), 2 * D).withColumn("factor", F.lit(2.0))
    assert by_measure(signals.jumps(df.where("ticker = 'A'"), factors=factors))["A", 3 * D, "L_last"][0] == pytest.approx(at("L_last"))


def test_liquidity_rows_and_floors(spark):
    quotes = spark.createDataFrame([("v", "A", m * M, 99.0, 101.0, 2.0, 3.0, m) for m in range(60)] + [("v", "A", 65 * M, 99.5, 100.5, 2.0, 3.0, 99)], "venue string, ticker string, t long, bid_px double, ask_px double, bid_sz double, ask_sz double, event_id long")
    trades = spark.createDataFrame([("v", "A", 10 * M + 1, 101.0, 1.0, "bid", 1, 5), ("v", "A", H - 2_000_000, 99.0, 3.0, "ask", 2, 5), ("v", "B", 5, 10.0, 1.0, "bid", 3, 5)], "venue string, ticker string, t long, price double, size double, aggressor string, trade_id long, recv_micros long")
    got = by_measure(signals.liquidity(quotes, trades, M, z_min=1))
    at = lambda m, k="v/A", h=1: got[k, h * H, m]
    assert at("quoted_spread_bps")[0] == pytest.approx(200) and at("depth_usd_median")[0] == pytest.approx(198)
    assert at("effective_spread_bps_vw")[0] == pytest.approx(200)
    assert at("impact_bps_5s_vw")[0] == pytest.approx(0)  # the trade 2 s before the hour's end isn't known yet
    assert at("quoted_spread_bps", h=2) == (None, "too little of the hour is covered") and at("spread_z_7d", h=2) == (None, "nothing this period")
    assert at("amihud_24h")[0] == pytest.approx(np.log(101 / 99) * 1e4 / (297 / 1e6)) and at("amihud_24h", h=2)[0] == at("amihud_24h")[0]
    assert at("effective_spread_bps_vw", "v/B") == (None, "no trade with a quote before it") and at("quoted_spread_bps", "v/B")[0] is None


def test_backfilled_share(spark):
    # every bar but 2 was heard forming a minute before its end; all were final nine hours later, bar 1 once more with another close
    bars = [("A", h * H, h * H + (30 * M if live else 2 * H), 1.0, not live) for h in range(5) for live in (True, False) if h != 2 or not live]
    bars = [(k, at, at + 59 * M if not final else at + 9 * H, c, final) for k, at, _, c, final in bars] + [("A", H, H + 10 * H, np.e, True)]
    df = spark.createDataFrame([(k, H, at, recv, c, final) for k, at, recv, c, final in bars], "ticker string, width long, at_micros long, recv_micros long, close double, is_final boolean")
    got = {r["t"] // H: (round(r["r"], 9), r["backfilled"]) for r in windows.live_returns(df, H).collect()}
    assert got[1][0] == 1 and got[2][0] == -1 and set(got) == {1, 2, 3, 4}
    # forming rows of 0:59, 1:59 and 4:59 are left: only the end of bar 2, 3:00, has none within an hour
    quiet = df.where(f"is_final OR at_micros NOT IN ({2 * H}, {3 * H})")
    assert {r["t"] // H: r["backfilled"] for r in windows.live_returns(quiet, H).collect()} == {1: False, 2: True, 3: True, 4: False}
    rows = spark.createDataFrame([("A", i, float(i), i < 2) for i in range(4)] + [("B", i, float(i * i), i == 3) for i in range(1, 4)], "ticker string, t long, r double, backfilled boolean")
    out = {(r["ticker_i"], r["ticker_j"]): (r["value"], r["absent"]) for r in signals.derive(rows, 1, 3).where("measure = 'backfilled_share'").collect()}
    assert out["A", None] == (0.5, None) and out["B", None][0] == pytest.approx(1 / 3) and out["A", "B"][0] == pytest.approx(2 / 3)
    assert "backfilled_share" not in {r["measure"] for r in signals.derive(rows.drop("backfilled"), 1, 3).collect()}
