"""Risk signals against numpy, planted effects and hand-made cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import leadlag, models
from marketlake.plans import risk

DAY, HOUR, MIN = 86_400_000_000, 3_600_000_000, 60_000_000


def by_measure(rows, *keys):
    return {(*[r[k] for k in keys], r["measure"]): r for r in rows}


def days_of(n=260, seed=3, name="A"):
    rng, logs = random.Random(seed), 0.0
    out = []
    for t in range(n):
        logs = 0.9 * logs + rng.gauss(0, 0.3)
        rv = 1e-4 * math.exp(logs)
        out.append((name, t * DAY, rv, rv * rv * rng.uniform(1, 3)))
    return out


def test_harq_is_the_regression_on_closed_days(spark):
    rows = days_of()
    gone = {50, 51, 120}
    rows = [r for k, r in enumerate(rows) if k not in gone]
    schema = "ticker string, t long, rv double, rq double"
    both = spark.createDataFrame(rows + [("B", t, 2 * v, q) for _, t, v, q in rows], schema)
    got = {r["t"]: r for r in models.harq(both, DAY, 7).where("ticker = 'A'").collect()}
    t, rv, q = (np.array([r[k] for r in rows]) for k in (1, 2, 3))
    mean = lambda i, k: rv[i - k + 1 : i + 1].mean() if i + 1 >= k else np.nan
    x = np.array([[1, rv[i], rv[i] * math.sqrt(q[i]), mean(i, 7), mean(i, 30)] for i in range(len(rv))])
    at = {v: i for i, v in enumerate(t)}
    y = np.array([sum(rv[at[v + k * DAY]] for k in range(1, 8)) if all(v + k * DAY in at for k in range(1, 8)) else np.nan for v in t])
    seen = 0
    for i, v in enumerate(t):
        train = [j for j in range(i + 1) if t[j] + 7 * DAY <= v and not np.isnan(y[j]) and not np.isnan(x[j]).any()]
        if len(train) < 100:
            assert got[v]["forecast"] is None
            continue
        scale = np.abs(x[train]).max(axis=0)
        b = np.linalg.lstsq(x[train] / scale, y[train], rcond=None)[0] / scale
        raw = float(x[i] @ b)
        want = raw if y[train].min() <= raw <= y[train].max() else y[train].mean()
        assert got[v]["n_train"] == len(train) and got[v]["forecast"] == pytest.approx(want, rel=1e-6)
        seen += 1
    assert seen > 80
    # what follows an origin doesn't change its forecast
    early = {r["t"]: r["forecast"] for r in models.harq(both.where(F.col("t") <= 200 * DAY), DAY, 7).where("ticker = 'A'").collect()}
    assert all(got[v]["forecast"] == pytest.approx(f, rel=1e-9) for v, f in early.items() if f is not None)


def test_harq_leaves_no_forecast_outside_its_targets(spark):
    rows = days_of(200)
    rows[-1] = ("A", rows[-1][1], rows[-1][2] * 1e4, rows[-1][3])
    last = models.harq(spark.createDataFrame(rows, "ticker string, t long, rv double, rq double"), DAY).orderBy(F.desc("t")).first()
    y = [r[2] for r in rows]
    assert last["filtered"] and last["forecast"] == pytest.approx(sum(y[30:]) / len(y[30:]))


def test_realvol_rows(spark):
    rng = random.Random(1)
    r = [("A", h * HOUR, rng.gauss(0, 0.01)) for h in range(220 * 24)] + [("B", h * HOUR, 0.01) for h in range(24 * 219)] + [("C", h * HOUR, rng.gauss(0, 0.01)) for h in range(200 * 24, 220 * 24)]
    got = by_measure(risk.realvol(spark.createDataFrame(r, "ticker string, t long, r double")).collect(), "ticker_i")
    assert len(got) == 21 and all(got["A", m]["value"] > 0 for m in ("sigma_1d", "sigma_7d", "rv_sigma_1d", "vol_term", "qlike_harq", "qlike_naive", "qlike_mean30"))
    assert got["A", "sigma_1d"]["value"] == pytest.approx(0.01 * math.sqrt(24), rel=0.2) and got["A", "sigma_7d"]["value"] == pytest.approx(0.01 * math.sqrt(24 * 7), rel=0.2)
    assert got["B", "sigma_1d"]["absent"] == "the period to the asof is not whole" and got["C", "vol_term"]["absent"] == "20 whole periods, under 190"


def normal_pairs(n, rho_of, seed):
    rng, out = np.random.default_rng(seed), []
    for t in range(n):
        a, b, c = rng.standard_normal(3)
        rho = rho_of(t)
        out += [("A", t * DAY, float(a)), ("B", t * DAY, float(rho * a + math.sqrt(1 - rho * rho) * b)), ("C", t * DAY, float(c))]
    return out


def test_monitor_finds_the_change_and_its_date(spark):
    schema = "ticker string, t long, z double"
    moved = spark.createDataFrame(normal_pairs(900, lambda t: 0.7 if t < 600 else -0.5, 4), schema)
    rows = {(r["i"], r["j"]): r for r in models.correlation_monitor(moved, 500 * DAY, 899 * DAY, 4.0).collect()}
    hit = rows["A", "B"]
    assert hit["m"] == 500 and hit["ratio"] > 1 and abs(hit["change"] / DAY - 600) < 25 and hit["change"] <= hit["first"]
    assert rows["A", "C"]["ratio"] < 1 and rows["A", "C"]["first"] is None
    got = by_measure(risk.monitor(moved, DAY, 500, 4.0).collect(), "ticker_i", "ticker_j")
    assert got["*", None, "wied_galeano_alarm"]["value"] == 1 and abs(got["*", None, "change_at_micros"]["value"] / DAY - 600) < 25
    calm = by_measure(risk.monitor(spark.createDataFrame(normal_pairs(900, lambda t: 0.7, 4), schema), DAY, 500, 4.0).collect(), "ticker_i", "ticker_j")
    assert calm["*", None, "wied_galeano_alarm"]["value"] == 0 and calm["*", None, "change_at_micros"]["absent"] == "no alarm"
    none = by_measure(risk.monitor(moved.where(F.col("t") < 100 * DAY), DAY, 500, 1.5).collect(), "ticker_i", "ticker_j")
    assert none["*", None, "wied_galeano_ratio"]["absent"] == "no baseline, or nothing after it"


def test_constancy_against_numpy(spark):
    schema = "ticker string, t long, z double"
    rows = normal_pairs(400, lambda t: 0.5, 8)
    z = np.array([r[2] for r in rows]).reshape(-1, 3)
    s = (z.T @ z) / len(z)
    r = s / np.sqrt(np.outer(np.diag(s), np.diag(s)))
    e, q = np.linalg.eigh(r)
    u = z[100:] @ (q @ np.diag(e**-0.5) @ q.T)
    xs, ys = [], []
    for i, j in ((0, 1), (0, 2), (1, 2)):
        y = u[:, i] * u[:, j]
        xs.append(np.column_stack([np.ones(len(y) - 5), *[y[5 - k : -k] for k in range(1, 6)]]))
        ys.append(y[5:])
    x, y = np.vstack(xs), np.concatenate(ys)
    b = np.linalg.solve(x.T @ x, x.T @ y)
    v = ((y - x @ b) ** 2).sum() / (len(y) - 6)
    got = models.constancy(spark.createDataFrame(rows, schema), 100 * DAY).first()
    assert got["statistic"] == pytest.approx(b @ x.T @ x @ b / v, rel=1e-8) and got["n"] == 300 and got["p_value"] > 0.01
    moved = models.constancy(spark.createDataFrame(normal_pairs(400, lambda t: 0.8 if t < 200 else -0.8, 8), schema), 0).first()
    assert moved["p_value"] < 1e-6
    same = models.constancy(spark.createDataFrame([(k, t * DAY, 1.0 * (t % 3)) for t in range(50) for k in "AB"], schema), 0).first()
    assert same["statistic"] is None and same["reason"]


def test_derived_against_numpy(spark):
    rng = np.random.default_rng(2)
    r = rng.standard_normal((60, 4)) @ rng.standard_normal((4, 4)) * 0.01
    df = spark.createDataFrame([("ABCD"[k], t * DAY, float(r[t, k])) for t in range(60) for k in range(4)], "ticker string, t long, r double")
    got = by_measure(risk.derived(df).collect())
    w = 0.94 ** np.arange(60)[::-1]
    cov = lambda x, w: (x * w[:, None]).T @ x / w.sum()
    now, before = cov(r, w), cov(r[:-1], w[1:])
    d = r[-1] @ np.linalg.solve(before, r[-1])
    mag = np.mean(r[-1] ** 2 / np.diag(before))
    mu, s = r.mean(axis=0), np.cov(r.T)
    all_d = np.einsum("ti,ij,tj->t", r - mu, np.linalg.inv(s), r - mu)
    cor = now / np.sqrt(np.outer(np.diag(now), np.diag(now)))
    want = {"covariance_ar": np.linalg.eigvalsh(now)[-1] / np.trace(now), "correlation_ar": np.linalg.eigvalsh(cor)[-1] / 4, "mahalanobis": d, "magnitude_surprise": mag, "correlation_surprise": d / 4 / mag, "turbulence": all_d[-1], "percentile": (all_d <= all_d[-1]).mean(), "chi2_percentile": 1 - math.exp(-d / 2) * (1 + d / 2)}
    assert {m[0]: r["value"] for m, r in got.items()} == pytest.approx({k: float(v) for k, v in want.items()}, rel=1e-8)
    few = by_measure(risk.derived(df.where(F.col("t") < 4 * DAY)).collect())
    assert "cannot estimate" in few["turbulence",]["absent"] and few["mahalanobis",]["absent"] == "the covariance matrix is not positive definite"


def brute_rho(a, b, lag):
    iv = lambda x: [(x[k - 1][0], x[k][0], x[k][1] - x[k - 1][1]) for k in range(1, len(x))]
    x, y = iv(a), iv(b)
    return sum(r * q for s, e, r in x for u, v, q in y if s + lag < v and u < e + lag) / math.sqrt(sum(r * r for *_, r in x) * sum(q * q for *_, q in y))


def test_lead_lag_finds_planted_lags_of_two_pairs(spark):
    rng = random.Random(2)
    step, n = 50_000, 8000
    path = [0.0]
    for _ in range(n):
        path.append(path[-1] + rng.gauss(0, 1e-4))
    at = lambda t: path[min(max(int(t // step), 0), n)]
    rows, raw = [], {}
    for name, lag, share in (("L", 0, 0.3), ("F1", 400_000, 0.15), ("F2", 1_000_000, 0.15), ("N", None, 0.15)):
        ticks = []
        for k in range(1, n):
            if rng.random() < share:
                t = k * step + rng.randrange(step)
                p = at(t - lag) if lag is not None else rng.gauss(0, 1e-3)
                ticks.append((t, p))
        raw[name] = ticks
        rows += [("v", name, t, math.exp(p) * 100 - 0.001, math.exp(p) * 100 + 0.001, 1.0, 1.0, i) for i, (t, p) in enumerate(ticks)]
    q = spark.createDataFrame(rows, "venue string, ticker string, t long, bid_px double, ask_px double, bid_sz double, ask_sz double, event_id long")
    got = by_measure(risk.lead_lag(q, "L").collect(), "ticker_j")
    assert got["F1", "lead_ms"]["value"] == 400 and got["F2", "lead_ms"]["value"] == 1000 and got["F1", "rho_lead"]["value"] > 0.3 and got["F1", "llr"]["value"] > 2
    assert got["N", "lead_ms"]["value"] == 0 and len(got) == 21
    c = {(r["follower"], r["lag_us"]): r["rho"] for r in leadlag.overlap_correlations(leadlag.ticks(q, HOUR), "L", [0, 400_000, -1_000_000, 30_000_000_000], 5_000_000).collect()}
    small = {k: [(t, math.log((100 * math.exp(p) - 0.001 + 100 * math.exp(p) + 0.001) / 2)) for t, p in v] for k, v in raw.items()}
    for lag in (0, 400_000, -1_000_000):
        assert c["F1", lag] == pytest.approx(brute_rho(small["L"], small["F1"], lag), abs=1e-9)
    assert c["F1", 30_000_000_000] == pytest.approx(0, abs=1e-12)
    few = by_measure(risk.lead_lag(q.where("event_id < 200"), "L").collect(), "ticker_j")
    assert few["F1", "lead_ms"]["absent"].startswith("L has 200 and F1 200")


def test_cascade_events(spark):
    rng = random.Random(6)
    rows, mark, oi = [], 100.0, 1e6
    for m in range(26 * 60):
        r, d = rng.gauss(0, 1e-4), rng.gauss(0, 1e-4)
        if m in (1500, 1502, 1505):  # two minutes with one gap are one event, the third begins another
            r, d = -0.02, -0.03
        if m == 1510:
            r, d = 0.02, -0.03
        if m == 1520:
            r, d = -0.02, -0.004  # too small a share of the open interest
        mark, oi = mark * math.exp(r), oi * math.exp(d)
        rows.append(("T", m * MIN, mark, oi, m))
    df = spark.createDataFrame(rows, "ticker string, t long, mark double, open_interest double, event_id long")
    got = by_measure(risk.cascade(df).where(F.col("asof_micros") == 26 * HOUR).collect())
    o = {m: (v, i) for _, t, v, i, m in rows}
    usd = lambda m: (o[m - 1][1] - o[m][1]) * o[m][0]
    assert got["cascade_events",]["value"] == 2 and got["liq_long_usd",]["value"] == pytest.approx(usd(1500) + usd(1502) + usd(1505)) and got["liq_short_usd",]["value"] == pytest.approx(usd(1510))
    assert got["largest_event_usd",]["value"] == pytest.approx(usd(1500) + usd(1502) + usd(1505)) and got["max_joint_z",]["value"] > 10 and 0 < got["liq_intensity",]["value"] < 1
    apart = by_measure(risk.cascade(df, gap=1).where(F.col("asof_micros") == 26 * HOUR).collect())
    assert apart["cascade_events",]["value"] == 3
    early = by_measure(risk.cascade(df).where(F.col("asof_micros") == 3 * HOUR).collect())
    assert early["cascade_events",]["absent"] == "119 consecutive steps in the trail, under 720"


def test_backtest_against_numpy(spark):
    rng = np.random.default_rng(5)
    n = 300
    var = rng.uniform(0.9, 1.4, n)
    r = rng.standard_normal(n) * 0.6
    m = spark.createDataFrame([("T", int(k), float(r[k]), float(var[k]), float(var[k] * 1.2)) for k in range(n)], "ticker string, asof long, r double, var double, es double")
    got = models.var_backtest(m, 0.025).first()
    hit = (r < -var).astype(float)
    x = np.column_stack([np.ones(n - 4), *[hit[4 - k : n - k] for k in range(1, 5)], var[4:]])
    y = hit[4:] - 0.025
    dq = y @ x @ np.linalg.solve(x.T @ x, x.T @ y) / (0.025 * 0.975)
    assert got["dq_p"] == pytest.approx(math.exp(-dq / 2) * (1 + dq / 2 + dq * dq / 8), rel=1e-6)
    assert got["hit_rate"] == hit.mean() and got["z2"] == pytest.approx((r * hit / (1.2 * var)).sum() / (n * 0.025) + 1)
    none = models.var_backtest(m.withColumn("var", F.lit(50.0)), 0.025).first()
    assert none["hit_rate"] == 0 and none["kupiec_p"] is None and none["dq_p"] is None and none["z2"] == 1
    days = m.withColumn("asof", F.col("asof") * DAY)
    tails = days.select("ticker", "asof", F.col("var").alias("var_975"), F.col("es").alias("es_975"), (F.col("var") * 1.3).alias("var_99"))
    rets = days.select("ticker", F.col("asof").alias("t"), "r")
    rows = by_measure(risk.backtest(tails, rets, days=400).collect())
    assert len(rows) == 9 and rows["n",]["value"] == n and rows["dq_p_975",]["value"] == pytest.approx(got["dq_p"])
    assert by_measure(risk.backtest(tails, rets).collect())["n",]["absent"] == "90 forecasts matched with their bar in the 90 days, under 250"
