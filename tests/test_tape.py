"""Record to tape, stores, ledger, checks and streaming, against values by hand."""

import hashlib
import hmac
import json
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketlake.functions import scalars as S
from marketlake.operators import aggs, dedupe, filters, joins, ledger, models, normalise, quality, windows
from marketlake.plans import catalog, signals
from marketlake.sources import maintenance, store
from marketlake.streaming import live

RECORD = "seq long, recv_micros long, venue string, kind string, channel string, symbol string, origin string, payload string"
DAY = 86_400_000_000


def payloads(spark):
    trade = [{"coin": "BTC", "side": "B", "px": "1.5", "sz": "2", "time": 1000, "tid": 1}, {"coin": "BTC", "side": "X", "px": "1", "sz": "2", "time": 1000, "tid": 2}]
    rows = [
        ("trades", json.dumps(trade)), ("trades", "{broken"), ("bbo", json.dumps({"coin": "BTC", "time": 5, "bbo": [{"px": "1", "sz": "2"}, None]})),
        ("candle", json.dumps({"t": 0, "T": 59, "s": "BTC", "i": "1m", "o": "1", "c": "2", "h": "3", "l": "0.5", "v": "9", "n": 1})), ("pong", "{}"), ("strange", "{}"),
        ("activeAssetCtx", json.dumps({"coin": "BTC", "ctx": {"markPx": "10", "funding": "0.0001"}})), ("l2Book", json.dumps({"coin": "BTC", "time": 7, "levels": [[{"px": "1", "sz": "0", "n": 1}], [{"px": "2", "sz": "3", "n": 1}]]})),
        ("trades", json.dumps([{"coin": "BTC", "side": "A", "px": "0.1234567890123456789", "sz": "1", "time": 1, "tid": 3}])),
    ]
    return spark.createDataFrame([(i, 60_000 + i + (DAY if i % 2 else 0), "stream", "raw", c, "BTC", "venue", p) for i, (c, p) in enumerate(rows)], RECORD)


def test_normalise(spark):
    out = normalise.normalise(payloads(spark), "stream")
    assert [(r["aggressor"], r["price"], r["trade_id"], r["at_micros"]) for r in out["trades"].collect()] == [("bid", Decimal("1.5"), 1, 1_000_000)]
    q = out["quotes"].first()
    assert q["bid_px"] == 1 and q["ask_px"] is None
    assert out["candles"].first()["is_final"] and out["marks"].first()["mark"] == 10 and out["marks"].first()["at_micros"] is None
    assert not out["funding"].first()["settled"]
    assert {(r["side"], r["size"]) for r in out["book"].collect()} == {("bid", 0), ("ask", 3)}
    assert sorted(r["archive_seq"] for r in out["unparsed"].collect()) == [0, 1, 5, 8]


def test_chain_logs(spark):
    t = lambda a: "0x" + "0" * 24 + a * 40
    log = lambda topics, data="0x0f": {"address": "0xAA", "topics": topics, "data": data, "blockNumber": "0x10", "transactionHash": "0x1", "logIndex": "0x2"}
    page = [log([normalise.TRANSFER, t("1"), t("2")]), log([normalise.TRANSFER, t("0"), t("2")]), log([normalise.TRANSFER, t("1"), t("2"), t("3")]), {**log([normalise.TRANSFER, t("1"), t("2")]), "address": "0xBB"}]
    rec = spark.createDataFrame([(1, 1, "c", "raw", "logs", None, "venue", json.dumps(page))], RECORD)
    moved, mints, bad = normalise.chain_logs(rec, spark.createDataFrame([("0xaa", "T", 1)], "address string, ticker string, decimals int"))
    assert [(r["block"], r["amount"], r["from_address"][-1]) for r in moved.collect()] == [(16, 1.5, "1")]
    assert [r["kind"] for r in mints.collect()] == ["issue"] and bad.isEmpty()


def test_scalars(spark):
    key, a = "k", " 0xAbC "
    df = spark.range(1).select(
        S.date_of(F.lit(-1)).cast("string").alias("d"), S.midnight_of(F.lit("1970-01-02")).alias("m"), S.midnight_of(F.lit("1970-1-2")).alias("m0"), S.width_micros(F.lit("4h")).alias("w"), S.width_micros(F.lit("0m")).alias("w0"),
        S.exact_decimal(F.lit("1.0000000000000000001")).alias("x"), S.hex_word(F.lit("0x" + "f" * 25)).alias("h"), S.pseudonym(key, F.lit(a)).alias("p"), S.valid_token(F.lit("a b")).alias("v"),
        S.chi2_tail(F.lit(3.841458820694124), 1).alias("c1"), S.chi2_tail(F.lit(5.991464547107979), 2).alias("c2"), S.chi2_tail(F.lit(7.814727903251179), 3).alias("c3"), S.normal_cdf(F.lit(1.96)).alias("n"))
    r = df.first()
    assert (r["d"], r["m"], r["m0"], r["w"], r["w0"], r["x"], int(r["h"])) == ("1969-12-31", DAY, None, 4 * 3_600_000_000, None, None, 16**25 - 1)
    assert r["p"] == hmac.new(key.encode(), b"0xabc", hashlib.sha256).hexdigest()[:16] and not r["v"]
    assert all(r[c] == pytest.approx(0.05, abs=1e-5) for c in ("c1", "c2", "c3")) and r["n"] == pytest.approx(0.975, abs=1e-4)


def test_stores(spark, tmp_path):
    rec = payloads(spark)
    root = f"file://{tmp_path}/record"
    store.write_record(rec, root)
    back = store.read_record(spark, root, ["stream/raw"], 0, 60_003, ordered=True)
    assert [r["seq"] for r in back.collect()] == [0, 2]
    assert store.read_record(spark, root, [], 0, 1 << 50).isEmpty()
    maintenance.compact_closed_days(spark, root, "1970-01-02")
    assert spark.read.parquet(root).where("date < DATE'1970-01-02'").count() == 5
    assert maintenance.inventory(spark, root).agg(F.sum("n_rows")).first()[0] == 9
    trades = normalise.normalise(rec, "stream")["trades"]
    store.write_tape(trades, f"file://{tmp_path}/tape", "trades")
    assert store.read_tape(spark, f"file://{tmp_path}/tape", "trades", 0, 2_000_000, "BTC").count() == 1
    sig = spark.createDataFrame([("s", "1h", "m", "a", None, 1.0, None, 2.0, 5, 6, "r", None)], "signal string, horizon string, measure string, ticker_i string, ticker_j string, value double, absent string, n_eff double, asof_micros long, computed_micros long, run_id string, params string")
    assert store.commit_signals(sig, f"file://{tmp_path}/sig") == 1 and store.read_signals(spark, f"file://{tmp_path}/sig", 0, 10).count() == 1
    with pytest.raises(ValueError):
        store.commit_signals(sig.withColumn("absent", F.lit("why")), f"file://{tmp_path}/sig")


def test_replace_source_days(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    rows = lambda *x: spark.createDataFrame([(s, r * DAY, a * DAY, "T") for s, r, a in x], "seq long, recv_micros long, at_micros long, ticker string")
    store.replace_source_days(rows((1, 1, 0), (2, 2, 0), (3, 1, 1)), root, "v", "1970-01-02", "1970-01-04")
    store.replace_source_days(rows((4, 1, 0)), root, "v", "1970-01-02", "1970-01-03")
    assert sorted(r["seq"] for r in spark.read.parquet(root).collect()) == [2, 4]
    with pytest.raises(ValueError):
        store.replace_source_days(rows((5, 5, 5)), root, "v", "1970-01-02", "1970-01-03")


def test_import_verified(spark, tmp_path):
    page = json.dumps([{"t": 0, "T": 59_999, "s": "BTC", "i": "1m", "o": "1", "c": "2", "h": "3", "l": "0.5", "v": "9"}])
    (tmp_path / "a.json").write_text(page)
    (tmp_path / "other.json").write_text("not listed")
    entry = {"file": "a.json", "sha256": hashlib.sha256(page.encode()).hexdigest().upper(), "request": {"type": "candleSnapshot", "req": {"coin": "BTC", "interval": "1m"}}}
    took = lambda *pages, venue="stream": ((tmp_path / "manifest.json").write_text(json.dumps({"venue": venue, "pages": pages})), store.import_verified(spark, f"file://{tmp_path}", "stream", 90_000_000, 40))[1]
    rows = took(entry)
    assert [(r["seq"], r["symbol"], r["origin"]) for r in rows.collect()] == [(40, "BTC", "fetched")]
    bar = normalise.normalise(rows, "stream")["candles"].first()
    assert bar["close"] == 2 and bar["is_final"]
    for pages in ([], [entry, {**entry, "file": "b.json"}], [{**entry, "file": "../a.json"}], [{**entry, "file": ".a"}], [{**entry, "sha256": "0"}], [{**entry, "request": {"type": "fundingHistory"}}]):
        with pytest.raises(ValueError, match="refused"):
            took(*pages)
    with pytest.raises(ValueError, match="venue"):
        took(entry, venue="other")
    (tmp_path / "a.json").write_text(page + " ")
    with pytest.raises(ValueError, match="other bytes"):
        took(entry)


def test_ledger(spark):
    fills = [(1, "T", "bid", 10.0, 2.0), (2, "T", "bid", 20.0, 2.0), (3, "T", "ask", 30.0, 1.0), (4, "T", "ask", 30.0, 5.0), (5, "T", "bid", 25.0, 2.0), (6, "T", "bid", 1.0, 1.0)]
    df = spark.createDataFrame([("a", t, s, p, q, i, i, i) for i, t, s, p, q in fills], "account string, ticker string, side string, price double, size double, t long, order_id long, trade_id long")
    out = sorted(map(tuple, ledger.basis(ledger.positions(df)).collect()), key=lambda r: r[2])
    assert out[0][3:] == (5, 0.0, 0.0, 15.0 + 45.0 + 10.0) and out[1][3:] == (1, 1.0, 1.0, 0.0)
    stated = df.withColumn("start_position", F.when(F.col("t") == 3, 9.0).otherwise(F.expr("element_at(array(0.0, 2.0, 4.0, 3.0, -2.0, 0.0), int(t))")))
    assert {r["t"] for r in ledger.continuity_breaks(stated, 1e-6).collect()} == {3, 4}
    mid = df.where("t <= 3").withColumn("start_position", F.when(F.col("t") == 1, 5.0)).withColumn("side", F.lit("ask"))
    assert [r["position"] for r in ledger.positions(mid).orderBy("t").collect()] == [3.0, 1.0, 0.0]
    assert [(r["position"], r["basis"], r["realised"]) for r in ledger.basis(ledger.positions(mid.where("t = 1"))).collect()] == [(3.0, None, 0.0)]
    snap = spark.createDataFrame([("a", "T", 3, 3.0), ("a", "U", 3, 1.0)], "account string, ticker string, t long, stated double")
    assert {(r["ticker"], r["agrees"]) for r in ledger.snapshot_checks(ledger.positions(df), snap, 1e-9).collect()} == {("T", True), ("U", False)}


def test_windows_do_not_depend_on_buckets(spark):
    q = spark.createDataFrame([("T", i * 7, i) for i in range(50)], "ticker string, t long, event_id long").withColumn("v", F.col("event_id"))
    l = spark.createDataFrame([("T", i * 5, i) for i in range(80)], "ticker string, t long, id long")
    a, b = (sorted(map(tuple, joins.asof_join(l, q, ["ticker"], ["v"], bucket_us=w, tolerance_us=30).select("id", "v").collect())) for w in (11, 10**9))
    assert a == b and a[3] == (3, 2)
    x, y = (sorted(map(tuple, windows.with_next(q, ["ticker"], ["event_id"], w).select("t", "next_t").collect()), key=str) for w in (11, 10**9))
    assert x == y


def test_filters_and_quality(spark):
    df = spark.createDataFrame([("v", 1, 5, "a"), ("v", None, 9, None), ("w", 7, 1, "a")], "venue string, at_micros long, stream_seq long, ticker string")
    assert filters.in_window(df, 0, 5).count() == 2 and filters.in_window(df, 0, 5, "a").count() == 1
    with pytest.raises(ValueError):
        filters.in_window(df, 5, 0)
    bars = spark.createDataFrame([("1h", h * 3_600_000_000, (h + 2) * 3_600_000_000, True) for h in range(3)], "interval string, at_micros long, recv_micros long, is_final boolean")
    assert [r["at_micros"] for r in filters.closing_bars(bars, 3_600_000_000, 1_800_000_000, 9 * 3_600_000_000).orderBy("at_micros").collect()] == [3_600_000_000, 7_200_000_000]
    assert filters.apply_bound(df, spark.createDataFrame([("v", 5)], "venue string, bound long")).count() == 1
    opens = spark.range(1).select(*[filters.external(F.lit(x * 3_600_000_000)).alias(n) for n, x in (("sat", 2 * 24 + 12), ("wed", 6 * 24 + 15), ("brk", 6 * 24 + 22))]).first()
    assert (opens["sat"], opens["wed"], opens["brk"]) == (False, True, False)
    assert dedupe.missing(df.select("venue"), df.where("venue = 'v'"), ["venue"]).count() == 1
    assert quality.verdict(df.limit(0), 0) == "nothing checked" and quality.verdict(df.limit(0), 3) == "clean"
    tape = spark.createDataFrame([("1970-01-01", None, DAY), ("1970-01-01", 3, DAY)], "date string, at_micros long, recv_micros long")
    assert [r["expected"] for r in quality.misfiled_rows(tape).collect()] == ["1970-01-02"]
    nested = spark.createDataFrame([("p", "v", "a", 1, 9), ("p", "v", "b", 2, 5), ("p", "v", "c", 2, 12), ("p", "v", "d", 2, 12), ("q", "v", "e", 3, 4)], "partition string, venue string, file string, first long, last long")
    assert sorted((r["file"], r["wide"]) for r in quality.nested_files(nested).collect()) == [("b", "d"), ("d", "c")]
    kept = spark.createDataFrame([("b", 2), ("b", 5), ("c", 2), ("c", 12), ("d", 2), ("d", 12)], "file string, seq long")
    assert {r["file"]: r["missing"] for r in quality.nested_rows(quality.nested_files(nested), kept, ["seq"]).collect()} == {"b": 1, "d": 0}


def test_streaming_equals_batch(spark, tmp_path):
    rec = payloads(spark)
    rec.repartition(3).write.parquet(f"file://{tmp_path}/in")
    got = {}
    q = live.stream_normalise(live.stream_record(spark, f"file://{tmp_path}/in", RECORD, 1), "stream", lambda k, df: got.setdefault(k, []).extend(df.collect()), f"file://{tmp_path}/ck")
    q.awaitTermination(120)
    for kind, df in normalise.normalise(rec, "stream").items():
        assert sorted(map(str, got[kind])) == sorted(map(str, df.collect()))


def test_gaps_and_reorgs(spark):
    msgs = spark.createDataFrame([("v", "T", "trades", 5), ("v", "T", "trades", 50), ("v", "U", "trades", 2 * DAY)], "venue string, ticker string, series string, recv_micros long")
    loss = spark.createDataFrame([("v", DAY, DAY + 9, "restart")], "venue string, from_us long, to_us long, cause string")
    assert [(r["ticker"], r["from_us"]) for r in live.coverage_gaps(msgs, loss).collect()] == [("T", 50)]
    twice = loss.unionByName(spark.createDataFrame([("v", DAY + 20, DAY + 40, "restart")], loss.schema))
    assert sorted((r["from_us"], r["to_us"]) for r in live.coverage_gaps(msgs, twice).collect()) == [(50, DAY + 9), (DAY + 9, DAY + 40)]
    blocks = spark.createDataFrame([("v", 1, "A", "0", 1), ("v", 2, "B", "a", 2), ("v", 3, "C", "B", 3), ("v", 2, "X", "Y", 4)], "venue string, height long, hash string, parent string, seq long")
    assert [tuple(r) for r in live.detect_reorgs(blocks).collect()] == [("v", 4, 1, 3, "A", "Y")]
    st = live.pair_status(msgs, spark.createDataFrame([("T", "trades"), ("Z", "trades")], "ticker string, series string"), 100, 60)
    assert {(r["ticker"], r["state"]) for r in st.collect()} == {("T", "live"), ("Z", "never heard")}


def test_backtests(spark):
    m = spark.createDataFrame([("T", i, -2.0 if i % 40 == 0 else 0.1, 1.0, 1.2) for i in range(400)], "ticker string, asof long, r double, var double, es double")
    r = models.var_backtest(m, 0.025).first()
    assert r["hit_rate"] == 0.025 and r["kupiec_p"] == pytest.approx(1, abs=1e-3) and r["z2"] == pytest.approx(1 - 2.0 / 1.2)


@pytest.mark.parametrize("name", ["premium_twa", "reorg_standing", "trades_once", "record_trades", "record_unparsed", "closing_bars", "coverage_gaps", "ledger_positions", "ledger_basis", "stored_compaction", "scalar_helpers"])
def test_queries_agree_with_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem", "nation"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.execute(catalog.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, sf).toPandas()[list(want.columns)]
    key = list(want.columns)
    assert len(got) == len(want)
    a, b = (d.fillna(-1).sort_values(key, ignore_index=True) for d in (got, want))
    assert (a.values == b.values).mean() > 0.999


def test_account_funding(spark):
    page = [{"time": 5, "hash": "0x", "delta": {"type": "funding", "coin": "xyz:GOLD", "usdc": "-1.25", "szi": "3", "fundingRate": "0.0000125", "nSamples": 24}}, {"time": 6, "delta": {"coin": "BTC", "usdc": "0.5", "szi": "-1", "fundingRate": "-0.1"}}]
    rows = [(i, 7, "v", "raw", "userFunding", "a", "venue", p) for i, p in enumerate((json.dumps(page), "{broken", "[]", None))]
    good, bad = normalise.account_funding(spark.createDataFrame(rows, RECORD))
    assert [(r["dex"], r["ticker"], r["usdc"], r["samples"], r["at_micros"]) for r in good.orderBy("at_micros").collect()] == [("xyz", "GOLD", Decimal("-1.25"), 24, 5000), ("", "BTC", Decimal("0.5"), None, 6000)]
    assert {r["archive_seq"] for r in bad.collect()} >= {1, 3}


def test_derive_names_the_thinner_instrument(spark):
    rows = [("A", k * DAY, 0.01 * (-1) ** k) for k in range(6)] + [("B", k * DAY, 0.02 * (-1) ** k) for k in range(4)] + [("C", 90 * DAY, 0.1)]
    got = {(r["measure"], r["ticker_i"], r["ticker_j"]): r for r in signals.derive(spark.createDataFrame(rows, "ticker string, t long, r double"), DAY, 4, reference="A").collect()}
    assert got["beta", "B", "A"]["value"] == pytest.approx(2) and got["correlation", "A", "B"]["value"] == pytest.approx(1)
    assert got["correlation", "A", "C"]["absent"] == "C has 0 of 4 observations" == got["beta", "C", "A"]["absent"]
    assert got["volatility", "C", None]["absent"] == "C has 1 of 4 observations"


def test_queries_without_the_optional_folders(tmp_path):
    """The entry works where the training-data operators are gone, with and without their pipeline's file."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parents[1]
    shutil.copytree(root / "marketlake", tmp_path / "marketlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("from marketlake.llm import mixing\n")
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 100 and 'pipeline' not in q and not any(k.startswith('op') and k[2].isdigit() for k in q) and set(o) <= set(q)"
    for _ in range(2):
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_ledger_updates_of_odd_rows(spark):
    """A transfer to oneself moves both dexes, spot is no margin, unknown types stay unknown, a broken number is a dead letter."""
    from pyspark.sql import functions as F

    from marketlake.functions.scalars import pseudonym
    from marketlake.operators import normalise

    send = '[{"time": 5, "delta": {"type": "send", "token": "%s", "amount": "2.5", "user": "0xA", "destination": "%s", "sourceDex": "spot", "destinationDex": "x"}}]'
    payloads = [send % ("USDC", "0xa"), send % ("USDC", "0xb"), send % ("HYP", "0xb"), '[{"time": 5, "delta": {"type": "new"}}]', '[{"time": 5, "delta": {"type": "deposit", "usdc": "1e"}}]', '[{"time": 5, "delta": {"type": "deposit"}}]', "{"]
    rows = spark.createDataFrame([(i, 0, "v", "c", "s", "o", p) for i, p in enumerate(payloads)], "seq long, recv_micros long, venue string, channel string, symbol string, origin string, payload string")
    good, bad = normalise.ledger_updates(rows, "k", pseudonym("k", F.lit("0xa")))
    got = {r["seq"]: (None if r["effects"] is None else [(e["dex"], float(e["usdc"])) for e in r["effects"]], r["counterparty"] is None, r["token"]) for r in good.collect()}
    assert got == {0: ([("x", 2.5)], True, None), 1: ([], False, None), 2: ([], False, "HYP"), 3: (None, True, None), 5: (None, True, None)}
    assert {r["archive_seq"] for r in bad.collect()} == {4, 6}


def test_frontier_and_shares(spark):
    from marketlake.operators import filters

    tape = spark.createDataFrame([("a", "2024-01-01", 99), ("a", "2024-01-02", 5), ("a", "2024-01-03", 7), ("b", "2024-01-01", 6)], "kind string, date string, recv_micros long")
    of = lambda *kinds: filters.frontier(tape, list(kinds)).first()[0]
    assert (of("a"), of("a", "b"), of("a", "c")) == (7, 6, None)
    saturday = 1_704_542_400_000_000  # 2024-01-06 12:00 UTC
    spans = spark.createDataFrame([(saturday, saturday + 30), (saturday, saturday), (None, 5), (saturday, saturday), (saturday + 129_600_000_000 - 90_000_000, saturday + 129_600_000_000)], "start_us long, end_us long")
    assert [r["external_share"] for r in filters.external_shares(spans).collect()] == [0.0, None, None, None, 1.0]
