"""Account snapshots, instruments of contracts and declared horizons, against values by hand."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.functions.scalars import shifted_decimal
from marketlake.operators import normalise, snapshots
from marketlake.plans import account_catalog, declared

RECORD = "seq long, recv_micros long, venue string, channel string, symbol string, origin string, payload string"


def record(spark, payloads, symbol="0xAA"):
    return spark.createDataFrame([(i, 1000 + i, "v", "c", symbol, "venue", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], RECORD)


def snapshot(mode="default", positions=(), **state):
    return {"dex": "", "mode": None if mode is None else {"answer": mode}, "clearinghouseState": {"time": 7, "marginSummary": {"accountValue": "12.5"}, "assetPositions": [{"position": p} for p in positions], **state}}


def test_account_snapshots(spark):
    held = {"coin": "xyz:GOLD", "szi": "-2", "leverage": {"type": "cross", "value": 25}, "maxLeverage": 50, "cumFunding": {"allTime": "0.5"}}
    payloads = [snapshot("unifiedAccount", [held, {"coin": "BTC", "szi": "1"}]), snapshot(None), snapshot("default"), snapshot("novel"), snapshot(positions=[held, {"coin": "BTC", "szi": "many"}]), snapshot(positions=[{"coin": "xyz:", "szi": "1"}]), "{broken", snapshot(withdrawable="x")]
    margin, positions, bad = snapshots.account_snapshots(record(spark, payloads))
    got = {r["seq"]: r for r in margin.collect()}
    assert {k: r["mode"] for k, r in got.items()} == {0: "unified", 1: "unknown", 2: "default", 3: "unknown"}
    assert got[2]["equity_not_held"] is None and "unifiedAccount" in got[0]["equity_not_held"] and got[3]["equity_not_held"] == "account mode unknown"
    assert got[0]["account_value"] == Decimal("12.5") and got[0]["withdrawable"] is None and got[0]["dex"] is None and got[0]["at_micros"] == 7000
    p = {r["ticker"]: r for r in positions.collect()}
    assert set(p) == {"GOLD", "BTC"} and p["GOLD"]["leverage"] == 25 and p["GOLD"]["size"] == -2 and p["GOLD"]["max_leverage"] == 50
    assert p["GOLD"]["funding_all_time"] == Decimal("0.5") and p["GOLD"]["mark"] is None and p["BTC"]["leverage_type"] is None
    # a snapshot with one unsound number or position gives no rows at all
    assert sorted(r["archive_seq"] for r in bad.collect()) == [4, 5, 6, 7]


def test_instruments(spark):
    word = lambda n: f"{n:064x}"
    text = "0x" + word(32) + word(3) + "414243" + "0" * 58
    answers = [{"symbol": text, "decimals": "0x" + word(6), "uiMultiplier": "0x" + word(15 * 10**17)}, {"symbol": None, "decimals": None, "uiMultiplier": None}, {"symbol": "0x41", "decimals": "0x", "uiMultiplier": "0x" + word(0)}, "{broken", {"symbol": text[:-60], "decimals": "0x" + word(30), "uiMultiplier": "0x"}]
    known = spark.createDataFrame([("0xaa", "T", 2)], "address string, ticker string, decimals int")
    out, bad = snapshots.instruments(record(spark, answers), known)
    got = {r["seq"]: (r["base"], r["tick_size"], r["active"], r["ui_multiplier"]) for r in out.collect()}
    assert got[0] == ("ABC", Decimal("0.000001"), True, Decimal("1.5"))
    assert got[1] == ("T", Decimal("0.01"), False, None)  # nothing answered: declared decimals, never a multiplier of 1
    assert got[2] == ("T", Decimal("0.01"), True, Decimal(0))
    assert got[4] == ("T", Decimal("1e-18"), True, None)
    assert [r["archive_seq"] for r in bad.collect()] == [3]
    assert snapshots.instruments(record(spark, answers[:1], "0xBB"), known)[0].isEmpty()


def test_instruments_of_large_keys(spark, tmp_path):
    """A key times 10^15 passes a long from 9,224 on."""
    keys = [2, 6, 9223, 9226, 19_998, 1_199_998]
    spark.createDataFrame([(k, f"part {k}") for k in keys], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["seq"]: r["ui_multiplier"] for r in account_catalog.chain_instruments(spark, str(tmp_path)).collect()}
    assert got == {2: 0.002, 6: 0.006, 9223: 0.0, 9226: 9.226, 19_998: 19.998, 1_199_998: 1199.998}


@pytest.mark.parametrize("whole, places, want", [("1", 18, "0.000000000000000001"), ("1500", 2, "15"), ("0", 5, "0"), ("123", 0, "123"), ("1" + "0" * 30, 30, "1"), ("1", 19, None), ("1" * 38, 0, None)])
def test_shifted_decimal(spark, whole, places, want):
    got = spark.range(1).select(shifted_decimal(F.lit(whole).cast("decimal(38,0)"), F.lit(places)).alias("v")).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_amounts_that_do_not_fit_are_dead_letters(spark):
    topic = lambda c: "0x" + "0" * 24 + c * 40
    log = lambda data: {"address": "0xAA", "topics": [normalise.TRANSFER, topic("1"), topic("2")], "data": data, "blockNumber": "0x10", "transactionHash": "0x1", "logIndex": "0x2"}
    known = spark.createDataFrame([("0xaa", "T", 18)], "address string, ticker string, decimals int")
    moved, _, bad = normalise.chain_logs(record(spark, [[log("0x1")], [log("0x" + "f" * 60)]]), known)
    assert [(r["seq"], r["amount"]) for r in moved.collect()] == [(0, Decimal("1e-18"))]
    assert [(r["archive_seq"], r["channel"]) for r in bad.collect()] == [(1, "logs")]


def test_declared(spark, tmp_path):
    file = tmp_path / "signals.toml"
    file.write_text('[varcov.1d]\nbars = "1d"\ncorr = "ewma"\nlam = 0.9\n[carry]\nbaseline = { main = 0.5, xyz = 0.25 }\ndex = { xyz = ["GOLD"] }\n')
    horizons, base = declared.load(str(file))
    assert horizons == [declared.Horizon("1d", "1d", "ewma", lam=0.9)]
    got = spark.createDataFrame([("GOLD",), ("BTC",)], "ticker string").select(base.rate(F.col("ticker")), base.dex(F.col("ticker"))).collect()
    assert [tuple(r) for r in got] == [(0.25, "xyz"), (0.5, "main")]
    for table in ({"1d": {"bars": "1d", "corr": "ewma", "lamda": 1}}, {"2d": {"bars": "1d", "corr": "ewma"}}, {"1d": {"bars": "1d", "corr": "other"}}, {"1d": {"corr": "ewma"}}):
        with pytest.raises(ValueError):
            declared.horizons(table)
    for table in ({"baseline": {"xyz": 1.0}}, {"baseline": {"main": 1.0}, "dex": {"xyz": ["A"]}}, {"baseline": {"main": 1.0}, "more": 1}):
        with pytest.raises(ValueError):
            declared.baselines(table)
