"""Keyed streaming state against the table form: shuffled micro-batches, restarts, and the steps by hand."""

import random

from pyspark.sql import functions as F

from marketlake.operators import ledger
from marketlake.plans import record_catalog
from marketlake.streaming import live, ordered

BLOCK = "venue string, height long, hash string, parent string, at_us long, seq long"
EVENT = "venue string, ticker string, series string, at_us long, seq long, what string, to_us long, cause string"
SECOND = 1_000_000


def fold(step, rows):
    own, out = None, []
    for r in rows:
        own, made = step(own, r)
        out += made
    return out


def block(n, h, p, seq=0):
    return {"venue": "v", "height": n, "hash": h, "parent": p, "seq": seq, "at_us": seq}


def test_trail_forgets_replaced_heights():
    step = ordered.reorg_step(100)
    linked = [block(1, "a1", "a0"), block(2, "a2", "A1"), block(3, "a3", "a2"), block(4, "a4", "a3")]
    assert fold(step, linked) == []
    # a block on another 2 is one reorganisation from 2 to the tip; 4's successor then links to nothing
    forked = [*linked, block(3, "b3", "b2", 5), block(5, "a5", "a4", 6)]
    assert fold(step, forked) == [("v", 5, 2, 4, "a2", "b2")]
    assert fold(step, [*linked, block(3, "b3", "b2"), block(4, "b4", "b3")]) == [("v", 0, 2, 4, "a2", "b2")]
    assert fold(step, [block(7, "x", "y"), block(9, "z", "w")]) == []
    # beyond the depth nothing is held
    assert fold(ordered.reorg_step(2), [*linked, block(2, "c2", "other")]) == []


def event(at, what, to_us=None, cause=None):
    return {"venue": "v", "ticker": "T", "series": "s", "at_us": at, "what": what, "to_us": to_us, "cause": cause}


def test_gap_steps():
    g = lambda *rows: [(r[3], r[4], r[5]) for r in fold(ordered.gap_step, rows)]
    assert g(event(5, "loss", 9, "x")) == []
    assert g(event(5, "message"), event(90, "message")) == []
    # dated from the pair's own last moment; a second loss begins where the first gap ended
    assert g(event(5, "message"), event(8, "loss", 10, "x"), event(12, "loss", 20, "y")) == [(5, 10, "x"), (10, 20, "y")]
    # the tail of an open gap up to the moment of asking, once, with its cause; not when something was covered since
    assert g(event(5, "message"), event(8, "loss", 10, "x"), event(15, "asked"), event(16, "asked"), event(20, "loss", 30, "y")) == [(5, 10, "x"), (10, 15, "x"), (15, 30, "y")]
    assert g(event(5, "message"), event(8, "loss", 10, "x"), event(11, "message"), event(15, "asked")) == [(5, 10, "x")]


def run(stream, out, kept):
    q = stream.writeStream.format("parquet").option("checkpointLocation", kept).trigger(availableNow=True).start(out)
    q.awaitTermination(300)


def shuffled(spark, rows, schema, at, parts, rng):
    rng.shuffle(rows)
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], schema).coalesce(1).write.mode("append").parquet(at)


def test_streams_equal_tables_over_a_restart(spark, tmp_path):
    rng = random.Random(9)
    at, out, kept = (f"file://{tmp_path}/{x}" for x in ("in", "out", "kept"))
    blocks, chain = [], {}
    for v in ("a", "b"):
        height = 10
        for seq in range(150):
            height = max(1, height - rng.choice((1, 2, 3))) if rng.random() < 0.15 else height + 1
            h = f"{v}{seq}"
            parent = chain.get((v, height - 1), "none") if rng.random() < 0.9 else "other"
            chain[v, height] = h
            blocks.append((v, height, h, parent, (seq + 1) * SECOND, seq))
    df = spark.createDataFrame(blocks, BLOCK)
    want = sorted(map(tuple, live.detect_reorgs(df, 20).collect()))
    assert len(want) > 10
    early, late = [b for b in blocks if b[5] < 80], [b for b in blocks if b[5] >= 80]
    stream = lambda: live.stream_reorgs(spark.readStream.schema(BLOCK).option("maxFilesPerTrigger", 1).parquet(at), 20, "200 seconds")
    shuffled(spark, early, BLOCK, at, 4, rng)
    run(stream(), out, kept)
    # the query stops; a new one goes on from the checkpoint
    shuffled(spark, late, BLOCK, at, 4, rng)
    spark.createDataFrame([(v, -10, "end", "", 10_000 * SECOND, 10**9) for v in "ab"], BLOCK).coalesce(1).write.mode("append").parquet(at)
    run(stream(), out, kept)
    assert sorted(map(tuple, spark.read.parquet(out).select("venue", "seq", "from_block", "to_block", "old_hash", "new_hash").collect())) == want


def test_streamed_gaps_equal_table(spark, tmp_path):
    rng = random.Random(4)
    at, out, kept = (f"file://{tmp_path}/{x}" for x in ("in", "out", "kept"))
    msgs = [("v", t, "trades", rng.randrange(1, 4000) * SECOND) for t in "ABC" for _ in range(40)]
    losses = [("v", k * 500 * SECOND, k * 500 * SECOND + 60 * SECOND, "restart") for k in range(1, 8)]
    m = spark.createDataFrame(msgs, "venue string, ticker string, series string, recv_micros long")
    l = spark.createDataFrame(losses, "venue string, from_us long, to_us long, cause string")
    want = sorted(map(tuple, live.coverage_gaps(m, l).collect()))
    pairs = m.select("venue", "ticker", "series").distinct()
    control = ordered.controls(pairs, l.select("venue", F.col("from_us").alias("at_us"), F.lit(10**6).cast("long").alias("seq"), F.lit("loss").alias("what"), "to_us", "cause"))
    rows = [(v, t, s, u, i, "message", None, None) for i, (v, t, s, u) in enumerate(msgs)] + [tuple(r) for r in control.select("venue", "ticker", "series", "at_us", "seq", "what", "to_us", "cause").collect()]
    shuffled(spark, rows, EVENT, at, 5, rng)
    spark.createDataFrame([("v", t, "trades", 10**6 * SECOND, 0, "message", None, None) for t in "ABC"], EVENT).coalesce(1).write.mode("append").parquet(at)
    run(live.stream_gaps(spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(at), "10000 seconds"), out, kept)
    assert sorted(map(tuple, spark.read.parquet(out).select("venue", "ticker", "series", "from_us", "to_us", "cause").collect())) == want and want


def test_history_and_poison(spark):
    f = spark.createDataFrame([("a", 200), ("b", 100), ("c", 100)], "account string, t long")
    p = spark.createDataFrame([("a", 100), ("b", 200), ("d", 100)], "account string, t long")
    assert {r["account"]: r["reach"] for r in ledger.history_reach(f, p).collect()} == {"a": "lost", "b": "consistent", "c": "consistent", "d": "lost"}
    pages = spark.createDataFrame([("a", 1, t) for t in (50, 60)] + [("a", 2, t) for t in (20, 60)] + [("a", 3, 90)], "account string, page int, t long")
    held = spark.createDataFrame([("a", 30)], "account string, newest long")
    assert [r["page"] for r in ledger.beyond_reach(pages, held, 2).collect()] == [1]
    fills = spark.createDataFrame([("a", "T", "bid", 1.0, 2.0, k, k, k) for k in range(4)] + [("a", "T", "bid", 0.0, 2.0, 4, 4, 4)] + [("a", "T", "bid", 1.0, 2.0, k, k, k) for k in (5, 6)], "account string, ticker string, side string, size double, price double, t long, order_id long, trade_id long")
    assert ledger.poisoned(fills).first()["not_applied"] == 2
    assert [r["position"] for r in ledger.sound_positions(fills).orderBy("t").collect()] == [1, 2, 3, 4, None, None, None]
    fees = ledger.fees_and_funding(f.withColumn("fee", F.lit(1.0)), p.withColumn("usdc", F.lit(2.0)))
    assert {r["account"]: (r["fees"], r["funding"]) for r in fees.collect()} == {"a": (1, 2), "b": (1, 2), "c": (1, None), "d": (None, 2)}


def test_streamed_chain_is_whole_past_the_delay(spark, tmp_path):
    """100,000 blocks of a second each reach past the day that the stream waits for late rows; none is left out."""
    spark.range(100_000).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    rows = lambda q: sorted(map(tuple, q(spark, str(tmp_path)).select("seq", "from_block", "to_block", "old_hash", "new_hash").collect()))
    assert rows(record_catalog.reorgs_streamed) == rows(record_catalog.reorgs_detected)
