"""Inventory from footers, retention, and compaction with a swap that survives a crash at every step."""

import random

import pytest
from pyspark.sql import functions as F

from marketlake.sources import maintenance as m

DAY, HOUR = 86_400_000_000, 3_600_000_000
SCHEMA = "seq long, recv_micros long, venue string, kind string, date date, payload string"


class Crash(Exception):
    pass


def fill(spark, root, files=6, days=3):
    rng = random.Random(1)
    rows = [(i, rng.randrange(days * DAY), "ab"[i % 2], "raw", None, f"p{i}" if i % 9 else None) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("date", F.timestamp_micros("recv_micros").cast("date"))
    for k in range(files):
        df.where(F.col("seq") % files == k).coalesce(1).write.mode("append").partitionBy("venue", "kind", "date").parquet(root)
    return df


def rows_of(spark, root):
    return sorted(tuple(r) for r in spark.read.parquet(root).select("seq", "recv_micros", "venue", "date", "payload").collect())


def n_files(spark, root):
    return {r["partition"]: r["n"] for r in m.listing(spark, root).groupBy("partition").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_inventory_from_footers(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    df = fill(spark, root)
    a, b = m.inventory(spark, root), m.inventory_by_rows(spark, root)
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())) and a.count() == 18
    got = {(r["venue"], str(r["date"])): (r["n"], r["lo"], r["hi"]) for r in a.groupBy("venue", "date").agg(F.sum("n_rows").alias("n"), F.min("recv_first").alias("lo"), F.max("recv_last").alias("hi")).collect()}
    want = {(r["venue"], str(r["date"])): (r["n"], r["lo"], r["hi"]) for r in df.groupBy("venue", "date").agg(F.count("seq").alias("n"), F.min("recv_micros").alias("lo"), F.max("recv_micros").alias("hi")).collect()}
    assert got == want


def test_retention_reports_what_it_does_not_know(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    fill(spark, root, 2)
    (tmp_path / "r" / "stray").mkdir()
    (tmp_path / "r" / "stray" / "notes.txt").write_text("x")
    (tmp_path / "r" / "venue=a" / "kind=raw" / "date=someday").mkdir()
    (tmp_path / "r" / "venue=a" / "kind=raw" / "date=someday" / "f.parquet").write_text("x")
    got = {r["subject"].rsplit("/r/", 1)[-1]: r["verdict"] for r in m.retention(m.listing(spark, root), {"b": 1}, 3 * DAY).collect()}
    assert got["stray/notes.txt"] == got["venue=a/kind=raw/date=someday/f.parquet"] == "unrecognised"
    assert {k: v for k, v in got.items() if k.startswith("b/")} == {"b/raw/1970-01-01": "expired", "b/raw/1970-01-02": "expired", "b/raw/1970-01-03": "kept"}
    assert {v for k, v in got.items() if k.startswith("a/")} == {"undeclared"}
    none = {r["verdict"] for r in m.retention(m.listing(spark, root).where("recognised"), {}, 300 * DAY).collect()}
    assert none == {"undeclared"}


def test_compaction_swaps_in_place(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    fill(spark, root)
    before, files = rows_of(spark, root), n_files(spark, root)
    assert m.compact_closed_days(spark, root, "1970-01-03", 10_000) == {"files_before": 12, "files_after": 4}
    assert rows_of(spark, root) == before
    after = n_files(spark, root)
    assert all(after[p] == (1 if not p.endswith("-03") else files[p]) for p in files)
    assert m.compact_closed_days(spark, root, "1970-01-03", 10_000) == {"files_before": 0, "files_after": 0}
    # a partition of several files by its rows
    fill(spark, root)
    m.compact_closed_days(spark, root, "1970-01-03", 100)
    assert rows_of(spark, root) == sorted(before + before) and all(v in (2, 3) for p, v in n_files(spark, root).items() if not p.endswith("-03"))


def test_closed_hours(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    rows = [(i, i * 60_000_000, "a", "raw", None, "p") for i in range(240)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("date", F.lit("1970-01-01").cast("date"))
    for k in range(12):
        df.where((F.col("seq") >= 20 * k) & (F.col("seq") < 20 * k + 20)).coalesce(1).write.mode("append").partitionBy("venue", "kind", "date").parquet(root)
    before = rows_of(spark, root)
    assert m.compact_closed_hours(spark, root, "1970-01-01", 2 * HOUR + HOUR // 2) == {"files_before": 6, "files_after": 2}
    assert rows_of(spark, root) == before and n_files(spark, root) == {"a/raw/1970-01-01": 8}
    assert m.compact_closed_hours(spark, root, "1970-01-02", 9 * HOUR)["files_before"] == 0


@pytest.mark.parametrize("at", [0, 1, 2, 5, 9])
def test_a_killed_swap_is_finished_or_undone(spark, tmp_path, at):
    root = f"file://{tmp_path}/r"
    fill(spark, root, 3, 2)
    before, left = rows_of(spark, root), [at]

    def stop(step):
        left[0] -= 1
        if left[0] < 0:
            raise Crash(step)

    with pytest.raises(Crash):
        m.compact(spark, root, m.closed_day_sets(m.inventory(spark, root), "1970-01-09", 10_000), stop)
    # rows may be there twice in between, never too few
    assert set(rows_of(spark, root)) == set(before)
    assert m.recover(spark, root) == ("undone" if at == 0 else "finished") and m.recover(spark, root) == "clean"
    assert rows_of(spark, root) == before
    assert set(n_files(spark, root).values()) == {3 if at == 0 else 1}
    m.compact_closed_days(spark, root, "1970-01-09", 10_000)
    assert rows_of(spark, root) == before and set(n_files(spark, root).values()) == {1}
