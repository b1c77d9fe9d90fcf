"""Ordering operators against plain Python, with bunched and sparse data."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dirsync.operators import ordering as O
from dirsync.operators.reports import event_digest


def runs_of(spark, seed, n=200):
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    stamps = sorted(rnd.sample(range(0, 60 * 24 * 40), n))
    rows = [(f"r{i:04d}", start + timedelta(minutes=m), rnd.choice([0, 10, 20, 21, 22]), rnd.choice("aaaab")) for i, m in enumerate(stamps)]
    return rows, spark.createDataFrame(rows, "run_id string, ts timestamp, count long, series string")


def test_lag_over_parts(spark):
    rows, df = runs_of(spark, 1)
    got = {r.run_id: r.previous for r in O.with_previous(df, "count", "previous").collect()}
    want = {r[0]: (rows[i - 1][2] if i else None) for i, r in enumerate(rows)}
    assert got == want


def test_change_reasons(spark):
    start = datetime(2024, 1, 1)
    counts = [100, 100, 103, 110, 0, 5]
    df = spark.createDataFrame([(f"r{i}", start + timedelta(hours=i), c) for i, c in enumerate(counts)], "run_id string, ts timestamp, count long")
    plain = [r.reason for r in O.change_reason(df).orderBy("run_id").collect()]
    routine = "routine sync (every backup committed for safety)"
    assert plain == ["first sync of the day (UTC)", routine, "count changed: 100 → 103 (3.0%)", "count changed: 103 → 110 (6.8%)",
                     "count changed: 110 → 0 (100.0%)", routine]
    older = [(r.reason, r.keep_copy) for r in O.change_reason(df, threshold=0.05).orderBy("run_id").collect()]
    assert older == [("first sync of the day (UTC)", True), ("routine sync, 0.0% change (under 5% threshold)", False), ("routine sync, 3.0% change (under 5% threshold)", False),
                     ("significant change: 7% (threshold: 5%)", True), ("significant change: 100% (threshold: 5%)", True), ("", False)]


def test_retention(spark):
    rows, df = runs_of(spark, 2)
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r[0])
    want = {i for ids in by.values() for i in sorted(ids)[-7:]}
    assert {r.run_id for r in O.retain_n(df, 7).where("keep").collect()} == want
    assert O.retain_n(df, 7).count() == len(rows)


@pytest.mark.parametrize("spread", [1000, 10_000, 2**60])
def test_numbers(spark, spread):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), p) for p in rnd.sample(range(-spread, spread), 300)]
    df = spark.createDataFrame(rows, "kind string, pos long")
    got = {(r.kind, r.pos): r.n for r in O.number_rows(df, "kind", "pos", "n").collect()}
    assert len(got) == 300
    for kind in ("a", "b", None):
        for n, p in enumerate(sorted(p for k, p in rows if k == kind), 1):
            assert got[kind, p] == n


@pytest.fixture
def uncoalesced(spark):
    """Small parts stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_parts_do_not_follow_days_or_positions(uncoalesced):
    """A day with all runs, and positions far apart, are cut into as many parts as there are partitions."""
    spark = uncoalesced
    runs = spark.range(0, 20_000, 1, 8).select(
        F.col("id").cast("string").alias("run_id"), F.timestamp_millis(F.col("id") + 1_700_000_000_000).alias("ts"), (F.col("id") % 7).alias("count")
    )
    sizes = [r["count"] for r in O.in_order(runs, "ts", "run_id").groupBy("__part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 7_000
    got = O.with_previous(runs, "count", "previous").orderBy("ts").select("count", "previous").collect()
    assert [r.previous for r in got] == [None, *[r["count"] for r in got[:-1]]]
    sparse = spark.range(0, 4000, 1, 4).select((F.col("id") * F.col("id") * 1_000_000_007).alias("pos"), F.lit("k").alias("kind"))
    assert len(O.in_order(sparse, "kind", "pos").groupBy("__part").count().collect()) == 4
    assert [r.n for r in O.number_rows(sparse, "kind", "pos", "n").orderBy("pos").collect()] == list(range(1, 4001))
    assert [r.n for r in O.numbered(sparse, "n", F.desc("pos")).orderBy(F.desc("pos")).collect()] == list(range(1, 4001))
    assert O.numbered(sparse.limit(0), "n", "pos").collect() == []


def test_first_rows_are_counted_not_sorted(spark):
    rnd = random.Random(5)
    for values in (list(range(50)), [rnd.randrange(-(2**62), 2**62) for _ in range(3000)], [7]):
        df = spark.createDataFrame([(v,) for v in values], "pos long")
        for n in (1, len(values) // 2 or 1, len(values)):
            assert O.nth_smallest(df, "pos", n) == sorted(values)[n - 1]
        assert O.nth_smallest(df, "pos", len(values) + 1) is None
    assert O.nth_smallest(df.limit(0), "pos", 1) is None and O.first_rows(df, 5).count() == 1
    big = spark.range(0, 30_000, 1, 8).select((F.col("id") * 97).alias("pos"))
    head = O.first_rows(big, 20_000)
    assert head.count() == 20_000 and head.agg(F.max("pos")).first()[0] == 19_999 * 97
    text = head._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "GlobalLimit" not in text and "SinglePartition" not in text


def test_preview(spark):
    df = spark.createDataFrame([(i, f"n{i}", "e") for i in range(12)], "pos long, name string, email string")
    got = [(r["rank"], r.name, r.remaining) for r in O.preview_k(df, 10, "pos").orderBy("rank").collect()]
    assert got[:10] == [(i + 1, f"n{i}", None) for i in range(10)] and got[10:] == [(11, None, 2)]
    assert O.preview_k(df, 12, "pos").count() == 12 and O.preview_k(df.where("false"), 5, "pos").count() == 0


def test_sort_is_stable(spark):
    df = spark.createDataFrame([(3, "b", ""), (1, "B", "p"), (2, "a", ""), (0, "b", "p")], "pos long, name string, photo string")
    assert [r.pos for r in O.sort_name(df).collect()] == [2, 0, 1, 3]
    assert [r.pos for r in O.sort_name(df, photo_first=True).collect()] == [0, 1, 2, 3]


def test_digest(spark):
    schema = "kind string, name string, email string, regions array<string>, team string, has_photo boolean, soft_deleted_at string, pos long"
    rows = [("purge", "P", "p@x", None, None, None, "2023", 1), ("new", "N", "n@x", ["A", "B"], "", False, None, 9),
            ("new", "M", "m@x", [], "T", True, None, 4)]
    events = spark.createDataFrame(rows, schema)
    lines = [r.line for r in event_digest(events, aborted="why").orderBy("line_no").collect()]
    assert lines == ["ABORTED: why", "", "2 new agent(s) added:", "  + M <m@x> · T · No region", "  + N <n@x> · Solo agent · A, B [no photo yet]",
                     "", "1 agent(s) purged (gone for 30+ days):", "  ✗ P <p@x> (soft-deleted 2023)"]
    assert event_digest(events.where(F.lit(False))).count() == 0
