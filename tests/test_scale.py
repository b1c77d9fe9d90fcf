"""Plans that hold at size: no nested loops, splittable hot keys, lean scans."""

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import queries as Q
from catalog.settings import ASSET, NOW
from dirsync import SyncConfig
from dirsync.operators import match as M
from dirsync.operators import pages as P
from dirsync.operators import rules as RU
from dirsync.operators.lookups import likely_in, lookup

WRITES = ("stream_", "sink_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """Settings under which a few rows of one key count as skew."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if not n.startswith(WRITES)])
def test_no_nested_loops(spark, sf_dir, name):
    text = plan(Q.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def hot(spark, n=60_000):
    """A third of the rows share one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id"))
    return spark.range(0, n, 1, 8).select(F.col("id").alias("pos"), key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("load"))


def test_lookup_splits_a_hot_key(skewed):
    left = hot(skewed)
    right = left.where("key is not null").groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = lookup(left, right, F.col("key"), "k")
    got = {r.n: r["count"] for r in out.groupBy("n").count().collect()}
    assert got == {20_000: 20_000, 1: 20_000, None: 20_000}
    rows = out.select("pos", "n", "load")
    rows.collect()
    assert "skew=true" in plan(rows)


def test_match_splits_a_hot_email(skewed):
    rows = hot(skewed).select(
        "pos", F.lit(None).cast("string").alias("id"), F.coalesce("key", F.col("load")).alias("email"), F.lit("").alias("name")
    )
    old = rows.groupBy("email").agg(F.min("pos").alias("pos")).select(
        "pos", F.lit("").alias("id"), "email", F.lit("").alias("name")
    )
    out = M.tiered_match(rows, old, SyncConfig())
    assert out.count() == 60_000
    out = M.tiered_match(rows, old, SyncConfig())
    out.collect()
    assert "skew=true" in plan(out)


def test_pages_are_not_shuffled(spark, sf_dir):
    """Page text is cut down before any exchange or Python step."""
    queue = fx.load(spark, sf_dir, "fx_asset_rows")
    df = P.scrape_apply(queue, fx.load(spark, sf_dir, "fx_profile_pages"), fx.load(spark, sf_dir, "fx_scrape_cache"), ASSET, NOW)
    text = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("ArrowEvalPython" in line for line in text)
    assert not [line for line in text if ("ArrowEvalPython" in line or "Exchange" in line) and "html" in line]


def test_scans_read_only_what_they_need(spark, sf_dir):
    text = plan(Q.QUERIES["coverage_stats"](spark, sf_dir)) + plan(Q.QUERIES["match_index"](spark, sf_dir))
    for scan in [line for line in text.splitlines() if "ReadSchema" in line and "fx_directory" in line]:
        assert "team_logo" not in scan.split("ReadSchema")[1]


def test_year_filter_reaches_the_scan(spark, sf_dir):
    df = Q.QUERIES["src_transactions"](spark, sf_dir)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(closing_date,1998-01-01)" in text and "EqualTo(status,closed)" in text


def test_only_wanted_pages_are_parsed(spark, sf_dir):
    """The filter of wanted pages lies below the Python step, and loses none of them."""
    df = Q.QUERIES["scrape_apply"](spark, sf_dir)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    python = min(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)
    assert any("bitmap" in line or "__bits" in line for line in lines[python:])
    rows = spark.range(0, 40_000, 1, 8).select(F.concat(F.lit("u"), F.col("id")).alias("url"), F.lit("x" * 50).alias("html"))
    wanted = rows.where("hash(url) % 40 = 0").select("url")
    found = likely_in(rows, "url", wanted.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS url")), "url")
    assert found.columns == ["url", "html"] and found.join(wanted, "url").count() == wanted.count() > 0
    assert found.count() < wanted.count() + 100 and likely_in(rows, "url", wanted.limit(0), "url").count() == 0


def test_duplicate_flags_split_a_hot_email(skewed):
    rows = hot(skewed).select("pos", F.coalesce(F.lit(None), F.when(F.col("key") == "hot", "h@x").otherwise(F.concat("load", F.lit("@x")))).alias("email"),
                              F.concat(F.lit("name"), F.translate(F.substring("load", 1, 4), "0123456789", "ghijklmnop")).alias("name"))
    out = RU.dup_names(rows, SyncConfig())
    assert out.count() > 30_000
    out = RU.dup_names(rows, SyncConfig())
    out.collect()
    assert "skew=true" in plan(out)
