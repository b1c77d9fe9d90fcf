import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from catalog import queries as Q
from catalog.settings import NOW, SYNC
from dirsync.plans import plan_sync
from dirsync.sources import load_directory, load_rosters, write_directory
from dirsync.functions import stamp
from dirsync.streaming.events import event_counts, stream_event_counts, write_event_counts
from dirsync.streaming.snapshots import ANNOUNCEMENT, announce_snapshot, latest_directory, stream_snapshots


def bag(df):
    return sorted(map(repr, df.drop("pos").collect()))


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    """Three snapshots in two stream runs give what three batch runs give; a poor one changes nothing."""
    raw = Q.roster(spark, sf_dir)
    start = str(tmp_path / "start.parquet")
    Q.previous(spark, sf_dir).write.parquet(start)
    landing, state, checkpoint = (str(tmp_path / n) for n in ("landing", "state", "checkpoint"))

    def put(n, rows):
        path = str(tmp_path / f"snap{n}-main.parquet")
        rows.where("account = 'main'").write.parquet(path)
        other = path.replace("main", "second")
        rows.where("account = 'second'").write.parquet(other)
        paths = {"main": path, "second": other}
        announce_snapshot(spark, landing, n, paths, NOW + timedelta(days=20 * n))
        return paths

    snaps = [raw.where(F.col("pos") % 50 != n) for n in range(2)] + [raw.where("pos < 30"), raw.where("pos % 50 <> 3")]
    batch = start
    paths = [put(n, snaps[n]) for n in range(2)]
    stream_snapshots(spark, landing, state, checkpoint, SYNC, start)
    paths += [put(n, snaps[n]) for n in (2, 3)]
    stream_snapshots(spark, landing, state, checkpoint, SYNC, start)
    # One file with an old snapshot and two new ones, the later first.
    several = [(n, json.dumps(paths[of]), stamp(NOW + timedelta(days=20 * n))) for n, of in ((5, 1), (4, 0), (1, 1))]
    spark.createDataFrame(several, ANNOUNCEMENT).coalesce(1).write.json(f"{landing}/several")
    stream_snapshots(spark, landing, state, checkpoint, SYNC, start)
    for n, of in ((0, 0), (1, 1), (3, 3), (4, 0), (5, 1)):
        run = plan_sync(load_rosters(spark, paths[of]), load_directory(spark, batch), SYNC, NOW + timedelta(days=20 * n))
        batch = str(tmp_path / f"batch{n}.parquet")
        write_directory(run.directory, batch)
    assert bag(latest_directory(spark, state)) == bag(spark.read.parquet(batch))
    log = sorted((r.snapshot, r.status) for r in spark.read.json(state + "/log/*").collect())
    assert log == [(0, "published"), (1, "published"), (1, "refused"), (2, "refused"), (3, "published"), (4, "published"), (5, "published")]


def test_event_counts_have_every_day(spark, tmp_path):
    """Two runs of the stream: the last day comes out, and the second run adds to it."""
    where, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "kind string, ts timestamp"
    day = datetime(2024, 3, 1)
    assert event_counts(spark, out).count() == 0
    for hours in ([1, 2, 30], [40, 41]):
        spark.createDataFrame([("a", day + timedelta(hours=h)) for h in hours], schema).coalesce(1).write.mode("append").parquet(where)
        write_event_counts(stream_event_counts(spark.readStream.schema(schema).parquet(where)), out, checkpoint)
    assert sorted((str(r.day), r.n) for r in event_counts(spark, out).collect()) == [("2024-03-01", 2), ("2024-03-02", 3)]
