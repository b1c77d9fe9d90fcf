"""Roster snapshots that arrive one after another.

The stream carries announcements, one small row per complete snapshot; the
snapshot itself is then read as a batch.  Each announcement of a micro-batch
writes a directory version of its own and a log row, both named by the batch id
and its place in the batch, so a replayed batch replaces exactly what it wrote
before.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SyncConfig
from ..functions import stamp
from ..plans.sync import PublishRefused, plan_sync
from ..sources import load_directory, load_rosters, load_state, write_directory

ANNOUNCEMENT = T.StructType(
    [
        T.StructField("snapshot", T.LongType()),
        T.StructField("accounts", T.StringType()),
        T.StructField("taken_at", T.StringType()),
    ]
)
LOG = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("snapshot", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def announce_snapshot(spark: SparkSession, landing: str, snapshot: int, accounts: dict[str, str], taken_at: datetime) -> None:
    """Tell the stream that a snapshot is complete: a path per account."""
    row = [(snapshot, json.dumps(accounts), stamp(taken_at))]
    spark.createDataFrame(row, ANNOUNCEMENT).coalesce(1).write.json(f"{landing}/{snapshot:012d}")


def _newest(spark: SparkSession, state: str, batch: int | None = None, part: int = 0) -> Row | None:
    """(version, snapshot) published last, or last before a part of a batch."""
    log = load_state(spark, f"{state}/log/*", LOG, fmt="json").where("status = 'published'")
    if batch is not None:
        log = log.where((F.col("batch") < batch) | ((F.col("batch") == batch) & (F.col("part") < part)))
    found = log.agg(F.max_by(F.struct("version", "snapshot"), F.struct("batch", "part")).alias("newest")).first()
    return found["newest"]


def latest_directory(spark: SparkSession, state: str) -> DataFrame:
    newest = _newest(spark, state)
    if newest is None:
        raise ValueError(f"no directory was published under {state}")
    return spark.read.parquet(newest["version"])


def stream_snapshots(
    spark: SparkSession, landing: str, state: str, checkpoint: str, cfg: SyncConfig, start: str, fmt: str | None = None
) -> None:
    """Merge every announced snapshot not yet seen, then stop.

    ``start`` is the directory before the first snapshot.  The announcements of a
    file are merged in order of their snapshot.  A snapshot that the safety gate
    refuses, or that is not newer than the published one, leaves the directory as
    it is and is logged.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        # One small row per snapshot.
        for part, news in enumerate(batch.orderBy("snapshot", "taken_at", "accounts").collect()):
            merge_one(batch.sparkSession, news, batch_id, part)

    def merge_one(session: SparkSession, news: Row, batch_id: int, part: int) -> None:
        newest = _newest(session, state, batch_id, part)
        version = f"{state}/versions/batch={batch_id}-{part}"
        status, reason = "published", ""
        if newest and news["snapshot"] <= newest["snapshot"]:
            status, reason = "refused", f"snapshot {newest['snapshot']} is already published"
        else:
            previous = load_directory(session, newest["version"] if newest else start, "parquet")
            raw = load_rosters(session, json.loads(news["accounts"]), fmt=fmt)
            try:
                run = plan_sync(raw, previous, cfg, datetime.fromisoformat(news["taken_at"]))
                write_directory(run.directory, version)
            except PublishRefused as refusal:
                status, reason = "refused", str(refusal)
        log = session.createDataFrame([(batch_id, part, news["snapshot"], version, status, reason)], LOG)
        log.coalesce(1).write.mode("overwrite").json(f"{state}/log/batch={batch_id}-{part}")

    announced = (
        spark.readStream.schema(ANNOUNCEMENT)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1)
        .json(landing)
    )
    running = (
        announced.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
