"""Lifecycle events counted as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import load_state

COUNTS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("kind", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)


def stream_event_counts(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Events per kind and UTC day of a stream of (ts, kind).

    A row later than ``lateness`` behind the newest event is dropped; a day's
    state is freed once the watermark has passed it.
    """
    return (
        events.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("w"), "kind")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("w.start").alias("day"), "kind", "n")
    )


def write_event_counts(counts: DataFrame, out: str, checkpoint: str) -> None:
    """Run the stream over all that has arrived, then stop.

    Each batch writes the counts it changed under its own number: days that the
    watermark has not passed come out too, and a replayed batch replaces what it
    wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    running = (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def event_counts(spark: SparkSession, out: str) -> DataFrame:
    """The newest count of every day and kind."""
    told = load_state(spark, out, COUNTS)
    return told.groupBy("day", "kind").agg(F.max_by("n", "batch").alias("n"))
