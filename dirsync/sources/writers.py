"""Sinks.  Every write goes to a path of its own, so a rerun replaces it whole."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import stamp
from ..operators.ordering import sort_name
from ..schemas import DIRECTORY_FIELDS, TEMPORARY_COLUMNS
from .versions import publish


def published(directory: DataFrame) -> DataFrame:
    """Directory in its published order, ``pos`` numbered anew in that order."""
    ordered = sort_name(directory.drop(*TEMPORARY_COLUMNS))
    return ordered.drop("seq").withColumn("pos", F.monotonically_increasing_id())


def write_directory(directory: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the full snapshot in name order without temporary columns."""
    out = published(directory)
    if fmt == "parquet":
        out.write.mode("overwrite").parquet(path)
        return
    names = [*DIRECTORY_FIELDS.values(), "pos"]
    text = F.to_json(F.struct(*[F.col(c).alias(j) for c, j in DIRECTORY_FIELDS.items()], "pos"))
    # Unmodelled fields go back to the top level, next to the known ones.
    extra = F.to_json(F.map_filter("extras", lambda k, _v: ~k.isin(*names)))
    lines = out.select(text.alias("t"), extra.alias("x")).select(
        F.when(F.length("x") > 2, F.expr("left(t, length(t) - 1) || ',' || substring(x, 2)"))
        .otherwise(F.col("t"))
        .alias("value")
    )
    lines.write.mode("overwrite").text(path)


def publish_directory(directory: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a new version of the directory, then let ``path`` mean it.

    Readers see the old version until the new one is whole, and if the write fails
    they keep it.  Returns the folder of the version.
    """
    return publish(directory.sparkSession, path, lambda folder: write_directory(directory, folder, fmt))


def write_reports(
    reports: dict[str, tuple[str, DataFrame]],
    path: str,
    run_ts: datetime,
    dry_run: bool = False,
) -> DataFrame:
    """Write each report's rows and, beside them, one envelope row per report.

    The row count of an envelope is observed while the rows are written, so no
    report is computed twice.  Returns the envelopes.
    """
    first = next(iter(reports.values()))[1]
    spark = first.sparkSession
    run = run_ts.strftime("%Y-%m-%d_%H-%M-%S")
    heads = []
    for name, (description, rows) in reports.items():
        seen = Observation(f"rows_{name}")
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        if not dry_run:
            counted.write.mode("overwrite").json(f"{path}/rows/report={name}/run_ts={run}")
        else:
            counted.write.format("noop").mode("overwrite").save()
        heads.append((name, stamp(run_ts), dry_run, description, int(seen.get.get("n", 0))))
    envelopes = spark.createDataFrame(
        heads, "report string, generated string, dry_run boolean, description string, count bigint"
    )
    if not dry_run:
        envelopes.coalesce(1).write.mode("overwrite").json(f"{path}/envelopes/run_ts={run}")
    return envelopes


def write_sales(sales: DataFrame, path: str, fmt: str = "json") -> None:
    writer = sales.write.mode("overwrite")
    writer.parquet(path) if fmt == "parquet" else writer.json(path)
