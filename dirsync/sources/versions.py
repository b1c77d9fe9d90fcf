"""Tables that change as a whole: versions, and a log that tells which one counts.

Data are written first, to a folder of their own.  Then the log gets one entry, a
file that appears by being renamed; only with it does a version exist.  A write
that fails before leaves what was there, and two writers cannot take one number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

_ENTRY = "version bigint, kind string, folder string"
BASE, CHANGES = "base", "changes"
#: Change folders after which a state table is written anew as one base.
CHANGES_KEPT = 8
GONE = "__gone"


def _log(path: str) -> str:
    return f"{path.rstrip('/')}.log"


def entries(spark: SparkSession, path: str) -> list:
    """The log, oldest first; one entry for each version."""
    try:
        return spark.read.schema(_ENTRY).json(f"{_log(path)}/v=*").orderBy("version").collect()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return []


def _commit(spark: SparkSession, path: str, version: int, kind: str, folder: str) -> None:
    row = spark.createDataFrame([(version, kind, folder)], _ENTRY).coalesce(1)
    row.write.mode("errorifexists").json(f"{_log(path)}/v={version:012d}")


def _next(spark: SparkSession, path: str) -> tuple[int, str]:
    log = entries(spark, path)
    version = log[-1]["version"] + 1 if log else 1
    return version, f"{path.rstrip('/')}.versions/{version:012d}-{uuid.uuid4().hex}"


def current(spark: SparkSession, path: str) -> str:
    """Where the newest version lies; the path itself if it has no log."""
    log = entries(spark, path)
    return log[-1]["folder"] if log else path


def publish(spark: SparkSession, path: str, write) -> str:
    """``write(folder)`` a new version, then let ``path`` mean it; returns the folder."""
    version, folder = _next(spark, path)
    write(folder)
    _commit(spark, path, version, BASE, folder)
    return folder


def _newest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row of each key, the greatest in the order, which combines before the shuffle."""
    columns = [c for c in rows.columns if c not in order]
    found = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__row"))
    return found.select("__row.*")


def write_state(df: DataFrame, path: str, key: str, order: str | None = None, gone: str | None = None) -> None:
    """Add rows to a keyed table: each replaces what its key had.

    Of rows with one key the greatest ``order`` counts, a column that is not kept; without an order a repeated
    key is refused, as is a null key.  Rows for which the column ``gone`` is true
    remove their key.  Only the changes are written; after ``CHANGES_KEPT`` of them
    the table is written anew.
    """
    spark = df.sparkSession
    flag = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    rows = df.withColumn(GONE, flag).drop(*([gone] if gone else []))
    if not rows.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"state without {key}")
    if order:
        rows = _newest(rows, key, [order])
    elif not rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"{key} is repeated: name the order that tells which row counts")
    log = entries(spark, path)
    version, folder = _next(spark, path)
    if not log:
        rows.where(~F.col(GONE)).drop(GONE).write.parquet(folder)
        _commit(spark, path, version, BASE, folder)
        return
    rows.write.parquet(folder)
    _commit(spark, path, version, CHANGES, folder)
    since = len(log) + 1 - max(i for i, e in enumerate(log) if e["kind"] == BASE) - 1
    if since >= CHANGES_KEPT:
        compact_state(spark, path, key, rows.drop(GONE).schema)


def compact_state(spark: SparkSession, path: str, key: str, schema: T.StructType) -> None:
    """Write the table anew as one base; readers of the old version are not disturbed."""
    whole = read_state(spark, path, key, schema)
    version, folder = _next(spark, path)
    whole.write.parquet(folder)
    _commit(spark, path, version, BASE, folder)


def read_state(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """The table as of now, one row for each key: the newest of the base and the changes after it.

    A table that was never written is empty.
    """
    log = entries(spark, path)
    if not log:
        return spark.createDataFrame([], schema)
    base = max(i for i, e in enumerate(log) if e["kind"] == BASE)
    rows = spark.read.schema(schema).parquet(log[base]["folder"])
    if base == len(log) - 1:
        return rows
    wide = T.StructType([*schema.fields, T.StructField(GONE, T.BooleanType())])
    rows = rows.withColumns({GONE: F.lit(False), "__version": F.lit(log[base]["version"])})
    for e in log[base + 1 :]:
        rows = rows.unionByName(spark.read.schema(wide).parquet(e["folder"]).withColumn("__version", F.lit(e["version"])))
    return _newest(rows, key, ["__version"]).where(~F.col(GONE)).drop(GONE)
