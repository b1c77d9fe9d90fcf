"""Sources.

JSON lines, JSON arrays and Parquet are read alike, and all of them in splits.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..schemas import DIRECTORY, DIRECTORY_FIELDS, ROSTER_FIELDS, ROSTER_FLAGS, TRANSACTIONS
from .arrays import json_elements
from .versions import current

FORMATS = ("jsonl", "json", "parquet")
# Positions set aside for each account.
ACCOUNT_SPAN = 1 << 56


def format_of(path: str) -> str:
    for fmt in FORMATS:
        if path.rstrip("/").endswith(fmt):
            return fmt
    raise ValueError(f"cannot tell the format of {path}: name it with fmt=")


def _json_records(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One ``rec`` map per JSON object, with every value as text, and its place ``at`` if the file is an array.

    A map keeps field names in their exact case and keeps fields that no schema
    knows, and it reads an id alike whether it is a number or a string.
    """
    if fmt == "json":
        return json_elements(spark, path).select(F.from_json("text", "map<string,string>").alias("rec"), "at")
    raw = spark.read.text(path).where(F.trim("value") != "")
    return raw.select(F.from_json("value", "map<string,string>").alias("rec"))


def _flag(c: Column) -> Column:
    return c.try_cast("boolean")


def _with_pos(df: DataFrame) -> DataFrame:
    """``pos`` as the source gives it if it gives one to every row, else the reading order of all rows.

    Rows are told apart by it, so the two are never mixed.  Given positions are
    checked; those made here cannot repeat.
    """
    order = F.col("at") if "at" in df.columns else F.monotonically_increasing_id()
    if "pos" in df.columns and df.where("pos is null").isEmpty():
        return _told_apart(df.drop("at"))
    return df.withColumn("pos", order).drop("at")


def _told_apart(df: DataFrame) -> DataFrame:
    """The rows, if no two have one position; the check reads positions only."""
    if not df.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("rows of the source share a position: make pos unique, or leave it out")
    return df


def _read_roster(spark: SparkSession, path: str, fmt: str | None) -> DataFrame:
    fmt = fmt or format_of(path)
    if fmt == "parquet":
        raw = spark.read.parquet(path)
        have = {c: F.col(c) for c in raw.columns}
        cols = {c: have.get(c, F.lit(None)) for c in ROSTER_FIELDS}
    else:
        raw = _json_records(spark, path, fmt)
        cols = {c: F.coalesce(*[F.col("rec")[s] for s in spell]) for c, spell in ROSTER_FIELDS.items()}
    if fmt != "parquet":
        pos = F.col("rec")["pos"].try_cast("bigint")
    else:
        pos = F.col("pos").try_cast("bigint") if "pos" in raw.columns else F.lit(None).cast("bigint")
    rows = raw.select(
        *[
            (_flag(v.cast("string")) if c in ROSTER_FLAGS else v.cast("string")).alias(c)
            for c, v in cols.items()
        ],
        pos.alias("pos"),
        *[c for c in raw.columns if c == "at" and fmt == "json"],
    )
    return _with_pos(rows)


def load_rosters(
    spark: SparkSession,
    accounts: dict[str, str],
    enabled: tuple[str, ...] | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """Raw rosters of the enabled accounts, the first account first.

    ``pos`` is the row's place in its roster, shifted so that every row of the
    first account comes before every row of the next.
    """
    frames = [
        _read_roster(spark, path, fmt).withColumns(
            {"account": F.lit(account), "pos": F.col("pos") + F.lit(i * ACCOUNT_SPAN)}
        )
        for i, (account, path) in enumerate(accounts.items())
        if enabled is None or account in enabled
    ]
    if not frames:
        raise ValueError("no account is enabled")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def drop_repeats(directory: DataFrame) -> DataFrame:
    """First row by ``pos`` of every (id, second id, source, lower-case name).

    ``min_by`` reduces repeats before the shuffle, so a row stored very many
    times costs one row per task instead of one huge window.
    """
    keys = [
        F.coalesce("id", F.lit("")).alias("k1"),
        F.coalesce("second_id", F.lit("")).alias("k2"),
        F.coalesce("source", F.lit("")).alias("k3"),
        F.lower(F.trim(F.coalesce("name", F.lit("")))).alias("k4"),
    ]
    first = directory.groupBy(*keys).agg(
        F.min_by(F.struct(*directory.columns), F.col("pos")).alias("row")
    )
    return first.select("row.*")


def load_directory(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Previous directory without repeated rows.

    A directory that cannot be read is an error, never an empty directory.  Of a
    path that was published in versions the newest is read.
    """
    fmt = fmt or format_of(path)
    path = current(spark, path)
    if fmt == "parquet":
        rows = spark.read.parquet(path)
        rows = rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in DIRECTORY.fields
            ]
        )
        return drop_repeats(_with_pos(rows))
    rec = F.col("rec")
    known = [*DIRECTORY_FIELDS.values(), "pos"]
    cols = []
    for col, spelling in DIRECTORY_FIELDS.items():
        value = rec[spelling]
        if col == "regions":
            value = F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))
        elif col == "hidden":
            value = _flag(value)
        cols.append(value.alias(col))
    extras = F.map_filter(rec, lambda k, _v: ~k.isin(*known)).alias("extras")
    raw = _json_records(spark, path, fmt)
    rows = raw.select(*cols, extras, rec["pos"].try_cast("bigint").alias("pos"), *[c for c in raw.columns if c == "at"])
    return drop_repeats(_with_pos(rows))


def load_sales(
    spark: SparkSession, path: str, year: int, today: date | None = None, fmt: str | None = None
) -> DataFrame:
    """Closed transactions of a year; of the current year, only up to ``today``.

    ``closing_date`` is ISO text, so the range test is a plain comparison that
    reaches the scan.
    """
    fmt = fmt or format_of(path)
    if fmt == "parquet":
        rows = spark.read.parquet(path)
    elif fmt == "json":
        rows = json_elements(spark, path).select(F.from_json("text", TRANSACTIONS).alias("row")).select("row.*")
    else:
        rows = spark.read.schema(TRANSACTIONS).json(path)
    day = F.col("closing_date")
    last = f"{year + 1}-01-01"
    if today is not None and today.year == year:
        last = date.fromordinal(today.toordinal() + 1).isoformat()
    return rows.where((F.col("status") == "closed") & (day >= f"{year}-01-01") & (day < last))


def load_state(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", key: str | None = None) -> DataFrame:
    """A keyed state table; a path that does not exist gives an empty one.

    ``fmt`` is parquet, json (lines), or keyed: one JSON object that holds each
    row under its key, which becomes the column ``key``.
    """
    try:
        if fmt == "keyed":
            if key is None:
                raise ValueError("name the column of the key with key=")
            row = F.from_json("text", T.StructType([f for f in schema.fields if f.name != key])).alias("row")
            rows = json_elements(spark, path).where("key IS NOT NULL").select(F.col("key").alias(key), row)
            return rows.select(*[F.col(f.name if f.name == key else f"row.{f.name}").cast(f.dataType) for f in schema.fields])
        reader = spark.read.schema(schema)
        return reader.parquet(path) if fmt == "parquet" else reader.json(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], schema)
