"""Equi-joins against keyed tables, and lookups in configured maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup(left: DataFrame, right: DataFrame, key: Column, right_key: str, pos: str = "pos") -> DataFrame:
    """Left join of every row to a table that is unique on ``right_key``.

    A row without a key finds nothing; it is joined under its own position, so
    that such rows spread over all tasks instead of meeting in one.

    A much repeated key can only be on the left.  Both sides join on a text
    built here, which no earlier grouping is partitioned by: each side gets an
    exchange of its own, and that is what lets adaptive execution split the
    left partition of a hot key.  Nothing is broadcast by hint.
    """
    keyed = left.withColumn(
        "__key", F.coalesce(F.concat(F.lit("k"), key), F.concat(F.lit("n"), F.col(pos).cast("string")))
    )
    table = right.withColumn("__key", F.concat(F.lit("k"), F.col(right_key))).drop(right_key)
    return keyed.join(table, "__key", "left").drop("__key")


#: Bits of the filter that ``likely_in`` builds: 2 MB, whatever the tables' sizes.
FILTER_BITS = 1 << 24


def likely_in(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows whose key is wanted, and perhaps some others.

    A Bloom filter of fixed size is built from the wanted keys and sent to all
    tasks, so wide rows can be left out before any work on them and without moving
    them.  It leaves out none that is wanted.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))

    bits = wanted.where(F.col(wanted_key).isNotNull()).select(place(wanted_key).alias("__at"))
    bits = bits.groupBy(F.bitmap_bucket_number("__at").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__at")).alias("__bits"))
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substr("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = rows.withColumn("__bucket", F.bitmap_bucket_number(place(key))).join(F.broadcast(bits), "__bucket")
    found = held.where(F.call_function("getbit", byte, F.pmod(at, F.lit(8)).cast("int")) == 1)
    return found.drop("__bucket", "__bits")


def lookup_row(left: DataFrame, right: DataFrame, row: str, right_row: str, pos: str = "pos") -> DataFrame:
    """As ``lookup``, for non-negative row numbers."""
    keyed = left.withColumn("__row", F.coalesce(F.col(row), -1 - F.col(pos)))
    return keyed.join(right, F.col("__row") == right[right_row], "left").drop("__row")


def settled(df: DataFrame, pos: str = "pos") -> DataFrame:
    """Give rows without a position their reading order.

    The step depends on order, so later filters stay above it: they test the
    columns computed so far instead of computing them a second time.
    """
    return df.withColumn(pos, F.coalesce(pos, F.monotonically_increasing_id()))


def map_lookup(df: DataFrame, key: str, mapping: dict[str, str] | DataFrame, out: str) -> DataFrame:
    """Add ``out``: the mapped value of a key, or null.

    A map is a table like any other: one join, which Spark plans by its size.
    """
    if not isinstance(mapping, DataFrame):
        mapping = df.sparkSession.createDataFrame(list(mapping.items()), f"{key} string, {out} string")
    table = mapping.toDF("__mapped", out)
    return df.join(table, F.col(key) == F.col("__mapped"), "left").drop("__mapped")


def lookup_default(df: DataFrame, key: str, mapping: dict[str, str] | DataFrame, out: str, default: str = "") -> DataFrame:
    """``map_lookup`` with a default for keys the map does not know."""
    found = map_lookup(df, key, mapping, "__found")
    return found.withColumn(out, F.coalesce("__found", F.lit(default))).drop("__found")


def mark_members(df: DataFrame, key: str, members, out: str) -> DataFrame:
    """Add a flag: is the key in a configured list, or in a one-column table?"""
    if isinstance(members, DataFrame):
        known = members.toDF("__m").where("__m is not null").distinct().withColumn("__hit", F.lit(True))
        found = lookup(df, known, F.col(key), "__m")
        return found.withColumn(out, F.coalesce("__hit", F.lit(False))).drop("__hit")
    members = sorted(members)
    return df.withColumn(out, F.coalesce(F.col(key).isin(*members), F.lit(False)) if members else F.lit(False))
