"""Records of JSON arrays and of keyed JSON objects, read in splits.

A file is read in pieces that end at a closing brace, wherever its splits lie.
Whether a piece starts inside a string, and how deep, follows from what all
pieces before it do: each split is summed up for both cases, the sums are chained
with one row for each split, and a record ends where the depth is back at one.
No task holds more than a split, and no row more than a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ["file", "block"]


def _before(w) -> object:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(c: Column | str, w) -> Column:
    return F.coalesce(F.sum(c).over(_before(w)), F.lit(0))


def _depth(text: Column) -> Column:
    """Brackets and braces opened less those closed, in text without strings."""

    def count(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    return count("{[") - count("}]")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, nth, size, piece; quotes in it, those before it in its split, and its depth if the split starts outside (0) or inside (1) a string."""
    meta = F.col("_metadata")
    raw = spark.read.option("lineSep", "}").text(path)
    raw = raw.select(
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"),
        meta["file_size"].alias("size"),
        F.monotonically_increasing_id().alias("nth"),
        F.concat("value", F.lit("}")).alias("piece"),
    )
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"', -1)
    even = F.array_join(F.filter(parts, lambda _, i: i % 2 == 0), "")
    odd = F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "")
    told = raw.withColumns({"quotes": F.size(parts) - 1, "even": _depth(even), "odd": _depth(odd)})
    told = told.withColumn("quoted", _sum_before("quotes", Window.partitionBy(*SPLIT).orderBy("nth")) % 2)
    same = F.col("quoted") == 0
    return told.withColumns({"deep0": F.when(same, F.col("even")).otherwise(F.col("odd")), "deep1": F.when(same, F.col("odd")).otherwise(F.col("even"))})


def _splits(pieces: DataFrame) -> DataFrame:
    """One row for each split: whether it starts inside a string, and how deep."""
    sums = pieces.groupBy(*SPLIT).agg(
        (F.sum("quotes") % 2).alias("turn"),
        F.sum("deep0").alias("deep0"),
        F.sum("deep1").alias("deep1"),
        F.sum(F.octet_length("piece")).alias("bytes"),
        F.max("size").alias("size"),
    )
    w = Window.partitionBy("file").orderBy("block")
    sums = sums.withColumn("inside", _sum_before("turn", w) % 2)
    sums = sums.withColumn("deep", F.when(F.col("inside") == 0, F.col("deep0")).otherwise(F.col("deep1")))
    return sums.select(*SPLIT, "turn", "inside", "deep", "bytes", "size", _sum_before("deep", w).alias("start"))


def _refuse_partial(splits: DataFrame) -> None:
    """A file must end outside strings at depth zero; the brace that was added to what follows the last one is left out."""
    ends = splits.groupBy("file").agg(
        (F.sum("turn") % 2).alias("inside"),
        (F.sum("deep") + (F.sum("bytes") > F.max("size")).cast("int")).alias("depth"),
    )
    broken = ends.where("inside <> 0 OR depth <> 0").select("file").head(1)
    if broken:
        raise ValueError(f"{broken[0]['file']} is not one whole JSON array or object")


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(at, key, text): the objects in the arrays or keyed objects of a path, as JSON text.

    ``at`` counts them from 0 over all files in the order of their names; ``key``
    is null in arrays.  Values that are no objects are left out, empty files and
    empty arrays give no rows, and a file that is cut off is an error.
    """
    pieces = _pieces(spark, path)
    splits = _splits(pieces)
    _refuse_partial(splits)
    w = Window.partitionBy(*SPLIT).orderBy("nth")
    placed = pieces.join(splits.select(*SPLIT, "inside", "start"), SPLIT)
    change = F.when(F.col("inside") == 0, F.col("deep0")).otherwise(F.col("deep1"))
    placed = placed.withColumn("depth", F.col("start") + F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    outside = (F.col("inside") + F.col("quoted") + F.col("quotes")) % 2 == 0
    placed = placed.withColumn("ends", (outside & (F.col("depth") == 1)).cast("int"))
    counts = placed.groupBy(*SPLIT).agg(F.sum("ends").alias("n"))
    # One row for each split.
    counts = counts.select(*SPLIT, _sum_before("n", Window.orderBy(*SPLIT)).alias("first"))
    numbered = placed.join(counts, SPLIT).select("file", (F.col("first") + _sum_before("ends", w)).alias("at"), "block", "nth", "piece", "ends")
    whole = numbered.groupBy("file", "at").agg(
        F.array_sort(F.collect_list(F.struct("block", "nth", "piece"))).alias("pieces"), F.max("ends").alias("ends")
    )
    text = F.regexp_replace(F.array_join(F.col("pieces")["piece"], ""), r"^\s*[\[{,]\s*", "")
    found = whole.where("ends = 1").select("at", text.alias("text"))
    keyed = F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), "map<string,string>")
    found = found.withColumn("pair", F.when(F.col("text").startswith('"'), F.map_entries(keyed)))
    # Elements before the object that are none stand in front of it in its text.
    plain = F.regexp_extract("text", r"(?s)(\{.*)", 1)
    last = F.try_element_at("pair", F.lit(-1))
    return found.select("at", last["key"].alias("key"), F.coalesce(last["value"], plain).alias("text"))
