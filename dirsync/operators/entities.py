"""HTML entities in whole texts, decoded by Spark's own expressions.

A text is cut at each ``&``; the parts are rows, decoded by themselves and put
together in their order.  Names come from a table, numbers from arithmetic.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A number in a reference that is read in another way than as its
# code point.  Those from 128 to 159 are read in this code page, where it has them.
CODE_PAGE = "cp1252"
LAST_CODE_POINT = 0x10FFFF
REPLACEMENT = "�"
#: What follows ``&`` in a reference: a number, or up to 32 letters of a name.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def entity_names() -> dict[str, str]:
    """Name, with its semicolon where it needs one, to text."""
    return dict(html5)


def code_page_texts() -> dict[int, str]:
    """Numbers from 128 to 159 with the text that browsers read in them."""
    return {n: bytes([n]).decode(CODE_PAGE, "ignore") or chr(n) for n in range(128, 160)}


def _names(spark: SparkSession) -> DataFrame:
    """head, names: the names of each two first letters with their texts, the longest first."""
    names = spark.createDataFrame(list(entity_names().items()), "name string, text string")
    longest = F.struct((-F.length("name")).alias("n"), "name", "text")
    return names.groupBy(F.substring("name", 1, 2).alias("__head")).agg(F.array_sort(F.collect_list(longest)).alias("__names"))


def _character(code: Column) -> Column:
    """A code point as text."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0")), "UTF-32")


def _number(reference: Column) -> Column:
    """The text of a numeric reference, without ``&``; null if it is none."""
    digits = F.regexp_extract(reference, r"^#(?:[xX])?([0-9a-fA-F]+)", 1)
    base16 = F.lower(F.substring(reference, 2, 1)) == "x"
    significant = F.ltrim(digits, F.lit("0"))
    # more digits than a code point has are beyond them all
    code = F.when(F.length(significant) > 8, LAST_CODE_POINT + 1).otherwise(
        F.when(base16, F.conv(F.concat(F.lit("0"), significant), 16, 10)).otherwise(F.concat(F.lit("0"), significant)).cast("bigint")
    )
    paged = F.create_map(*[F.lit(x) for pair in code_page_texts().items() for x in pair])
    no_text = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F)
        | code.between(0xFDD0, 0xFDEF) | ((code % 0x10000) >= 0xFFFE)
    )
    surrogate = code.between(0xD800, 0xDFFF)
    text = (
        F.when((code == 0) | surrogate | (code > LAST_CODE_POINT), REPLACEMENT)
        .when(code.between(128, 159), F.element_at(paged, code.cast("int")))
        .when(no_text, "")
        .otherwise(_character(code))
    )
    return F.when(reference.startswith("#"), text)


def decode_entities(df: DataFrame, text: str, out: str) -> DataFrame:
    """Every row with ``out``: its whole text with references decoded; null stays null.

    The longest known name wins, with or without semicolon as the table has it;
    what is no reference is left as it is.  Texts without ``&`` are passed around
    the work; of the others the other columns travel once, with the first part,
    and a task holds one text at a time to put it together.  The names are a fixed
    table of about two thousand.
    """
    others = F.struct(*[F.col(c) for c in df.columns])
    has = F.coalesce(F.contains(text, F.lit("&")), F.lit(False))
    plain = df.where(~has).withColumn(out, F.col(text))
    numbered = df.where(has).select(F.monotonically_increasing_id().alias("__row"), others.alias("__others"), F.col(text).alias("__text"))
    parts = numbered.select("__row", "__others", F.posexplode(F.split("__text", "&")).alias("__at", "__part"))
    parts = parts.select(
        "__row", "__at", "__part", F.when(F.col("__at") == 0, F.col("__others")).alias("__others"),
        F.when(F.col("__at") > 0, F.regexp_extract("__part", REFERENCE, 1)).otherwise("").alias("__ref"),
    )
    ref = F.col("__ref")
    head = F.when(ref.startswith("#"), None).otherwise(F.substring(ref, 1, 2))
    # the table is of fixed size
    found = parts.withColumn("__head", head).join(F.broadcast(_names(df.sparkSession)), "__head", "left")
    name = F.filter("__names", lambda x: ref.startswith(x["name"]))
    found = found.withColumn("__name", F.get(name, F.lit(0)))
    part = F.col("__part")
    number, named = _number(ref), F.col("__name.name")
    decoded = (
        F.when(F.col("__at") == 0, part)
        .when(number.isNotNull(), F.concat(number, F.substr(part, F.length(ref) + 1)))
        .when(named.isNotNull(), F.concat(F.col("__name.text"), F.substr(part, F.length(named) + 1)))
        .otherwise(F.concat(F.lit("&"), part))
    )
    whole = found.groupBy("__row").agg(
        F.first("__others", ignorenulls=True).alias("__others"),
        F.array_sort(F.collect_list(F.struct("__at", decoded.alias("text")))).alias("__parts"),
    )
    joined = F.array_join(F.transform("__parts", lambda x: x["text"]), "")
    return plain.unionByName(whole.select("__others.*", joined.alias(out)))
