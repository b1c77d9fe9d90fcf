"""Quality rules on documents and on the hosts they come from."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dirsync.operators.lookups import lookup
from dirsync.session import materialise

from .common import text_bytes
from .stats import rule_counts

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 50
#: Shrunk failure rate from which on a host is rejected.
MAX_HOST_RATE = 0.6

_NAMES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
_COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in _NAMES])


@F.arrow_udf(_COUNTS)
def _counts(texts: pa.Array) -> pa.Array:
    rows = [rule_counts(t) for t in texts.to_pylist()]
    columns = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], _NAMES)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_failed() -> Column:
    """Failure of any rule, which counts against the host."""
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")
    lines = 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    return F.col("base_failed") | symbols | lines


def document_counts(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """doc_id, host, the counts of each whole text, base_failed and failed."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), _counts(text_bytes(F.col(text_col))).alias("c"))
    rows = rows.select("doc_id", "host", "c.*").withColumn("base_failed", base_failed())
    return rows.withColumn("failed", host_failed())


def host_verdicts(counted: DataFrame) -> DataFrame:
    """host, n_docs, rate (shrunk), rejected: one row per host with a name.

    Failures of a host are beta-binomial.  The prior's mean is the failure rate of
    all documents with a host; its strength comes from the spread of the host
    rates by moments, weighted by documents: strength = (m(1-m) - v) / (v -
    m(1-m) * hosts / documents), between 1 and 10,000.
    """
    hosts = counted.where(F.col("host").isNotNull()).groupBy("host")
    hosts = hosts.agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("bigint")).alias("n_failed"))
    part = F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(
        F.count("*").alias("h"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("k"),
        F.sum(part * F.col("n_failed")).alias("kk"),
    )
    m = F.col("k") / F.col("n")
    v = F.col("kk") / F.col("n") - m * m
    noise = m * (1 - m) * F.col("h") / F.col("n")
    raw = F.when(v > noise, (m * (1 - m) - v) / (v - noise)).otherwise(F.lit(10_000.0))
    prior = sums.select(m.alias("m"), F.least(F.greatest(raw, F.lit(1.0)), F.lit(10_000.0)).alias("strength"))
    rate = (F.col("n_failed") + F.col("m") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
    judged = hosts.withColumn("one", F.lit(1)).join(F.broadcast(prior.withColumn("one", F.lit(1))), "one")  # one row
    return judged.select("host", "n_docs", rate.alias("rate"), (rate > MAX_HOST_RATE).alias("rejected"))


def judge_documents(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """One row per document: doc_id, host, the counts, base_failed, host_rejected, kept.

    Null and empty texts have no words and fail the base rules.  A document without
    host is judged by the base rules alone.  Repeated rows count each.  An empty
    table gives no rows.  Other columns are not read.  The counts are written once
    to the shared folder, as both the host rates and the result need them; hosts
    are summed before the shuffle, and the verdicts that are joined back are one
    row per host that is rejected, by a join whose hot host Spark can split.
    """
    counted = materialise(document_counts(docs, id_col, text_col, host_col), "host-rules")
    bad = host_verdicts(counted).where("rejected").select("host", F.lit(True).alias("host_rejected"))
    judged = lookup(counted, bad, F.col("host"), "host", pos="doc_id").withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
