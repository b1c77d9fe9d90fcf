"""A corpus pipeline of five stages over ``documents``, each by one operator of ``dirsync.llm``.

Every stage takes and gives the columns in ``COLUMNS``; other columns are left
behind.  Repeated rows are rows of their own in all stages but the near copies,
which keep one of them; empty tables stay empty; texts of any length are read
whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirsync.llm import language, nearcopies, packing, quality, repeats
from dirsync.llm.common import bound_batches, held_out, table
from dirsync.llm.queries import WORD_TOKENIZER, tokenizer_path
from dirsync.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, learned from ``labels``, predicts to be good.

    A null text is scored as the empty one; a row without doc_id is scored but never learned from.
    """
    bound_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    stats = docs.select(*COLUMNS, quality.text_statistics(F.col("text")).alias("stats"))
    return stats.where(model.score(F.col("stats")) >= quality.THRESHOLD).select(*COLUMNS)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure; ``lang`` becomes what the text says.

    Undetermined texts, null and empty ones among them, and those with a narrow margin go.
    """
    bound_batches(spark)
    learned = language.train(docs, ~held_out(F.col("doc_id")))
    judged = docs.select(*COLUMNS, language.classifier(learned)(F.col("text")).alias("judged"))
    kept = judged.where("judged.sure").withColumn("lang", F.col("judged.lang_pred"))
    return kept.select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: found by SimHash, they share at least 0.8 of their five-word shingles (Jaccard).

    The row with the smallest doc_id stays, one without doc_id only if all are; texts without words are one group.
    """
    bound_batches(spark)
    return nearcopies.drop_copies(docs.select(*COLUMNS))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that an earlier document has; what is left of a cut letter is marked as unreadable.

    Null texts become empty; rows without doc_id are left as they are; rows of one doc_id do not cut each other.
    """
    found = repeats.remove_repeats(docs.select(*COLUMNS))
    text = F.expr("make_valid_utf8(CAST(kept AS STRING))")
    rows = found.select("doc_id", text.alias("text"), F.col("row.lang").alias("lang"), F.col("row.source").alias("source"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows, with their ids; null and empty texts are one end id."""
    bound_batches(spark)
    return packing.pack(docs, tokenizer_path(WORD_TOKENIZER), end_id=1, together=1_000_000, kept=200_000)


STAGES = [
    ("quality classifier", keep_quality),
    ("language id", keep_language),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("packing", pack_windows),
]

#: SQL has neither the models nor the tokenizer; tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder, the last is left to the caller."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
