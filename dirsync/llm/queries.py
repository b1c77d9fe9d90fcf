"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirsync.session import scratch_path

from . import bpe, hnsw, hostrules, importance, language, packing, planes, quality, repeats, simhash, transducer, urlfilter, variants
from .common import held_out, table

BYTE_TOKENIZER, WORD_TOKENIZER = "byte_bpe_50k.json", "word_bpe_49k.json"
Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by the given rules and by rules mined from the labels.

    A page's address ends in the number of its document, whose labels are the url's:
    it is bad if the document is of low quality or toxic.
    """
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract(urlfilter.path_of(urlfilter.after_scheme(F.col("url"))), r"/(\d+)(?:\.\w+)?/?$", 1)
    numbered = pages.select("url", number.alias("number")).select("url", F.expr("try_cast(number AS bigint)").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").where(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labels = labels.groupBy("doc_id").agg(F.bool_or(bad).alias("bad"))
    return urlfilter.judge_urls(pages, numbered.join(labels, "doc_id").select("url", "bad"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    n_spans = (F.size("spans") / 2).cast("bigint").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, F.col("sha256").alias("kept_sha256"))


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as planes and read back."""
    path = scratch_path(spark, "token-planes")
    planes.write_token_table(table(spark, sf_dir, "documents"), path, tokenizer_path(BYTE_TOKENIZER), end_id=0)
    rows = planes.read_token_table(spark, path).withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
    return planes.with_starts(rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hostrules.judge_documents(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), end_id=1)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language.train(docs, ~held_out(F.col("doc_id")))
    found = language.identify(docs, learned)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "sure")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    found = quality.score(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_url_filter, op2_suffix_dedup, op3_token_planes, op4_host_rules, op5_packing, op6_language_id, op7_embedding_dedup, op8_simhash, op9_bpe, op10_quality,
    op11_token_counts, op12_importance, op13_spelling,
)}
