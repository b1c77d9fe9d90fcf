"""The pipeline's stages on a small table, and SQL against the queries that have it."""

from collections import Counter

import duckdb
import corpus_pipeline
from dirsync.llm import language
from dirsync.llm.common import held_out
from dirsync.llm.oracle import ORACLES
from dirsync.llm.queries import QUERIES
from pyspark.sql import functions as F


def test_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
        assert stage(spark, docs.limit(0), sf_dir).collect() == []
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    left = {r.doc_id for r in docs.collect()}
    assert sum(labels.get(i) == 0 for i in left) <= 0.02 * len(left)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == left
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_language_judges_a_text_once(spark, sf_dir):
    """A filter on the judgement used to get a copy of the Python function: two workers a task, and each text compressed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.keep_language(spark, docs, sf_dir)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    learned = language.train(docs, ~held_out(F.col("doc_id")))
    sure = language.identify(docs, learned).where("sure").select("doc_id", "lang_pred")
    assert Counter(map(tuple, kept.select("doc_id", "lang").collect())) == Counter(map(tuple, sure.collect()))


def test_sql_agrees(spark, sf_dir):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in ORACLES.items():
        want = db.execute(sql)
        columns = [c[0] for c in want.description]
        got = QUERIES[name](spark, sf_dir).select(*columns).collect()
        assert Counter(map(tuple, got)) == Counter(want.fetchall()), name
