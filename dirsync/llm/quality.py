"""A quality classifier of few rules over statistics of the text.

Shallow trees are grown on labelled documents, every path of theirs is a rule (a
conjunction of bounds on statistics), a logistic model with a lasso penalty
weighs the rules, and those with a weight become one Spark column expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dirsync.session import materialise

from .common import release_memory, text_bytes
from .stats import SYMBOL_CODES, byte_counts, codes, duplicate_lines, repeat_words

#: Bound of the training sample; the rows that come first by the hash of their id.
TRAINING_ROWS = 10_000
TREES, DEPTH, LASSO, SEED = 12, 3, 0.003, 7
THRESHOLD = 0.7

STATISTICS = [
    "n_words", "word_length", "upper_share", "symbol_share", "bang_share", "digit_share", "mark_share", "other_share",
    "repeat_share", "dup_line_share", "distinct_share", "top_word_share", "words_per_line",
]
_MARKS = np.frombuffer(b".,;:?'\"()-", np.uint8)


def statistics(text: bytes) -> tuple[float, ...]:
    """The statistics of a whole text; all zero without words."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    seen, c = byte_counts(text), codes(words)
    chars = max(1, len(text) - int(seen[128:192].sum()))
    lines, dup = duplicate_lines(text)
    share = lambda n: float(n) / chars
    times = np.bincount(c)
    return (
        float(len(words)), chars / len(words), share(seen[65:91].sum()), share(seen[SYMBOL_CODES].sum()), share(seen[33]),
        share(seen[48:58].sum()), share(seen[_MARKS].sum()), share(seen[192:].sum()), repeat_words(c) / len(words),
        dup / lines, len(times) / len(words), float(times.max()) / len(words), len(words) / lines,
    )


@F.arrow_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in STATISTICS]))
def _statistics(texts: pa.Array) -> pa.Array:
    rows = np.array([statistics(t) for t in texts.to_pylist()]).reshape(-1, len(STATISTICS))
    release_memory()
    return pa.StructArray.from_arrays([pa.array(c) for c in rows.T], STATISTICS)


def text_statistics(text: Column) -> Column:
    return _statistics(text_bytes(text))


Rule = tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; a rule is a tuple of (statistic, "<=" or ">", bound)."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1, from a struct of statistics, in plain column expressions."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def rule_column(rule: Rule, stats: Column) -> Column:
    held = F.lit(True)
    for name, side, bound in rule:
        held = held & (stats[name] <= bound if side == "<=" else stats[name] > bound)
    return held


_LINE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)$")


def tree_rules(description: str) -> list[Rule]:
    """Every path of the trees that a forest's description spells out, with one bound per statistic and side."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in description.splitlines():
        m = _LINE.match(line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (STATISTICS[int(m[3])], m[4], float(m[5])))]
        bounds: dict[tuple[str, str], float] = {}
        for _, (name, side, value) in path:
            known = bounds.get((name, side), value)
            bounds[name, side] = min(known, value) if side == "<=" else max(known, value)
        found[tuple(sorted((name, side, value) for (name, side), value in bounds.items()))] = None
    return list(found)


def train(docs: DataFrame, labels: DataFrame, use: Column | None = None, id_col="doc_id", text_col="text", label_col="quality") -> RuleModel:
    """Learn from the labelled rows for which ``use`` (on ``doc_id`` of ``labels``) holds.

    At most ``TRAINING_ROWS`` ids are drawn, by hash; of each the text with the
    smallest hash is taken, and only its statistics go on.  Without two classes to tell apart the model
    is the share of label 1, or one half where no row is labelled.
    """
    drawn = (labels if use is None else labels.where(use)).select(F.col(id_col).alias("i"), F.col(label_col).cast("double").alias("label"))
    drawn = drawn.dropna().groupBy("i").agg(F.min("label").alias("label")).orderBy(F.xxhash64("i"), "i").limit(TRAINING_ROWS)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    rows = texts.join(F.broadcast(drawn), "i")  # drawn has at most TRAINING_ROWS rows
    rows = rows.groupBy("i", "label").agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t"))
    rows = materialise(rows.select("i", "label", text_statistics(F.col("t")).alias("s")).select("i", "label", "s.*"), "quality-sample")
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        share = min(max(ones / n, 0.01), 0.99) if n else 0.5
        return RuleModel(float(np.log(share / (1 - share))), ())
    # one partition: the sample is bounded, and the trees then do not depend on its layout
    rows = rows.coalesce(1).sortWithinPartitions(F.xxhash64("i"), *STATISTICS)
    rows = VectorAssembler(inputCols=STATISTICS, outputCol="x").transform(rows).select("label", "x").cache()
    trees = RandomForestClassifier(featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5)
    rules = tree_rules(trees.fit(rows).toDebugString)

    index = {name: i for i, name in enumerate(STATISTICS)}
    tests = [[(index[name], side == "<=", value) for name, side, value in rule] for rule in rules]

    @F.arrow_udf("array<double>")
    def held(x: pa.Array) -> pa.Array:
        v = np.stack([np.asarray(r, float) for r in x.to_pylist()]) if len(x) else np.zeros((0, len(index)))
        cols = [np.logical_and.reduce([v[:, i] <= b if below else v[:, i] > b for i, below, b in t]) for t in tests]
        return pa.array(list(np.array(cols, float).T), pa.list_(pa.float64()))

    from pyspark.ml.functions import array_to_vector, vector_to_array

    marked = rows.select("label", array_to_vector(held(vector_to_array("x"))).alias("r")).cache()
    lasso = LogisticRegression(featuresCol="r", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60)
    fitted = lasso.fit(marked)
    marked.unpersist()
    rows.unpersist()
    weights = fitted.coefficients.toArray()
    kept = tuple((rule, float(w)) for rule, w in zip(rules, weights, strict=True) if abs(w) > 1e-6)
    return RuleModel(float(fitted.intercept), kept)


def score(docs: DataFrame, model: RuleModel, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, score, predicted: one row per document, from its whole text alone.

    Null and empty texts have zero statistics and are scored like any other;
    repeated rows are scored each; an empty table gives no rows; other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_statistics(F.col(text_col)).alias("s"))
    rows = rows.select("doc_id", model.score(F.col("s")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
