"""Language by compression: the dictionary that shortens a text most names its language.

For each language a zstandard dictionary of raw text is made from a bounded
sample of labelled documents.  A text is compressed with each, in blocks that start
afresh, as a dictionary saves less and less once a text has its own words to refer
to.  The smallest sum over all blocks wins, and its lead gives the score, whatever
the length.  Case is folded first,
as a text in capitals has nothing in common with a dictionary in small letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, text_bytes

#: Bounds of the sample: documents drawn per language, and bytes of its dictionary.
SAMPLE_DOCUMENTS = 200
DICTIONARY_BYTES = 112 * 1024
#: Parts of a language that are ranked apart before their first ids are ranked together.
STRATA = 16
#: A longer document gives the dictionary an even cut of this many bytes.
SAMPLE_BYTES = 4096
LEVEL = 6
#: Bytes of a text that are compressed together.
BLOCK_BYTES = 16 * 1024
#: Score below which a text's language counts as unsure.
MIN_SCORE = 0.4
#: Lead, in percent of the best size, at which the score of two languages is about 0.73.
LEAD_PERCENT = 1.0
UNDETERMINED = "und"


def train(docs: DataFrame, use: Column | None = None, id_col="doc_id", text_col="text", label_col="lang") -> dict[str, bytes]:
    """Language to dictionary, from rows with a label and a text for which ``use`` holds.

    Of each language the ``SAMPLE_DOCUMENTS`` ids that come first by their hash are
    drawn: first in each of ``STRATA`` parts of a language, then of what these keep,
    so that the last ranking reads at most STRATA * SAMPLE_DOCUMENTS ids of a language,
    however many rows and tasks there are.  Of an id's texts in a language the one with
    the smallest hash is taken, so the driver gets at most SAMPLE_DOCUMENTS texts a
    language.  Each distinct label is a language: a dictionary is made for all of them,
    and all go to every worker, so labels must be few.
    """
    rows = docs if use is None else docs.where(use)
    rows = rows.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(label_col).alias("l")).dropna()
    drawn = rows.select("l", "i").distinct().withColumn("part", F.pmod(F.xxhash64("i", F.lit("part")), F.lit(STRATA)))
    for group in (["l", "part"], ["l"]):
        ordered = Window.partitionBy(*group).orderBy(F.xxhash64("i"), "i")
        drawn = drawn.withColumn("n", F.row_number().over(ordered)).where(F.col("n") <= SAMPLE_DOCUMENTS).drop("n")
    # at most SAMPLE_DOCUMENTS rows a language
    taken = rows.join(F.broadcast(drawn.select("l", "i")), ["l", "i"]).select("l", "i", text_bytes(F.col("t")).alias("t"))
    n = F.octet_length("t")
    at = F.when(n > SAMPLE_BYTES, F.pmod(F.xxhash64("i"), n - SAMPLE_BYTES) + 1).otherwise(1)
    cut = taken.select("l", "i", F.xxhash64("t").alias("h"), F.substring("t", at.cast("int"), F.lit(SAMPLE_BYTES)).alias("t"))
    cut = cut.groupBy("l", "i").agg(F.min_by("t", F.struct("h", "t")).alias("t"))
    found: dict[str, list] = {}
    for r in sorted(cut.collect(), key=lambda r: (r["l"], str(r["i"]), bytes(r["t"]))):
        found.setdefault(r["l"], []).append(bytes(r["t"]))
    return {lang: _join(texts) for lang, texts in sorted(found.items())}


def _join(texts: list[bytes]) -> bytes:
    """The sample as one dictionary; each text gets the same room, those with less leave it to the others."""
    room, left, parts = DICTIONARY_BYTES, len(texts), []
    for t in sorted(texts, key=len):
        parts.append(t[: room // left])
        room, left = room - len(parts[-1]), left - 1
    return b"\n".join(parts).decode("utf-8", "replace").lower().encode()


def classifier(dictionaries: dict[str, bytes]):
    """A function of a text column that gives struct(lang_pred, score, sure).

    ``und`` with score 0 for null texts, texts without a letter, and where nothing
    was learned.  Of equal sizes the language that comes first in the alphabet wins.
    A text is judged once, whatever reads the result: marked as not deterministic, the
    function is not copied into a filter on it, which would take a second worker a task.
    """
    langs = sorted(dictionaries)
    names = ["lang_pred", "score", "sure"]

    @F.arrow_udf("struct<lang_pred: string, score: double, sure: boolean>")
    def judge(texts: pa.Array) -> pa.Array:
        kind = zstandard.DICT_TYPE_RAWCONTENT
        presses = []
        for lang in langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=kind)
            d.precompute_compress(level=LEVEL)
            params = {"dict_data": d, "level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            presses.append(zstandard.ZstdCompressor(**params).compress)
        preds, scores = [], []
        for text in texts.to_pylist():
            if not langs or not text or not any(map(str.isalpha, text)):
                preds.append(UNDETERMINED)
                scores.append(0.0)
                continue
            raw = text.lower().encode()
            blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
            sizes = np.array([sum(len(p(b)) for b in blocks) for p in presses], float)
            best = int(sizes.argmin())
            lead = 100 * (sizes / sizes[best] - 1) / LEAD_PERCENT
            preds.append(langs[best])
            scores.append(float(1 / np.exp(-lead).sum()))
        release_memory()
        columns = [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array([s >= MIN_SCORE for s in scores], pa.bool_())]
        return pa.StructArray.from_arrays(columns, names)

    return judge.asNondeterministic()


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, lang_pred, score, sure: one row per document, from its whole text alone.

    Repeated rows are judged each; an empty table gives no rows; other columns are
    not read, so a label beside the text has no say.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), classifier(dictionaries)(F.col(text_col)).alias("j"))
    return rows.select("doc_id", "j.lang_pred", "j.score", "j.sure")
