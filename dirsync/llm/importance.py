"""Resampling of documents towards a target distribution of hashed features.

Features are runs of consecutive words, hashed by CRC-32 into buckets.  The hash
is linear: but for a constant of the length, it is the XOR of what each byte
contributes at its distance from the end.  These contributions come from a table,
so all features of a batch are hashed at once by one reduction over their spans.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dirsync.operators.ordering import numbered
from dirsync.session import materialise

from .common import ranges, released, small_batches, text_bytes

BUCKETS = 10_000
#: Longest run of words that is a feature.
MOST_WORDS = 1
SEED = 2024
MIN_WORDS = 20
#: Percent of the documents with MIN_WORDS words that are drawn.
PERCENT = 10
#: Distances from the end that the table holds; longer spans are folded in blocks of so many bytes.
DISTANCES = 64
#: Bytes of text that are hashed together.
BATCH_BYTES = 2_000_000


def _raw(message: bytes, state: int) -> int:
    """The register after a message, from a given state, without the final inversion."""
    return zlib.crc32(message, state ^ 0xFFFFFFFF) ^ 0xFFFFFFFF


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """[d][b]: what a byte b contributes with d bytes behind it."""
    rows = [[_raw(bytes([b]) + bytes(d), 0) for b in range(256)] for d in range(DISTANCES)]
    return np.array(rows, np.uint32)


@lru_cache(maxsize=64)
def _advance_table(n: int) -> np.ndarray:
    """[k][b]: the register after n zero bytes, if its byte k was b and the others zero."""
    zeros = bytes(n)
    return np.array([[_raw(zeros, b << (8 * k)) for b in range(256)] for k in range(4)], np.uint32)


def _advance(state: np.ndarray, n: int) -> np.ndarray:
    table = _advance_table(n)
    return np.bitwise_xor.reduce([table[k][(state >> np.uint32(8 * k)) & np.uint32(255)] for k in range(4)])


@lru_cache(maxsize=1)
def _length_table() -> np.ndarray:
    """The constant of each length within the table: the hash of so many zero bytes."""
    return np.array([zlib.crc32(bytes(n)) for n in range(DISTANCES + 1)], np.uint32)


def _length_constants(lengths: np.ndarray) -> np.ndarray:
    short = lengths <= DISTANCES
    out = _length_table()[np.where(short, lengths, 0)]
    for n in np.unique(lengths[~short]).tolist():
        out[lengths == n] = zlib.crc32(bytes(n))
    return out


def _span_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the table's contributions over spans of 1 to DISTANCES bytes."""
    at = ranges(starts, lengths)
    behind = np.repeat(starts + lengths - 1, lengths) - at
    heads = np.cumsum(lengths) - lengths
    return np.bitwise_xor.reduceat(position_table().reshape(-1)[behind * 256 + data[at]], heads)


def span_crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of the bytes; spans have at least one byte."""
    out = np.zeros(len(starts), np.uint32)
    if not len(starts):
        return out
    long = lengths > DISTANCES
    if not long.all():
        out[~long] = _span_sums(data, starts[~long], lengths[~long])
    for i in np.flatnonzero(long).tolist():
        out[i] = _folded(data, int(starts[i]), int(lengths[i]))
    return out ^ _length_constants(lengths)


def _folded(data: np.ndarray, start: int, length: int) -> int:
    """A long span: its blocks, counted from the end, are summed at once and then folded by pairs."""
    n = -(-length // DISTANCES)
    head = length - (n - 1) * DISTANCES
    sizes = np.full(n, DISTANCES, np.int64)
    sizes[0] = head
    state, width = _span_sums(data, start + np.cumsum(sizes) - sizes, sizes), DISTANCES
    while len(state) > 1:
        if len(state) % 2:  # zeros in front change nothing
            state = np.concatenate([np.zeros(1, np.uint32), state])
        state, width = _advance(state[::2], width) ^ state[1::2], width * 2
    return int(state[0])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def hashed_features(texts: list[bytes], most: int = MOST_WORDS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, features of each text, bucket of each feature in text order).

    Words are maximal runs of digits, letters and everything beyond ASCII, after
    A-Z are lower-cased; a feature is 1 to ``most`` of them joined by a blank.
    """
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    edges = np.flatnonzero(np.diff(_IN_WORD[data].view(np.int8), prepend=0, append=0)).reshape(-1, 2)
    starts, lengths = edges[:, 0], edges[:, 1] - edges[:, 0]
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    owner = np.searchsorted(ends, starts, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    if most == 1:
        return n_words, n_words, span_crc32(data, starts, lengths) % np.uint32(buckets)
    # words one after another with a blank between: a run of words is one span
    spaced = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    at = np.cumsum(lengths + 1) - lengths - 1
    spaced[ranges(at, lengths)] = data[ranges(starts, lengths)]
    owners, codes = [], []
    for k in range(1, min(most, len(at)) + 1):
        first, last = np.arange(len(at) - k + 1), np.arange(k - 1, len(at))
        inside = owner[first] == owner[last]
        first, last = first[inside], last[inside]
        owners.append(owner[first])
        codes.append(span_crc32(spaced, at[first], at[last] + lengths[last] - at[first]) % np.uint32(buckets))
    if not owners:
        return n_words, n_words, np.zeros(0, np.uint32)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return n_words, np.bincount(owner, minlength=len(texts)), np.concatenate(codes)[order]


def bucket_counts(texts: DataFrame, text_col="text", most: int = MOST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any.

    A task gives at most one row a bucket, so a row's text never travels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in small_batches(batches, 0, BATCH_BYTES):
            total += np.bincount(hashed_features(batch.column(0).to_pylist(), most, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select(text_bytes(F.col(text_col))).mapInArrow(released(run), "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Of each bucket floor(1000 ln(share in target / share in source)), both counts raised by one.

    The one thing that goes through the driver: two numbers a bucket.
    """
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, out in ((source, s), (target, t)):
        for bucket, n in counts.collect():
            out[bucket] = n
    total_s, total_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    ratio = (t + 1.0) * total_s / ((s + 1.0) * total_t)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col="doc_id", text_col="text", most: int = MOST_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1, BATCH_BYTES):
            n_words, sizes, codes = hashed_features(batch.column(1).to_pylist(), most, len(gain))
            upto = np.concatenate([[0], np.cumsum(gain[codes])])
            ends = np.cumsum(sizes)
            columns = [n_words, sizes, upto[ends] - upto[ends - sizes]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(F.col(text_col)))
    return rows.mapInArrow(released(run), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, drawn from the id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, most: int = MOST_WORDS,
    buckets: int = BUCKETS, seed: int = SEED, id_col="doc_id", text_col="text",
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null for those not drawn.

    ``weight`` sums the gains of the document's features towards the ``target``
    texts, ``score`` adds noise, and the highest scores are drawn: ``percent`` of
    the documents with ``min_words`` words, rounded down, ties to the smaller
    doc_id.  Null and empty texts have no features and weight 0; rows without
    doc_id share the noise of an empty id and rank behind equal scores; repeated
    rows count and rank each; an empty table gives no rows, an empty target the
    same share for every bucket.  Other columns are not read.

    Texts are read twice and never shuffled.  Ranks come from a range order of
    small rows, cut by their number.
    """
    gain = gains(bucket_counts(docs, text_col, most, buckets), bucket_counts(target, text_col, most, buckets), buckets)
    scored = weighted(docs, gain, id_col, text_col, most).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialise(scored, "scores")
    wanted = scored.where(F.col("n_words") >= min_words)
    drawn = percent * wanted.count() // 100
    # the last key tells equal rows apart, so that a much repeated id is cut as well
    ranked = wanted.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    ranked = numbered(ranked, "rank", F.desc("score"), F.asc_nulls_last("doc_id"), "tie")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    few = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank).unionByName(few.select(*columns, "rank"))
