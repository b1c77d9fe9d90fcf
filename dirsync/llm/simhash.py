"""Near-duplicates by SimHash, with anchor points of a covering code.

The 64 bits are cut into three runs.  Of two fingerprints with at most four
differing bits, one run differs in at most one bit.  The anchors of a run are the
words of a code: a Hamming code of 15 bits, which covers every word within one
bit, beside the run's other bits as they are.  The anchor nearest to a fingerprint
is thus at most one bit away, and from every fingerprint that differs from it in
one bit at most two.  Each fingerprint is sent to all anchors within two bits of
it, so the two meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dirsync.session import materialise

from .common import release_memory, released, text_bytes
from .components import components

WORDS = 4
SEED = 42
THRESHOLD = 4
#: First bit and length of each run.
RUNS = ((0, 21), (21, 21), (42, 22))
CODE_BITS, RADIUS = 15, 1
#: Fingerprints that are compared with those of a bucket at once.
_BLOCK = 256
#: Rows of a bucket up to which all pairs are compared, and up to which that is done in steps over many buckets.
_WIDE, _NARROW = 4096, 32
#: Rows of a bucket that are compared with all behind them at once.
_ROWS = 128
#: Stands for a null in ``known``.
_UNKNOWN = -(2**63)


def shingle_hashes(text: bytes, width: int = WORDS) -> np.ndarray:
    """A hash of each shingle of ``width`` words, in their order; fewer words are one shingle, none give none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    upto = np.cumsum([len(w) + 1 for w in words])
    starts = (upto - np.fromiter((len(w) + 1 for w in words), np.int64, len(words)))[:n]
    ends = upto[-n:] - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, n)


def simhash(text: bytes) -> int:
    """Fingerprint of the text's shingles of four words; fewer words are one shingle, none give 0."""
    h = shingle_hashes(text)
    n = len(h)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(h, n // 65536 + 1):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    found = np.fromiter((simhash(t) for t in texts.to_pylist()), np.uint64, len(texts))
    release_memory()
    return pa.array(found.view(np.int64))


def fingerprint(text: Column) -> Column:
    """The fingerprint as a signed 64-bit number; a null text has no words."""
    return _fingerprints(text_bytes(text))


@lru_cache(maxsize=1)
def _near_words() -> list[list[np.ndarray]]:
    """[s][d]: what to add to a word of the Hamming code with syndrome s to reach the code words d bits away."""
    syndrome = lambda bits: int(np.bitwise_xor.reduce([b + 1 for b in bits])) if bits else 0
    reach = THRESHOLD // len(RUNS) + RADIUS
    found = [[[] for _ in range(reach + 1)] for _ in range(CODE_BITS + 1)]
    for d in range(reach + 1):
        for bits in combinations(range(CODE_BITS), d):
            found[syndrome(bits)][d].append(sum(1 << b for b in bits))
    return [[np.array(f, np.uint64) for f in row] for row in found]


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor key) for all anchors within radius and threshold, in every run."""
    near, reach = _near_words(), THRESHOLD // len(RUNS) + RADIUS
    owners, keys = [], []
    for run, (first, length) in enumerate(RUNS):
        word = (fp >> np.uint64(first)) & np.uint64((1 << length) - 1)
        coded = word & np.uint64((1 << CODE_BITS) - 1)
        syndrome = np.zeros(len(fp), np.int64)
        for b in range(CODE_BITS):
            syndrome ^= np.where((coded >> np.uint64(b)) & np.uint64(1), b + 1, 0)
        rest = length - CODE_BITS
        for e in range(reach + 1):
            flips = [sum(1 << (CODE_BITS + b) for b in bits) for bits in combinations(range(rest), e)]
            for s in range(CODE_BITS + 1):
                own = np.flatnonzero(syndrome == s)
                change = [int(c) ^ f for d in range(reach + 1 - e) for c in near[s][d] for f in flips]
                if len(own) and change:
                    reached = word[own, None] ^ np.array(change, np.uint64)[None, :]
                    owners.append(np.repeat(own, len(change)))
                    keys.append((reached | np.uint64(run << 32)).ravel().astype(np.int64))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(keys)


def own_runs(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, key) for the fingerprint's own word in every run."""
    words = [((fp >> np.uint64(first)) & np.uint64((1 << length) - 1)) | np.uint64(run << 32) for run, (first, length) in enumerate(RUNS)]
    return np.tile(np.arange(len(fp)), len(RUNS)), np.concatenate(words).astype(np.int64)


def spanning(fp: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that connect the fingerprints of a bucket as all links within the threshold do.

    Every fingerprint looks once at those not yet reached, and a reached one is
    taken out, so a dense group costs little and no pairs of it come out.
    """
    out_a, out_b = [], []
    left = np.arange(len(fp))
    queue: list[np.ndarray] = []
    while len(left):
        if not queue:
            queue.append(left[:1])
            left = left[1:]
        front = queue.pop()
        for i in range(0, len(front), _BLOCK):
            part = front[i : i + _BLOCK]
            if not len(left):
                break
            close = np.bitwise_count(fp[part, None] ^ fp[None, left]) <= threshold
            hit = close.any(axis=0)
            if hit.any():
                out_a.append(part[close[:, hit].argmax(axis=0)])
                out_b.append(left[hit])
                queue.append(left[hit])
                left = left[~hit]
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def _new(known: np.ndarray | None, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which rows i and j are not known to be connected."""
    return np.ones(len(i), bool) if known is None else (known[i] != known[j]) | (known[i] == _UNKNOWN)


def _close_pairs(fp: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j within the threshold, some rows at a time."""
    for a in range(0, len(fp), _ROWS):
        close = np.bitwise_count(fp[a : a + _ROWS, None] ^ fp[None, a:]) <= threshold
        np.fill_diagonal(close, False)
        linked = np.flatnonzero(close.any(axis=1))
        i, j = np.nonzero(close[linked])
        i = linked[i]
        yield i[i < j] + a, j[i < j] + a


def with_links(key: np.ndarray, fp: np.ndarray, threshold: int = THRESHOLD, known: np.ndarray | None = None) -> np.ndarray:
    """Which rows, sorted by key, have a link in their bucket that is not ``known``; all of a bucket with more than ``_WIDE`` rows count as such."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    found, end = np.repeat(sizes > _WIDE, sizes), np.repeat(starts + sizes, sizes)
    at, step = np.flatnonzero(np.repeat(sizes <= _NARROW, sizes)), 1
    while len(at := at[at + step < end[at]]):
        close = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= threshold]
        close = close[_new(known, close, close + step)]
        found[close] = found[close + step] = True
        step += 1
    for k in np.flatnonzero((sizes > _NARROW) & (sizes <= _WIDE)).tolist():
        a = starts[k]
        for i, j in _close_pairs(fp[a : a + sizes[k]], threshold):
            new = _new(known, a + i, a + j)
            found[a + i[new]] = found[a + j[new]] = True
    return found


def _all_links(fp: np.ndarray, known: np.ndarray, threshold: int, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Index pairs of all links of a bucket that are not known, None if there are more than ``most``."""
    out_a, out_b, n = [], [], 0
    for i, j in _close_pairs(fp, threshold):
        new = _new(known, i, j)
        out_a.append(i[new])
        out_b.append(j[new])
        n += len(out_a[-1])
        if n > most:
            return None
    return np.concatenate(out_a), np.concatenate(out_b)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Runs of whole buckets, from rows (anchor, fp, known or nothing) that come sorted by anchor."""
    held: list[np.ndarray] = []
    for batch in batches:
        own = [c.fill_null(_UNKNOWN).to_numpy(zero_copy_only=False) for c in batch.columns]
        rows = [np.concatenate(c) for c in zip(held, own, strict=True)] if held else own
        whole = np.searchsorted(rows[0], rows[0][-1]) if len(rows[0]) else 0
        if whole:
            yield [c[:whole] for c in rows]
        held = [c[whole:] for c in rows]
    if held and len(held[0]):
        yield held


def fingerprint_links(prints: DataFrame, threshold: int = THRESHOLD, meet=anchors, each: int = 0) -> DataFrame:
    """a, b: links between distinct fingerprints (column ``fp``) that connect what the threshold connects.

    All within THRESHOLD bits are found, and those of a higher threshold that have
    a run with at most two differing bits: up to eight bits all have one, as the
    word between two such runs is within a bit of an anchor.  A task holds one
    anchor's distinct fingerprints at a time.

    Fingerprints with the same value in a column ``known`` are connected by other
    links, and no links between them come out; nulls are not known.  With ``meet``
    as ``own_runs`` only those are compared that have a whole run in common.  All
    links of a bucket come out, not only some that connect the same, where they are
    at most ``each`` for each of its rows that has one.
    """
    more = [c for c in prints.columns if c == "known"]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            owner, key = meet(fp.view(np.uint64))
            rest = [batch.column(1).take(pa.array(owner))] if more else []
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[owner]), *rest], names=["anchor", "fp", *more])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, *rest in _buckets(batches):
            linked = with_links(key, fp.view(np.uint64), threshold, *rest)
            key, fp = key[linked], fp[linked].view(np.uint64)
            known = rest[0][linked] if rest else np.full(len(fp), _UNKNOWN)
            starts, found = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]), []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(key)]):
                order = a + np.argsort(fp[a:b])
                every = _all_links(fp[order], known[order], threshold, each * (b - a)) if each else None
                i, j = (order[k] for k in every or spanning(fp[order], threshold))
                new = (known[i] != known[j]) | (known[i] == _UNKNOWN)
                found.append((fp[i[new]], fp[j[new]]))
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    ddl = ", ".join(f"{c} bigint" for c in ("anchor", "fp", *more))
    at_anchors = prints.select("fp", *more).mapInArrow(released(replicate), ddl)
    sorted_ = at_anchors.repartition("anchor").sortWithinPartitions("anchor")
    return sorted_.mapInArrow(released(compare), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id: one row per document.

    Texts without words, null ones too, have fingerprint zero and are linked like
    any other.  ``component_id`` is the smallest doc_id that the document's
    fingerprint reaches by links; a row without doc_id never gives it.  Documents
    of one fingerprint are one member of the search, so groups of copies cost one
    row; a repeated doc_id keeps a row each.  An empty table gives no rows.  Other
    columns are not read.
    """
    prints = docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fp"))
    prints = materialise(prints, "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    groups = components(fingerprint_links(distinct)).withColumnRenamed("node", "fp")
    classes = distinct.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(smallest, "component").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(classes, "fp").select("doc_id", "fp", hexed, "component_id")
