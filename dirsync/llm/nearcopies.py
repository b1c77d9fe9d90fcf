"""Near copies by SimHash, settled by the Jaccard similarity of word shingles.

Texts with the same words are one member.  A member has several SimHash
fingerprints of its shingles.  Members whose fingerprints of one kind are close
are found by ``simhash.fingerprint_links``, by whole runs of bits and then at the
anchors of its covering code; what such links connect is a candidate group, and only members of a group that
pass an exact comparison of their shingle sets are linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirsync.session import materialise

from .common import ranges, release_memory, released, slices, text_bytes
from .components import components
from .simhash import fingerprint_links, own_runs, shingle_hashes

WORDS, LEAST = 5, 0.8
#: At a similarity of 0.8 a bit differs with a chance of 0.15, so about 10 of 64 do: a pair may miss in one fingerprint, seldom in all four.
PRINTS, NEAR = 4, 10
#: Of the bits of all fingerprints about 39 differ then, in the smallest sets 48, six more or less; of texts that have nothing in common about 120.
NEAR_ALL = 72
#: Links for each fingerprint up to which all those of an anchor are judged by the bits of all fingerprints.
EACH = 16
#: Shingles that are hashed at once.
_BLOCK = 4096
#: Shingles of other sets that a set is compared with at once.
_AT_ONCE = 1_000_000


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """The text's distinct shingles as sorted hashes; fewer words are one shingle, none give none."""
    return np.unique(shingle_hashes(text, words))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Each number as another one whose bits all depend on all of its bits."""
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def fingerprints(shingles: np.ndarray) -> np.ndarray:
    """The SimHash fingerprints, one of each kind; zeros for an empty set."""
    ones = np.zeros(64 * PRINTS, np.int64)
    for i in range(0, len(shingles), _BLOCK):
        part = shingles[i : i + _BLOCK]
        for k in range(PRINTS):
            bits = _mixed(part + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)).view(np.uint8).reshape(-1, 8)
            ones[64 * k : 64 * k + 64] += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles), bitorder="little").view(np.uint64)


def _sketches(words: int):
    @F.arrow_udf("struct<member: bigint, prints: array<bigint>>")
    def found(texts: pa.Array) -> pa.Array:
        members, prints = [], []
        for text in texts.to_pylist():
            members.append(xxhash.xxh3_64_intdigest(b" ".join(text.lower().split())))
            prints.append(fingerprints(shingle_set(text, words)).view(np.int64))
        release_memory()
        columns = [pa.array(np.array(members, np.uint64).view(np.int64)), pa.array(prints, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(columns, ["member", "prints"])

    return found


def _sets(words: int):
    @F.arrow_udf("binary")
    def found(texts: pa.Array) -> pa.Array:
        sets = pa.array([shingle_set(t, words).tobytes() for t in texts.to_pylist()], pa.binary())
        release_memory()
        return sets

    return found


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(members, their bytes) of each key with several members, from rows (key, member, bytes) sorted by all of key and member."""
    key, members, values = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, own, data = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            if keys[a] != key:
                if len(members) > 1:
                    yield np.array(members), values
                key, members, values = keys[a], [], []
            if b - a > 1 or members or b == len(keys) or a == 0:
                for m, v in zip(own[a:b].tolist(), data.slice(a, b - a).to_pylist(), strict=True):
                    if not members or members[-1] != m:
                        members.append(m)
                        values.append(v)
    if len(members) > 1:
        yield np.array(members), values


def set_links(sets: list[np.ndarray], least: float = LEAST) -> tuple[list[int], list[int]]:
    """Index pairs that connect the sets as all pairs with a Jaccard similarity of ``least`` or more do.

    Such a pair has a shingle in common among the rarest ones of each, of which a
    set has as many as it may lack and one more.  So a set is compared with those
    that it meets there often enough and that are not reached yet.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return [], []
    values, flat, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int32)
    rank[np.argsort(times, kind="stable")] = np.arange(len(values), dtype=np.int32)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    flat = rank[flat]
    flat = flat[np.lexsort((flat, owner))]
    starts = np.cumsum(sizes) - sizes
    rare = np.where(sizes > 0, sizes - np.ceil(least * sizes - 1e-6).astype(np.int64) + 1, 0).clip(0, sizes)
    at = ranges(starts, rare)
    at = at[np.argsort(flat[at], kind="stable")]
    own, held = np.zeros(len(values), bool), 0
    left, first = np.ones(len(sets), bool), 0
    out_a, out_b, queue = [], [], []
    while queue or first < len(sets):
        if not held or left.sum() < 0.8 * held:
            at = at[left[owner[at]]]
            meeting, upto, held = owner[at], np.cumsum(np.bincount(flat[at], minlength=len(values))), max(1, left.sum())
        if not queue:
            if left[first]:
                left[first] = False
                queue.append(first)
            first += 1
            continue
        i = queue.pop()
        mine = flat[starts[i] : starts[i] + sizes[i]]
        lists = mine[: rare[i]]
        begin = np.where(lists > 0, upto[lists - 1], 0)
        times = np.bincount(meeting[ranges(begin, upto[lists] - begin)], minlength=len(sets))
        met = np.flatnonzero((times > 0) & left)
        # behind the rare shingles of the one or the other, no more than all of it can be common
        behind = np.maximum(sizes[i] - rare[i], sizes[met] - rare[met])
        met = met[times[met] + behind >= least / (1 + least) * (sizes[i] + sizes[met]) - 1e-6]
        own[mine] = True
        for part in slices(sizes[met].tolist(), _AT_ONCE):
            some = met[part]
            before = np.cumsum(sizes[some]) - sizes[some]
            common = np.add.reduceat(own[flat[ranges(starts[some], sizes[some])]], before, dtype=np.int64)
            hit = some[common >= least * (sizes[i] + sizes[some] - common) - 1e-9]
            out_a += [i] * len(hit)
            out_b += hit.tolist()
            queue += hit.tolist()
            left[hit] = False
        own[mine] = False
    return out_a, out_b


def _digests(columns: list[str]) -> list:
    """Two hashes over all columns, nulls marked."""
    marked = [c for n in columns for c in (F.col(n).isNull(), F.col(n))]
    return [F.xxhash64(F.lit(seed), *marked).alias(f"row{seed}") for seed in (0, 1)]


ROW = ["row0", "row1"]


def close_members(members: DataFrame, near_all: int = 64 * PRINTS) -> DataFrame:
    """a, b: links between members that connect those with a fingerprint of one kind in common but for ``NEAR`` bits.

    Links whose ends differ in more than ``near_all`` bits of all kinds are left out.
    First those that have a whole run of bits in common are connected, at three
    places each; the search at all anchors then gives only links between groups that
    this leaves apart.  So a dense group gives few links, not one for each anchor of
    each member.
    """
    kinds, links = [], []
    for kind in range(PRINTS):
        own = members.select(F.col("prints")[kind].alias("fp"), "member")
        classes = own.groupBy("fp").agg(F.min("member").alias("first"))
        kinds.append(classes)
        links.append(_ends(fingerprint_links(classes, NEAR, own_runs, EACH), classes))
        links.append(own.join(classes, "fp").where("member != first").select(F.col("first").alias("a"), F.col("member").alias("b")))
    near = _near_in_all(reduce(DataFrame.unionByName, links), members, near_all)
    known = components(near).withColumnRenamed("node", "first").withColumnRenamed("component", "known")
    known = materialise(known, "close")
    links = []
    for classes in kinds:
        classes = classes.join(known, "first", "left")
        links.append(_ends(fingerprint_links(classes, NEAR, each=EACH), classes))
    near = _near_in_all(reduce(DataFrame.unionByName, links), members, near_all)
    return known.where("first != known").select(F.col("known").alias("a"), F.col("first").alias("b")).unionByName(near).distinct()


def _ends(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between fingerprints as links between the first members that have them."""
    end = lambda c: classes.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_member"))
    return found.join(end("a"), "a").join(end("b"), "b").select(F.col("a_member").alias("a"), F.col("b_member").alias("b"))


def _near_in_all(links: DataFrame, members: DataFrame, near_all: int) -> DataFrame:
    """The links whose ends differ in at most ``near_all`` bits of all their fingerprints."""
    end = lambda c: members.select(F.col("member").alias(c), F.col("prints").alias(f"{c}_prints"))
    differ = sum((F.bit_count(F.col("a_prints")[k].bitwiseXOR(F.col("b_prints")[k])) for k in range(PRINTS)), F.lit(0))
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(end("a"), "a").join(end("b"), "b").where(differ <= near_all).select("a", "b")


def near_copy_links(docs: DataFrame, members: DataFrame, text_col: str, words: int, least: float) -> DataFrame:
    """a, b: links between close members that connect what ``least`` connects; a task holds the sets of one group at a time.

    Members close by chance in one kind do not count: their number grows with the
    square of the texts, and their links would make one group of very many.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, values in _runs(batches):
            a, b = set_links([np.frombuffer(v, np.uint64) for v in values], least)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(own[b])], names=["a", "b"])

    groups = components(close_members(members, NEAR_ALL)).select(F.col("component").alias("meeting"), F.col("node").alias("member"))
    wanted = groups.join(members.select("member", "row.*"), "member")
    texts = docs.select(*_digests(docs.columns), text_bytes(F.col(text_col)).alias("t")).join(wanted, ROW)
    texts = texts.dropDuplicates(["member"])
    dealt = texts.select("meeting", "member", _sets(words)(F.col("t")).alias("shingles"))
    dealt = dealt.repartition("meeting").sortWithinPartitions("meeting", "member")
    return dealt.mapInArrow(released(settle), "a bigint, b bigint").distinct()


def drop_copies(docs: DataFrame, words: int = WORDS, least: float = LEAST, id_col="doc_id", text_col="text") -> DataFrame:
    """One row of each group of near copies, all columns.

    Texts whose sets of shingles have a Jaccard similarity of ``least`` or more are
    linked, and what links reach is a group; texts without words are one group.
    The row with the smallest id stays, of those the one with the smallest hash of
    the text, then of the row; rows without id come last, and stay where the group
    has no other.  Rows that share an id are judged each by its text.  Of equal
    rows one stays.  An empty table gives no rows.
    """
    columns = docs.columns
    found = docs.select(*_digests(columns), F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"), _sketches(words)(text_bytes(F.col(text_col))).alias("s"))
    found = materialise(found.select("row0", "row1", "i", "h", "s.*"), "sketches")
    row = F.struct(*ROW)
    members = found.groupBy("member").agg(F.min_by("prints", row).alias("prints"), F.min(row).alias("row"))
    members = materialise(members.select("member", "row", "prints"), "members")
    groups = components(near_copy_links(docs, members, text_col, words, least)).withColumnRenamed("node", "member")

    rows = found.groupBy("member", "i", "h", *ROW).agg(F.count("*").alias("times")).join(groups, "member", "left")
    first = F.struct(F.col("i").isNull().alias("last"), "i", "h", *ROW)
    kept = rows.groupBy(F.coalesce("component", "member").alias("component")).agg(F.min(F.struct(first.alias("first"), "times")).alias("k"))
    kept = kept.select("k.first.row0", "k.first.row1", "k.times")
    taken = docs.select("*", *_digests(columns)).join(kept, ROW)
    single, equal = taken.where("times = 1"), taken.where("times > 1")
    return single.select(*columns).unionByName(equal.dropDuplicates(ROW).select(*columns))
