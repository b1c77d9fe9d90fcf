"""Groups of spelling variants, found in a trie of letter counts.

A word's vector says how many letters of each group it has.  One inserted letter
raises one count by one; a replaced letter may also lower another.  The words are
arranged in a trie, a level for each group, and a search goes down it with a
budget of one surplus and one deficit; the words at the leaves it reaches are
compared letter by letter.

Each pair is found once, from the word whose vector is smaller: the surplus is
spent before the deficit, and at equal vectors the words decide.  The first levels
deal the trie out to shards; a word visits all shards that hold a subtree within
its budget.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirsync.operators.lookups import lookup
from dirsync.session import materialise

from .common import ranges, released, small_batches, text_bytes

#: Letters of the trie's levels; the last level holds all other letters.
GROUPS = ("e", "n", "t", "i", "a", "r", "s", "o", "h", "l", "d", "u", "c", "m", "g", "p", "bf", "kvw", "jqxyz")
#: Levels that choose a shard.
DEALT = 4
#: Words of a shard at most, on average.
SHARD_WORDS = 200_000
MIN_LETTERS, MIN_COUNT = 7, 2
#: A form is so many times as frequent as its variant at least.
FACTOR = 10
#: One occurrence in so many loses a letter.
ONE_IN = 31
#: Distinct words that a task counts before it hands them on, and bytes of text at once.
HELD_WORDS, BATCH_BYTES = 300_000, 4_000_000
#: Places of the trie, or pairs of letters, that are looked at together.
BLOCK, LETTERS = 200_000, 4_000_000

_LOWER = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
#: a-z and U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_GROUP = np.full(256, len(GROUPS), np.int64)
for _level, _letters in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters]] = _level
LEVELS = len(GROUPS) + 1


def altered(run: bytes, h: int) -> bytes:
    """A run whose hash ONE_IN divides, without its letter number h modulo its length."""
    if run.isascii():
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def letters_of(word: bytes) -> int:
    return len(word) if word.isascii() else len(word.decode())


def count_words(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """word, n: the words of MIN_LETTERS letters that occur MIN_COUNT times in all texts.

    Occurrences are counted in the task before they are exchanged.
    """
    none = (1 << 32) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in small_batches(batches, 1, BATCH_BYTES):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                head = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for word, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
                    h = zlib.crc32(word, head) & none
                    if not h % ONE_IN:
                        word = altered(word, h)
                    if len(word) >= MIN_LETTERS:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield _counted(held)
                held.clear()
        yield _counted(held)

    rows = docs.select(F.col(id_col).cast("bigint"), text_bytes(F.col(text_col)))
    found = rows.mapInArrow(released(run), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= MIN_COUNT)


def _counted(held: Counter[bytes]) -> pa.RecordBatch:
    words = [w for w in held if letters_of(w) >= MIN_LETTERS]
    counts = [held[w] for w in words]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])


class Words:
    """Words one after another in a byte a letter, with their counts and vectors."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(self.sizes) - self.sizes
        owner = np.repeat(np.arange(len(words)), self.sizes)
        self.vectors = np.bincount(owner * LEVELS + _GROUP[self.data], minlength=len(words) * LEVELS).reshape(-1, LEVELS)

    def __len__(self) -> int:
        return len(self.words)

    def take(self, at: np.ndarray) -> Words:
        return Words([self.words[i] for i in at.tolist()], self.n[at])

    def press(self) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(len(self.n).to_bytes(8, "little") + self.n.astype("<i8").tobytes() + b"\n".join(self.words))

    @classmethod
    def unpressed(cls, blobs: list[bytes]) -> Words:
        words, counts = [], [np.zeros(0, np.int64)]
        for blob in blobs:
            raw = zstandard.ZstdDecompressor().decompress(blob)
            n = int.from_bytes(raw[:8], "little")
            counts.append(np.frombuffer(raw, "<i8", n, 8))
            words += raw[8 + 8 * n :].split(b"\n")
        return cls(words, np.concatenate(counts))


def _shard(top: np.ndarray, n: int) -> np.ndarray:
    """The shard of each row of counts of the dealt levels."""
    h = np.zeros(len(top), np.uint64)
    for column in top.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(n)).astype(np.int64)


#: What the counts of the dealt levels of a larger neighbour may have more.
_STEPS = [np.zeros(DEALT, np.int64)]
for _g in range(DEALT):
    _STEPS.append(np.eye(DEALT, dtype=np.int64)[_g])
    _STEPS += [np.eye(DEALT, dtype=np.int64)[_g] - np.eye(DEALT, dtype=np.int64)[_h] for _h in range(_g + 1, DEALT)]

OWN, VISITOR = 0, 1


def visits(words: Words, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(shard, kind, numbers of words): a word is in its own shard, and visits those with a subtree in reach, once each."""
    top = words.vectors[:, :DEALT]
    own = _shard(top, n)
    reached = np.stack([np.where((top + step >= 0).all(axis=1), _shard(np.maximum(top + step, 0), n), own) for step in _STEPS], axis=1)
    reached.sort(axis=1)
    first = np.concatenate([np.ones((len(words), 1), bool), reached[:, 1:] != reached[:, :-1]], axis=1)
    visitor = first & (reached != own[:, None])
    number = np.broadcast_to(np.arange(len(words))[:, None], reached.shape)
    for kind, shard, who in ((OWN, own, np.arange(len(words))), (VISITOR, reached[visitor], number[visitor])):
        order = np.argsort(shard, kind="stable")
        shard, who = shard[order], who[order]
        at = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
        for a, b in zip(at, [*at[1:], len(shard)]):
            yield int(shard[a]), kind, who[a:b]


class Trie:
    """The words of a shard in the order of their vectors; a node is a number within its level."""

    def __init__(self, words: Words):
        order = np.lexsort(words.vectors.T[::-1])
        self.words = words.take(order)
        v = self.words.vectors
        self.base = int(v.max(initial=0)) + 2
        node = np.zeros(len(v), np.int64)
        self.children = []
        for level in range(LEVELS):
            key = node * self.base + v[:, level]
            distinct, node = np.unique(key, return_inverse=True)
            self.children.append(distinct)
        self.first = np.searchsorted(node, np.arange(len(self.children[-1]) + 1))

    def near(self, queries: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of queries, numbers of words) of all pairs one letter apart, from the smaller side."""
        n = len(queries)
        if not len(self.words) or not n:
            return
        zero = np.zeros(n, np.int64)
        stack = [(0, np.arange(n), zero, zero)]  # level, query, node, spent: nothing, the surplus, both
        while stack:
            level, query, node, spent = stack.pop()
            if len(query) > BLOCK:
                half = len(query) // 2
                stack += [(level, query[half:], node[half:], spent[half:]), (level, query[:half], node[:half], spent[:half])]
                continue
            if level == LEVELS:
                yield from self._leaves(queries, query, node, spent)
                continue
            count, known, out = queries.vectors[query, level], self.children[level], []
            for change in (0, 1, -1):
                who = slice(None) if not change else np.flatnonzero(spent == (0 if change > 0 else 1))
                want = count[who] + change
                key = node[who] * self.base + want
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = (known[at] == key) & (want >= 0) & (want < self.base)
                out.append((query[who][hit], at[hit], spent[who][hit] + abs(change)))
            query, node, spent = (np.concatenate(x) for x in zip(*out, strict=True))
            if len(query):
                stack.append((level + 1, query, node, spent))

    def _leaves(self, queries: Words, query, node, spent) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = self.first[node + 1] - self.first[node]
        upto = np.cumsum(sizes * (queries.sizes[query] + 1))
        for part in np.split(np.arange(len(query)), np.flatnonzero(np.diff(upto // LETTERS)) + 1):
            number = np.repeat(query[part], sizes[part])
            word = ranges(self.first[node[part]], sizes[part])
            paid = np.repeat(spent[part], sizes[part])
            for kind, test in ((0, _replaced), (1, _inserted), (2, _replaced)):
                own = np.flatnonzero(paid == kind)
                own = own[test(queries, number[own], self.words, word[own])]
                a, b = number[own], word[own]
                if not kind:  # equal vectors: each pair once
                    mine = np.fromiter((queries.words[i] < self.words.words[j] for i, j in zip(a.tolist(), b.tolist())), bool, len(a))
                    a, b = a[mine], b[mine]
                if len(a):
                    yield a, b


def _replaced(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether the words, which have as many letters, differ in one place."""
    if not len(i):
        return np.zeros(0, bool)
    size = a.sizes[i]
    differ = a.data[ranges(a.starts[i], size)] != b.data[ranges(b.starts[j], size)]
    return np.add.reduceat(differ.astype(np.int64), np.cumsum(size) - size) == 1


def _inserted(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether b's word is a's with one letter more."""
    if not len(i):
        return np.zeros(0, bool)
    size = a.sizes[i]
    left, at = a.data[ranges(a.starts[i], size)], ranges(b.starts[j], size)
    place, heads = ranges(np.zeros(len(i), np.int64), size), np.cumsum(size) - size
    before = np.minimum.reduceat(np.where(left != b.data[at], place, np.repeat(size, size)), heads)
    behind = np.maximum.reduceat(np.where(left != b.data[at + 1], place, -1), heads)
    return behind < before


def near_pairs(words: DataFrame, shards: int) -> DataFrame:
    """word, near, near_n: both directions of all pairs of words one letter apart.

    A task keeps the words of its shard; those that visit it stream by.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = Words([w.encode("latin-1") for w in batch.column(0).to_pylist()], batch.column(1).to_numpy())
            for shard, kind, who in visits(own, shards):
                columns = [pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([own.take(who).press()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "kind", "blob"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, trie = None, [], None
        for batch in batches:
            for s, kind, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if s != shard:
                    if trie is None:
                        yield from found(held)
                    shard, held, trie = s, [], None
                if kind == OWN:
                    held.append(blob)
                    continue
                if trie is None:
                    trie = yield from found(held)
                yield from pairs(trie, Words.unpressed([blob]))
        if trie is None:
            yield from found(held)

    def found(held: list[bytes]):
        """The pairs within the shard; returns its trie."""
        trie = Trie(Words.unpressed(held))
        yield from pairs(trie, trie.words)
        return trie

    def pairs(trie: Trie, queries: Words) -> Iterator[pa.RecordBatch]:
        for i, j in trie.near(queries):
            a, b = ([w.words[k].decode("latin-1") for k in x.tolist()] for w, x in ((queries, i), (trie.words, j)))
            counts = np.concatenate([trie.words.n[j], queries.n[i]])
            yield pa.RecordBatch.from_arrays([pa.array(a + b, pa.string()), pa.array(b + a, pa.string()), pa.array(counts)], names=["word", "near", "near_n"])

    dealt = words.select("word", "n").mapInArrow(released(deal), "shard int, kind int, blob binary")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(released(search), "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms of (word, form) lead.

    A form is FACTOR times as frequent as the word at least, so a chain of counts
    below 2**63 has fewer than 32 steps, and five doublings reach its end.
    """
    found = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(5):
        further = found.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        found = lookup(found, further, F.col("root"), "__w", pos="word")
        found = materialise(found.select("word", F.coalesce("__r", "root").alias("root")), "roots")
    return found


def spelling_variants(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """word, form, root, n, n_near, form_n: every frequent word with the word that it is a variant of.

    ``n_near`` counts the words one letter apart, ``form`` is the most frequent of
    them (ties: the first in code-point order) if it is FACTOR times as frequent,
    ``root`` follows forms to the last.  Null and empty texts have no words; a row
    without doc_id has an empty id; repeated rows count each; very long words are
    words; an empty table gives no rows.  Other columns are not read.
    """
    words = materialise(count_words(docs, id_col, text_col), "words")
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words.count() // SHARD_WORDS))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form")))
    near = near_pairs(words, shards).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= FACTOR * F.col("n")
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    known = materialise(known, "variants")
    led = known.join(roots(known.where("form IS NOT NULL")), "word", "left")
    return led.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
