"""Byte-pair encoding by speculation and check, and decoding.

Greedy longest match proposes the tokens of each word.  A sequence of tokens is
what merging by rank gives if, and only if, each two neighbours are what merging
gives for the two of them; this is tested for all pairs of neighbours at once.
Only words with a pair that fails are merged by rank.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes
from .encoding import SegmentEncoder

def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Merges:
    """Vocabulary and merges as arrays: children, rank of the merge that makes a token, rank by pair."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        self.end = end
        size = max(vocab.values()) + 1
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.born = np.full(size, -1)
        self.inner: dict[str, int] = {}
        self.last: dict[str, int] = {}
        for letter in byte_letters():
            if letter in vocab:
                self.inner[letter] = vocab[letter]
            if letter + end in vocab:
                self.last[letter] = vocab[letter + end]
        is_last = set(self.last.values()) if end else set()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for n, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.rank[x, y] = (n, made)
            if self.born[made] < 0:
                self.left[made], self.right[made], self.born[made] = x, y, n
                if y in is_last:
                    is_last.add(made)
                    self.last[(a + b).removesuffix(end)] = made
                else:
                    self.inner[a + b] = made
        if not end:
            self.last = self.inner
        self.longest = max(map(len, [*self.inner, *self.last]))
        keys = np.array([x * size + y for x, y in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.rank.values()])[order]
        self.size = size

    def propose(self, word: str) -> list[int]:
        """Longest match first; ``word`` in byte letters, not empty."""
        out, at, n = [], 0, len(word)
        while at < n:
            if n - at <= self.longest and (found := self.last.get(word[at:])) is not None:
                out.append(found)
                break
            for upto in range(min(n - 1, at + self.longest), at, -1):
                if (found := self.inner.get(word[at:upto])) is not None:
                    out.append(found)
                    at = upto
                    break
            else:
                raise ValueError(f"the vocabulary lacks the byte {word[at]!r}")
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the letters of a and b by rank gives just a and b.

        Both tokens are unmade from the latest merge back, which shows each pair
        of parts that ever met at the seam.  The pair would have been merged, had
        its rank come before the merges that used the parts up; of equal ranks the
        left place goes first.
        """
        a, b = a.copy(), b.copy()
        never = np.iinfo(np.int64).max
        used_a, used_b = np.full(len(a), never), np.full(len(b), never)
        good, live = np.ones(len(a), bool), np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], never)
            fails = (rank < used_a[live]) & (rank <= used_b[live]) & (rank != never)
            good[live[fails]] = False
            later_a = self.born[x] > self.born[y]
            done = fails | ((self.born[x] < 0) & (self.born[y] < 0))
            i = live[later_a & ~done]
            used_a[i], a[i] = self.born[a[i]], self.right[a[i]]
            i = live[~later_a & ~done]
            used_b[i], b[i] = self.born[b[i]], self.left[b[i]]
            live = live[~done]
        return good

    def merge(self, word: str) -> list[int]:
        """Exact merging: the lowest rank first, of equal ranks the leftmost."""
        ids = [self.inner[c] for c in word[:-1]] + [self.last[word[-1]]]
        after, before = list(range(1, len(ids))) + [-1], list(range(-1, len(ids) - 1))
        heap = [(self.rank[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = self.rank[x, y][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (ids[p], ids[q]) in self.rank:
                    heapq.heappush(heap, (self.rank[ids[p], ids[q]][0], p, ids[p], ids[q]))
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        found = [self.propose(w) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(found)), sizes)
        inside = owner[1:] == owner[:-1]
        pairs, owner = (flat[:-1] * self.size + flat[1:])[inside], owner[:-1][inside]
        distinct, back = np.unique(pairs, return_inverse=True)
        bad = ~self.compatible(distinct // self.size, distinct % self.size)
        for i in np.unique(owner[bad[back]]).tolist():
            found[i] = self.merge(words[i])
        return found


class SpeculativeEncoder(SegmentEncoder):
    """Encodes and decodes with a tokenizer file whose words end in a marked letter.

    Reads a file with NFC, white space and lower case as normalizers, a split
    pattern that keeps matches, byte letters, and merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, steps = made["model"], made["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in made["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or steps[0]["behavior"] != "Removed" or made["decoder"] is not None:
            raise ValueError("this tokenizer file has other steps than this encoder knows")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.letters = dict(enumerate(byte_letters()))
        vocab = dict(model["vocab"])
        self.merges = Merges(vocab, model["merges"], model.get("end_of_word_suffix") or "")
        self.specials = {t["content"]: t["id"] for t in made["added_tokens"]}
        vocab |= self.specials
        self.tokens = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        super().__init__(lambda t: [s for s in t.replace("\n", " ").split(" ") if s])
        self.words: dict[str, list[int]] = {}
        self.path = path

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _parts(self, segment: str) -> list[str | int]:
        """Words in byte letters, and the ids of special tokens."""
        out: list[str | int] = []
        pieces = self.around.split(segment) if self.specials and "<" in segment else [segment]
        for piece in pieces:
            if piece in self.specials:
                out.append(self.specials[piece])
                continue
            if not piece.isascii() and any(unicodedata.combining(c) or unicodedata.category(c) == "Cn" for c in piece):
                # Unicode versions differ here: the library knows how it orders marks and what it counts as letters
                piece = self.library.normalizer.normalize_str(piece)
                out += [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(piece)]
                continue
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")  # sigma, whatever its place
            for word in self.pattern.findall(piece.lower()):
                plain = word.isascii() and word.isprintable()
                out.append(word if plain else word.encode().decode("latin-1").translate(self.letters))
        return out

    def learn(self, segments):
        parts = [self._parts(s) for s in segments]
        if len(self.words) > self.kept:
            self.words.clear()
        new = list({w for p in parts for w in p if isinstance(w, str)} - self.words.keys())
        self.words.update(zip(new, self.merges.encode_words(new), strict=True))
        return [[i for w in p for i in (self.words[w] if isinstance(w, str) else (w,))] for p in parts]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a blank, special ones included, as a file without decoder asks for."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def speculative_encoder(path: str) -> SpeculativeEncoder:
    return SpeculativeEncoder(path)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])


def encode_and_decode(docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by a blank) and the text decoded from them, for every whole text.

    Null and empty texts have no ids and decode to the empty text; rows that share
    a doc_id are encoded each; an empty table gives no rows; other columns are not
    read.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = speculative_encoder(tokenizer)
        decimal = [str(i) for i in range(len(encoder.tokens))]
        for batch in batches:
            texts = batch.column(1).cast(pa.string()).to_pylist()
            flat, sizes = encoder.encode(texts)
            rows, at = ([], []), 0
            done = 0
            for i, n in enumerate(sizes.tolist()):
                ids = flat[at : at + n].tolist()
                at += n
                rows[0].append(" ".join(map(decimal.__getitem__, ids)))
                rows[1].append(encoder.decode(ids))
                if len(rows[0]) >= 500 or i == len(sizes) - 1:
                    upto = done + len(rows[0])
                    head = [batch.column(0).slice(done, upto - done).cast(pa.int64()), pa.array(sizes[done:upto], pa.int64())]
                    yield pa.RecordBatch.from_arrays([*head, *(pa.array(r, pa.string()) for r in rows)], schema=_OUT)
                    rows, done = ([], []), upto

    rows = docs.select(F.col(id_col).cast("bigint"), text_bytes(F.col(text_col)))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids string, decoded string")
