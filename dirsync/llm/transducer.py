"""Token counts by a tokenizer compiled into a finite-state transducer.

The transducer reads lower-case UTF-8.  A state holds what is open: the kind of
word, the last letters that can still begin a token, and for each place among
them the last token of the encoding up to there.  Of the tokens that end at a new
letter one is compatible with the token before it; it is the last one of the
longer encoding.  A transition is annotated with how many tokens it emits, or
takes back, so a text's tokens are the sum along its path.  White space always
leads to the state with nothing open.  States and transitions are compiled as
texts ask for them and kept for the worker's later texts.

Texts are cut into chunks that advance side by side.  The state map of a chunk is
a constant behind its first white space; only its head depends on the state that
the chunk is entered in.  So all chunks are read at once from there, and a scan
composes the maps: each head is read from the end state of the chunk before.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Merges, byte_letters
from .common import released, small_batches, text_bytes

CHUNK = 128
#: Bytes of text that are read together.
BATCH_BYTES = 2_000_000
#: States that are kept from batch to batch, and those that one batch may add before it is cut.
KEPT_STATES, ADDED_STATES = 100_000, 150_000
#: So few chunks are read one after another.
FEW = 12

LIMIT = 2048
SPACE, APOSTROPHE = 32, 39
#: Kinds of characters; the lead byte of one beyond ASCII carries its kind.
LETTER, OTHER, NUMBER, BLANK, UNSEEN = range(5)
SYMBOLS = 256 + 2 * 64
#: What is open: nothing, letters, a run of others, an apostrophe that may begin a contraction, a word that ends with this character.
NONE, LETTERS, RUN, MARK, SINGLE = range(5)
#: The pattern's contractions.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Characters whose lower case is one character and which NFC leaves as they are.
_SIMPLE = re.compile("[\\x00-įı-ɏ‐-‧‰-⁞€]*")


class Overflow(Exception):
    """A batch asks for more states than it may add."""


class Transducer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, steps = made["model"], made["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in made["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or steps[0]["pattern"].get("Regex") != _PATTERN:
            raise ValueError("this tokenizer file has other steps than the compiler knows")
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(dict(model["vocab"]), model["merges"], model.get("end_of_word_suffix") or "")
        self.letters = byte_letters()
        self.left, self.right, self.born = (x.tolist() for x in (self.merges.left, self.merges.right, self.merges.born))
        self.begins = {t[:i] for t in (*self.merges.inner, *self.merges.last) for i in range(len(t) + 1)}
        special = sorted((t["content"] for t in made["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)).encode() or rb"(?!)")
        self.special_begins = {s.encode()[:1] for s in special}
        self.kinds = np.full(0x110000, UNSEEN, np.uint8)
        for c in range(128):
            text = chr(c)
            self.kinds[c] = LETTER if text.isalpha() else NUMBER if text.isdigit() else BLANK if c in (9, 10, 11, 12, 13, 32) else OTHER
        self.agree: dict[tuple[int, int], bool] = {}
        self.ends: dict[tuple, int] = {}
        self.column = np.full(SYMBOLS, -1, np.int64)
        self.symbols: list[int] = []
        self.width = 64
        self.clear()

    # Compilation.

    def clear(self) -> None:
        """Only the state with nothing open is left, number 0."""
        self.numbers, self.keys = {(NONE, None): 0}, [(NONE, None)]
        self.table = np.full((1024, self.width), -1, np.int32)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the letters of two tokens by rank gives just these two.

        The tokens are unmade from the latest merge back; no pair of parts that
        meets at the seam may have been merged before its parts were used up.
        """
        known = self.agree.get((a, b))
        if known is not None:
            return known
        x, y, used_x, used_y, good = a, b, None, None, True
        while True:
            pair = self.merges.rank.get((x, y))
            if pair is not None and (used_x is None or pair[0] < used_x) and (used_y is None or pair[0] <= used_y):
                good = False
                break
            if self.born[x] < 0 and self.born[y] < 0:
                break
            if self.born[x] > self.born[y]:
                used_x, x = self.born[x], self.right[x]
            else:
                used_y, y = self.born[y], self.left[y]
        self.agree[a, b] = good
        return good

    #: An open word: its last letters that begin a token; the last token at each place among them, -1 at the word's
    #: start; and the tokens up to that place, less those up to the end.
    EMPTY = ("", (-1,), (0,))

    def further(self, word: tuple, letter: str) -> tuple[tuple, int]:
        """The word with one letter more, and by how many its tokens grow."""
        text, tokens, counts = word
        text += letter
        for place, before in enumerate(tokens):
            token = self.merges.inner.get(text[place:])
            if token is not None and (before < 0 or self.compatible(before, token)):
                break
        else:
            raise ValueError(f"the vocabulary lacks the letter {letter!r}")
        grown = counts[place] + 1
        tokens, counts = (*tokens, token), (*(c - grown for c in counts), 0)
        cut = 0
        while text[cut:] not in self.begins:
            cut += 1
        return (text[cut:], tokens[cut:], counts[cut:]), grown

    def closed(self, word: tuple) -> int:
        """By how many the tokens grow when the word ends."""
        grown = self.ends.get(word)
        if grown is None:
            text, tokens, counts = word
            for place, before in enumerate(tokens[:-1]):
                token = self.merges.last.get(text[place:])
                if token is not None and (before < 0 or self.compatible(before, token)):
                    grown = counts[place] + 1
                    break
            else:
                raise ValueError(f"no token ends the word after {text!r}")
            if len(self.ends) < KEPT_STATES:
                self.ends[word] = grown
        return grown

    def opened(self, text: str) -> tuple[tuple, int]:
        word, total = self.EMPTY, 0
        for letter in text:
            word, grown = self.further(word, letter)
            total += grown
        return word, total

    def follow(self, key: tuple, symbol: int) -> tuple[tuple, int]:
        """(state, tokens emitted) after a symbol."""
        kind, word = key
        if 128 <= symbol < 192:  # a character goes on
            word, grown = self.further(word, self.letters[symbol])
            return (kind, word), grown
        if symbol < 128:
            what, letter = int(self.kinds[symbol]), self.letters[symbol]
        else:
            what = (LETTER, OTHER, NUMBER)[(symbol - 192) // 64]
            letter = self.letters[192 + (symbol - 192) % 64]
        mark = symbol == APOSTROPHE
        if kind == MARK and what == LETTER:  # the word is what was read since the apostrophe
            text = word + letter
            if text in CONTRACTIONS:
                return (SINGLE, self.opened(text)[0]), self.opened(text)[1] - self._pending(word)
            if any(c.startswith(text) for c in CONTRACTIONS):
                return (MARK, text), self._pending(text) - self._pending(word)
        if kind == MARK:
            total = self._pending(word)
            if len(word) > 1:
                kind, word = LETTERS, self.opened(word[1:])[0]
            else:
                kind, word = RUN, self.opened(word)[0]
            key, grown = self.follow((kind, word), symbol)
            return key, grown
        if (kind == LETTERS and what == LETTER) or (kind == RUN and what == OTHER):
            word, grown = self.further(word, letter)
            return (kind, word), grown
        total = self.closed(word) if kind != NONE else 0
        if what == BLANK:
            return (NONE, None), total
        if mark:
            return (MARK, "'"), total + self._pending("'")
        word, grown = self.further(self.EMPTY, letter)
        return ({LETTER: LETTERS, OTHER: RUN, NUMBER: SINGLE}[what], word), total + grown

    @lru_cache(maxsize=16)  # noqa: B019
    def _pending(self, text: str) -> int:
        """Tokens emitted while an apostrophe may still begin a contraction: it is a word, and letters behind it another."""
        mark, total = self.opened("'")
        return total if len(text) == 1 else total + self.closed(mark) + self.opened(text[1:])[1]

    def compile(self, states: np.ndarray, columns: np.ndarray, most: int) -> None:
        """Fill in the transitions of these states by these columns."""
        for state, column in sorted(set(zip(states.tolist(), columns.tolist()))):
            if len(self.keys) >= most:
                raise Overflow
            key, grown = self.follow(self.keys[state], self.symbols[column])
            number = self.numbers.get(key)
            if number is None:
                number = self.numbers[key] = len(self.keys)
                self.keys.append(key)
                if number >= len(self.table):
                    self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
            self.table[state, column] = (number << 8) | (grown + 128)

    def columns_of(self, symbols: np.ndarray) -> np.ndarray:
        """The column of each symbol; new symbols get new columns."""
        seen = np.flatnonzero(np.bincount(symbols, minlength=SYMBOLS))
        for symbol in seen[self.column[seen] < 0].tolist():
            if len(self.symbols) == self.width:
                self.width *= 2
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)], axis=1)
            self.column[symbol] = len(self.symbols)
            self.symbols.append(symbol)
        return self.column[symbols]

    # Reading.

    def advance(self, states: np.ndarray, columns: np.ndarray, sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(end states, tokens) of lanes that read ``sizes`` columns each, ``columns[step, lane]``."""
        if len(states) <= FEW:
            read = [self._one(int(s), columns[:n, i].tolist(), most) for i, (s, n) in enumerate(zip(states.tolist(), sizes.tolist()))]
            return np.array([r[0] for r in read], np.int64), np.array([r[1] for r in read], np.int64)
        order = np.argsort(-sizes, kind="stable")
        state, total, sizes = states[order], np.zeros(len(states), np.int64), sizes[order]
        for step in range(int(sizes[0])):
            live = int(np.searchsorted(-sizes, -step))  # lanes that read more than ``step`` columns
            column = columns[step, order[:live]]
            while True:
                found = self.table.reshape(-1)[state[:live] * self.width + column]
                unknown = np.flatnonzero(found < 0)
                if not len(unknown):
                    break
                self.compile(state[unknown], column[unknown], most)
            state[:live] = found >> 8
            total[:live] += (found & 255) - 128
        back = np.argsort(order)
        return state[back], total[back]

    def _one(self, state: int, columns: list[int], most: int) -> tuple[int, int]:
        total = 0
        for column in columns:
            found = int(self.table[state, column])
            if found < 0:
                self.compile(np.array([state]), np.array([column]), most)
                found = int(self.table[state, column])
            state, total = found >> 8, total + (found & 255) - 128
        return state, total

    def count_symbols(self, parts: list[np.ndarray]) -> np.ndarray:
        """Tokens of each text, given as symbols."""
        if len(self.keys) > KEPT_STATES:
            self.clear()
        most = len(self.keys) + ADDED_STATES
        chunks = np.array([len(p) // CHUNK + 1 for p in parts], np.int64)  # a blank at the end closes each text
        first = np.cumsum(chunks) - chunks
        flat = np.full(int(chunks.sum()) * CHUNK, SPACE, np.int64)
        for at, part in zip(first.tolist(), parts, strict=True):
            flat[at * CHUNK : at * CHUNK + len(part)] = part
        blank = (flat == SPACE).reshape(-1, CHUNK)
        columns = np.ascontiguousarray(self.columns_of(flat).reshape(-1, CHUNK).T)
        n, space = len(blank), int(self.column[SPACE])
        head = np.where(blank.any(axis=1), blank.argmax(axis=1), CHUNK)
        body = np.where(np.arange(CHUNK)[:, None] < head, space, columns)
        zero = np.zeros(n, np.int64)
        end, total = self.advance(zero, body, np.full(n, CHUNK), most)
        known = head < CHUNK  # whether the end state is known
        starts = np.zeros(n, bool)
        starts[first] = True
        left = np.flatnonzero(head > 0)
        while len(left):
            ready = starts[left] | known[left - 1]
            now = left[ready]
            entered = np.where(starts[now], 0, end[now - 1])
            reads = np.minimum(head[now] + 1, CHUNK)
            state, grown = self.advance(entered, columns[:, now], reads, most)
            open_ = head[now] == CHUNK
            end[now[open_]] = state[open_]
            known[now] = True
            total[now] += grown
            left = left[~ready]
        # an entry that is left open when a chunk begins with a blank is closed by it
        late = np.flatnonzero((head == 0) & ~starts)
        if len(late):
            total[late] += self.advance(end[late - 1], columns[:, late], np.ones(len(late), np.int64), most)[1]
        return np.add.reduceat(total, first)

    def count(self, parts: list[np.ndarray]) -> np.ndarray:
        """As ``count_symbols``; a batch that asks for too many states is cut, at last between words, and a word is then read without a table."""
        if not parts:
            return np.zeros(0, np.int64)
        try:
            return self.count_symbols(parts)
        except Overflow:
            self.clear()
        if len(parts) > 1:
            half = len(parts) // 2
            return np.concatenate([self.count(parts[:half]), self.count(parts[half:])])
        gaps = np.flatnonzero(parts[0] == SPACE)
        if len(gaps):
            cut = int(gaps[len(gaps) // 2])
            return self.count([parts[0][:cut], parts[0][cut + 1 :]]).sum(keepdims=True)
        key, total = (NONE, None), 0
        for symbol in [*parts[0].tolist(), SPACE]:
            key, grown = self.follow(key, symbol)
            total += grown
        return np.array([total])

    # Texts as symbols.

    def kinds_of(self, codes: np.ndarray) -> np.ndarray:
        """The kind of each character, as the library's pattern tells it."""
        kinds = self.kinds[codes]
        if (kinds == UNSEEN).any():
            split = self.library.pre_tokenizer.pre_tokenize_str
            for code in np.unique(codes[kinds == UNSEEN]).tolist():
                c = chr(code)
                kind = BLANK if not split(c) else LETTER if len(split(f"a{c}a")) == 1 else OTHER if len(split(f"!{c}!")) == 1 else NUMBER
                self.kinds[code] = kind
            kinds = self.kinds[codes]
        return kinds

    def read(self, raw: bytes) -> tuple[np.ndarray, int]:
        """The symbols of a text and how many special tokens stand in it."""
        specials = 0
        if any(b in raw for b in self.special_begins):
            raw, specials = self.special.subn(b" ", raw)
        if raw.isascii():
            return _ASCII[np.frombuffer(raw, np.uint8)], specials
        text = raw.decode()
        text = text.lower() if _SIMPLE.fullmatch(text) else self.library.normalizer.normalize_str(text)
        data = np.frombuffer(text.encode(), np.uint8)
        symbols = _ASCII[data]
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        kinds = self.kinds_of(np.frombuffer(text.encode("utf-32-le"), "<u4"))
        wide = data[leads] >= 192
        symbols[leads[wide]] += 64 * (kinds[wide] == OTHER) + 128 * (kinds[wide] == NUMBER)
        for at in leads[wide & (kinds == BLANK)].tolist():
            symbols[at] = SPACE
            at += 1
            while at < len(data) and data[at] & 0xC0 == 0x80:
                symbols[at] = SPACE
                at += 1
        return symbols, specials

    def count_texts(self, texts: list[bytes]) -> np.ndarray:
        read = [self.read(t) for t in texts]
        return self.count([s for s, _ in read]) + np.array([n for _, n in read], np.int64)


#: Bytes as symbols: A-Z in lower case, white space as the blank.
_ASCII = np.arange(256, dtype=np.int64)
_ASCII[65:91] += 32
_ASCII[9:14] = SPACE


@lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    """One for each worker and file; its states outlive a task."""
    return Transducer(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every whole text.

    Special strings in a text are one token each, as the library reads them.  Null
    and empty texts have no tokens; rows that share a doc_id are counted each; an
    empty table gives no rows; other columns are not read.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1, BATCH_BYTES):
            texts = batch.column(1).to_pylist()
            n = transducer(tokenizer).count_texts(texts)
            columns = [np.fromiter(map(len, texts), np.int64, len(texts)), n, n > limit]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(F.col(text_col)))
    return rows.mapInArrow(released(run), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
