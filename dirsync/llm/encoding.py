"""Token ids by the tokenizers library, with each distinct segment encoded once.

Whole texts are cut at places where no token can span, the distinct segments are
encoded by the library, and the ids of a text are put together from them.  The
ids equal those of the whole text.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from .common import ranges, slices

#: Distinct segments that a worker keeps; beyond, it starts afresh.
KEPT_SEGMENTS = 700_000
#: Characters of text that are encoded together.
TEXT_AT_ONCE = 4_000_000

#: Characters for which the finer cut is known to be right, and which keep their
#: number of bytes in lower case: printable ASCII and the letters of Latin-1.
_LETTERS = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[\\n -~{_LETTERS}]*")
_DOUBLE_GAPS = ("  ", " \n", "\n ", "\n\n")
_WORD = f"'?[{_LETTERS}]+(?:'[{_LETTERS}]+)*|[!-/:-@[-`{{-~]+"
_SPACED = re.compile(f"[ \\n]?(?:{_WORD})")
_BARE = re.compile(_WORD)
_GAP = re.compile(r"(?<=\S)(?=[ \n])")
#: Of each byte of a plain text: 0 gap, 1 letter (two bytes for those of Latin-1), 2 punctuation.
_BYTE_KINDS = np.array([0 if b in b" \n" else 1 if b > 127 or chr(b).isalnum() else 2 for b in range(256)], np.uint8)


def is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None


def cut_before_space(text: str) -> list[str]:
    """Segments that begin with the white space before a word.

    For byte-level vocabularies: a match never goes from a word into the white
    space behind it, nor from a letter into punctuation or back, but for the
    apostrophe of a contraction.
    """
    return _SPACED.findall(text) if _evenly_spaced(text) else [s for s in _GAP.split(text) if s]


def _evenly_spaced(text: str) -> bool:
    """Plain, with a word behind each white space."""
    return is_plain(text) and not text.endswith((" ", "\n")) and not any(gap in text for gap in _DOUBLE_GAPS)


def distinct_before_space(texts: list[str], whole: re.Pattern) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct segments of ``cut_before_space``, the number of each segment in their order, and how many each text has.

    Evenly spaced texts are cut on their bytes, all at once; a text with a match of ``whole`` is one segment.
    """
    pieces = [t.encode() for t in texts]
    ends = np.fromiter(map(len, pieces), np.int64, len(pieces)).cumsum()
    begins, blob = np.concatenate([[0], ends[:-1]])[: len(ends)], b"".join(pieces)
    data = np.frombuffer(blob, np.uint8)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[begins] = first[-1] = True
    kind = np.append(_BYTE_KINDS[data], np.uint8(0))
    # an apostrophe before a letter is a part of the word, unless punctuation stands before it
    quote = np.flatnonzero(data == ord("'"))
    kind[quote[(first[quote] | (kind[quote - 1] != 2)) & (kind[quote + 1] == 1) & ~first[quote + 1]]] = 1
    cut = first.copy()
    cut[1:-1] |= (kind[1:-1] != kind[:-2]) & (kind[:-2] != 0)
    for i, text in enumerate(texts):
        if whole.search(text) or not _evenly_spaced(text):
            own = _whole(text) if whole.search(text) else cut_before_space(text)
            cut[begins[i] : ends[i]] = False
            cut[begins[i] + np.cumsum([0, *(len(s.encode()) for s in own[:-1])])[: len(own)]] = True
    offsets = np.flatnonzero(cut)
    segments = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(blob)).dictionary_encode()
    return segments.dictionary.to_pylist(), segments.indices.to_numpy(), np.diff(np.searchsorted(offsets, np.append(begins, len(data))))


def cut_at_space(text: str) -> list[str]:
    """Segments between blanks and line ends, for vocabularies that drop white space."""
    if is_plain(text):
        return _BARE.findall(text)
    return [s for s in text.replace("\n", " ").split(" ") if s]


class SegmentEncoder:
    """Keeps the ids of segments; ``learn`` encodes those not yet known."""

    def __init__(self, cut, kept: int = KEPT_SEGMENTS, specials: list[str] = ()):
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
        self.cut, self.kept = (lambda t: _whole(t) if self.special.search(t) else cut(t)) if specials else cut, kept
        self.cut_kind = cut
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = array("I"), array("q", [0])

    def learn(self, segments: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each text has."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        was = gc.isenabled()
        gc.disable()  # many short lists, none in a cycle
        try:
            for part in slices(map(len, texts), TEXT_AT_ONCE):
                got = self._encode(texts[part])
                ids.append(got[0])
                counts.append(got[1])
        finally:
            if was:
                gc.enable()
        return np.concatenate(ids), np.concatenate(counts)

    def _segments(self, texts: list[str]) -> tuple[list[str], np.ndarray | None, np.ndarray]:
        """Segments, which of them stand in the texts one after another (None: each once), and how many each text has."""
        if self.cut_kind is cut_before_space:
            return distinct_before_space(texts, self.special)
        cut = [self.cut(t) for t in texts]
        return list(chain.from_iterable(cut)), None, np.fromiter(map(len, cut), np.int64, len(cut))

    def _encode(self, texts):
        flat, which, per_text = self._segments(texts)
        codes = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(codes < 0)
        missing = list({flat[i] for i in unknown.tolist()})
        if len(self.known) + len(missing) > self.kept and self.known:
            self._clear()
            missing, unknown = list(set(flat)), np.arange(len(flat))
        if missing:
            first = len(self.known)
            self.known.update(zip(missing, range(first, first + len(missing))))
            learned = self.learn(missing)
            upto = len(self.flat) + np.fromiter(map(len, learned), np.int64, len(learned)).cumsum()
            self.flat.extend(chain.from_iterable(learned))
            self.starts.frombytes(upto.tobytes())
            codes[unknown] = list(map(self.known.__getitem__, map(flat.__getitem__, unknown.tolist())))
        codes = codes if which is None else codes[which]
        starts, stored = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat or array("I", [0]), np.uint32)
        first, size = starts[codes], starts[codes + 1] - starts[codes]
        ids = stored[ranges(first, size)]
        upto = np.concatenate([[0], np.cumsum(size)])
        ends = np.concatenate([[0], np.cumsum(per_text)])
        return ids, np.diff(upto[ends])


class LibraryEncoder(SegmentEncoder):
    """Ids by the tokenizers library."""

    def __init__(self, path: str, kept: int = KEPT_SEGMENTS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        made = json.loads(self.tokenizer.to_str())
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token.removesuffix(made["model"].get("end_of_word_suffix") or "\0"))
        super().__init__(_cut_for(made), kept, [t["content"] for t in made.get("added_tokens") or []])

    def learn(self, segments):
        """Plain segments are encoded in one text and told apart by the bytes of their tokens, others alone."""
        gap = self.cut_kind is cut_before_space
        joined, one_by_one = [], list(range(len(segments)))
        if self.cut_kind is not _whole:
            joined = [i for i in self._plain(segments) if not gap or segments[i][0] in " \n" and segments[i][-1] not in " \n"]
            one_by_one = sorted(set(one_by_one).difference(joined))
        found: list = [None] * len(segments)
        batch = self.tokenizer.encode_batch_fast([segments[i] for i in one_by_one], add_special_tokens=False)
        for i, e in zip(one_by_one, batch, strict=True):
            found[i] = e.ids
        for part in slices((len(segments[i]) for i in joined), 100_000):
            own = [segments[i] for i in joined[part]]
            text = ("" if gap else " ").join(own)
            ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ends = np.cumsum(self.token_bytes[ids])
            sizes = map(len, own) if text.isascii() else (len(s.encode()) for s in own)
            bounds = np.searchsorted(ends, np.fromiter(sizes, np.int64, len(own)).cumsum(), side="right").tolist()
            for i, a, b in zip(joined[part], [0, *bounds], bounds):
                found[i] = ids[a:b]
        return found


    def _plain(self, segments: list[str]) -> list[int]:
        """Numbers of the plain segments without a special token; most are told many at once."""
        found: list[int] = []
        for a in range(0, len(segments), 256):
            part = segments[a : a + 256]
            text = "\n".join(part)
            if is_plain(text) and not self.special.search(text):
                found += range(a, a + len(part))
            else:
                found += [a + i for i, s in enumerate(part) if is_plain(s) and not self.special.search(s)]
        return found


def _cut_for(made: dict):
    """Where texts may be cut for this tokenizer; whole texts if that is not known."""
    special = made.get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in special):
        return _whole
    pre, norm = made.get("pre_tokenizer") or {}, made.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return cut_before_space
    steps = pre.get("pretokenizers") or []
    if steps and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert"):
        kinds = [n["type"] for n in (norm or {}).get("normalizers", [])]
        if "|[^\\s\\p{L}\\p{N}]+" in steps[0]["pattern"].get("Regex", "") and set(kinds) <= {"NFC", "Replace", "Lowercase"}:
            return cut_at_space
    return _whole


def _whole(text: str) -> list[str]:
    return [text] if text else []


@lru_cache(maxsize=2)
def library_encoder(path: str, kept: int = KEPT_SEGMENTS) -> LibraryEncoder:
    """One encoder for each worker and file; its segments outlive a task."""
    return LibraryEncoder(path, kept)
