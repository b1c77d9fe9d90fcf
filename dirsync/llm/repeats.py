"""Remove byte strings that stand in an earlier document, with families of sparse suffix arrays.

The suffixes that start at anchors are sampled: of the ``RUN`` places in a window
of ``MATCH`` bytes where ``GRAM`` bytes fit, those with the smallest hash.  Equal
windows have equal anchors, so no match of MATCH bytes is lost, while about one
byte in sixteen starts a suffix.

There are two indexes, each a family of levels whose sizes grow geometrically:
batches come as sorted arrays, are merged against the levels that are there, and
equal-sized levels are merged.

The first tells anchors apart by numbers: ``key`` for the GRAM bytes, ``cls`` for
all bytes that a window around the anchor can reach, with a few bits for each side
of the anchor.  Two anchors of one class have all windows in common, which settles
the later document.  Two of one key and side, but of different classes, may have
some: these few go to the second index with their bytes.

The second is a suffix array in byte order: of every suffix that starts such an
open window its MATCH bytes, which is the match length that counts.  A match is
decided on these bytes, first within the task that has the texts, then, for the
one document of each window that is left, by key for all tasks.

A class is 64 bits of hashes under the 40 of its key; two contexts of the same
GRAM bytes that differ would have to agree in them to be taken for equal.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirsync.session import scratch_path

from .common import bound_batches, released, slices, small_batches, text_bytes

MATCH, GRAM = 50, 20
RUN = MATCH - GRAM + 1
#: Bytes of text whose suffixes make one array, and that are looked at together.
BATCH_BYTES, LOOK_BYTES = 8_000_000, 4_000_000
#: Bytes that are hashed together, and the margin where a longer text is cut.
PIECE, MARGIN = 1 << 18, 64
#: Windows that make one array of the second index, and its shards for each shard of documents.
BATCH_WINDOWS, CONTEXT_SHARDS = 100_000, 4
#: Of the bytes of a window beside an anchor, one side has at least so many.
SIDE = (MATCH - GRAM) // 2
#: Bits of a key; more would only tell apart what classes and bytes tell apart anyway.
KEY_BITS = 40
#: Rows up to which the planes of an array are compressed together.
FEW = 512
#: Bytes that windows around an anchor reach.
REACH = 2 * MATCH - GRAM
#: The windows that have the bytes before the anchor, and those that have the bytes behind it, by how far ahead of it they start.
_BEFORE, _AFTER = np.arange(RUN) >= SIDE, np.arange(RUN) <= SIDE
_REST, _TWELVE, _KEY = np.uint64((1 << 40) - 1), np.uint64((1 << 12) - 1), np.uint64((1 << KEY_BITS) - 1)

u64 = np.uint64
_M1, _M2, _M3 = u64(0x9E3779B97F4A7C15), u64(0xBF58476D1CE4E5B9), u64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> u64(30))
    h *= _M2
    h ^= h >> u64(27)
    h *= _M3
    h ^= h >> u64(31)
    return h


#: A number for each byte, and the base of the powers; 5 modulo 8, so that two places never have close powers.
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * u64(2) + u64(1)
_BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, for every place in a piece."""
    n = PIECE + 2 * MARGIN + 1
    return tuple(np.cumprod(np.concatenate([np.ones(1, u64), np.full(n, b, u64)]), dtype=u64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


class Hashes:
    """Hashes of any string in a text, from sums of its bytes times the powers of their places."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _powers()
        self.upto = np.zeros(len(data) + 1, u64)
        np.cumsum(_BYTES[data] * powers[: len(data)], out=self.upto[1:])

    def everywhere(self, length: int) -> np.ndarray:
        """Hash of the ``length`` bytes from every place where they fit."""
        h = self.upto[length:] - self.upto[:-length]
        h *= self.inverse[: len(h)]
        return _mix(h)

    def of(self, first: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` bytes from the given places."""
        return _mix((self.upto[first + length] - self.upto[first]) * self.inverse[first])


def _sliding(h: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours."""
    out, step = h, 1
    while step * 2 <= width:
        out = pick(out[:-step], out[step:])
        step *= 2
    return pick(out[: len(out) - (width - step)], out[width - step :]) if width > step else out


class Suffixes:
    """The sampled suffixes of several texts: unit (number of the text), place, key, class.

    The texts lie behind one another; a window never crosses from one to the next.
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        n, none = len(self.data), np.zeros(0, u64)
        self.unit = self.at = self.left = self.right = np.zeros(0, np.int64)
        self.key = self.cls = none
        if n < MATCH:
            return
        hashes = Hashes(self.data)
        gram = hashes.everywhere(GRAM)
        end = np.repeat(self.ends, sizes)
        whole = end[: n - MATCH + 1] >= np.arange(MATCH, n + 1)
        least = _sliding(gram, RUN, np.minimum)
        far = np.zeros(len(gram) + RUN - 1, u64)
        far[RUN - 1 : RUN - 1 + len(whole)] = np.where(whole, least, u64(0))
        at = np.flatnonzero(_sliding(far, RUN, np.maximum) == gram)
        unit = np.searchsorted(self.ends, at, side="right")
        fits = at + GRAM <= self.ends[unit]
        self.at, self.unit = at[fits], unit[fits]
        self.key = gram[self.at] & _KEY
        self.left = np.minimum(self.at - self.starts[self.unit], MATCH - GRAM)
        self.right = np.minimum(self.ends[self.unit] - self.at, MATCH)
        shape = _mix((self.left * 64 + self.right).astype(u64) * _M2 + u64(3))
        whole = _mix(hashes.of(self.at - self.left, self.left + self.right) + shape) & _REST
        # a window in common means SIDE bytes in common on one side of the anchor: twelve bits of each side's hash
        none = u64(0)
        before = np.where(self.left >= SIDE, hashes.of(np.maximum(self.at - SIDE, 0), SIDE), none) & _TWELVE
        after = np.where(self.right >= GRAM + SIDE, hashes.of(np.minimum(self.at + GRAM, n - SIDE), SIDE), none) & _TWELVE
        self.cls = (before << u64(52)) | (after << u64(40)) | whole


def pieces(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[tuple[int, int]], Suffixes]]:
    """(number of the text, place of the piece in it, its own range) of each unit, and the suffixes, in bounded runs.

    Texts longer than ``PIECE`` are cut with a margin on both sides, in which a
    suffix is found as well but belongs to the neighbour.
    """
    units: list[tuple[int, int, int, int]] = []
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t)), PIECE):
            units.append((i, max(0, a - MARGIN), a, min(len(t), a + PIECE)))
    for part in slices((u[3] - u[1] for u in units), PIECE):
        own = units[part]
        cut = [texts[i][first : hi + MARGIN] for i, first, _, hi in own]
        yield [u[0] for u in own], [u[1] for u in own], [(u[2] - u[1], u[3] - u[1]) for u in own], Suffixes(cut)


# Arrays in transit: sorted keys as differences, in byte planes, compressed; those of few rows in one go.


def _squeeze(*columns: np.ndarray) -> bytes:
    press = zstandard.ZstdCompressor(level=1).compress
    head = np.array([len(columns), len(columns[0])], "<i8").tobytes()
    planes = [np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    if len(columns[0]) <= FEW:
        return head + press(b"".join(planes))
    parts, n = [head], len(columns[0])
    for p in planes:
        for i in range(8):
            z = press(p[i * n : i * n + n])
            parts += [len(z).to_bytes(4, "little"), z]
    return b"".join(parts)


def _unsqueeze(blob: bytes) -> list[np.ndarray]:
    k, n = np.frombuffer(blob, "<i8", 2).tolist()
    open_, at, out = zstandard.ZstdDecompressor().decompress, 16, []
    if n <= FEW:
        planes = np.frombuffer(open_(blob[at:]), np.uint8).reshape(k, 8, n)
        return [np.ascontiguousarray(p.T).reshape(-1).view("<u8") for p in planes]
    for _ in range(k):
        planes = np.empty((n, 8), np.uint8)
        for i in range(8):
            size = int.from_bytes(blob[at : at + 4], "little")
            planes[:, i] = np.frombuffer(open_(blob[at + 4 : at + 4 + size]), np.uint8)
            at += 4 + size
        out.append(planes.reshape(-1).view("<u8").copy())
    return out


def _differences(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=u64(0))


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """The distinct rows, sorted by the columns in their order."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    if not len(order):
        return columns
    new = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
    return [c[new] for c in columns]


class Level:
    """One suffix for each class, that of the first document, sorted by the code of key and class."""

    def __init__(self, code: np.ndarray, key: np.ndarray, cls: np.ndarray, doc: np.ndarray):
        self.code, self.key, self.cls, self.doc = code, key, cls, doc

    def __len__(self) -> int:
        return len(self.code)

    def take(self, mask: np.ndarray) -> Level:
        return Level(self.code[mask], self.key[mask], self.cls[mask], self.doc[mask])

    def merged(self, other: Level) -> Level:
        code = np.concatenate([self.code, other.code])
        order = np.argsort(code, kind="stable")  # two sorted runs
        pairs = ((self.key, other.key), (self.cls, other.cls), (self.doc, other.doc))
        return Level(code[order], *[np.concatenate(x)[order] for x in pairs])


Covered = tuple[np.ndarray, np.ndarray]


def settle(key: np.ndarray, cls: np.ndarray, doc: np.ndarray) -> tuple[Level, Covered]:
    """The level of a batch, and what its own earlier documents cover (class, document)."""
    code = _pair(key, cls)
    order = np.lexsort((doc, code))
    whole = Level(code, key, cls, doc).take(order)
    first = np.concatenate([[True], whole.code[1:] != whole.code[:-1]]) if len(whole) else np.zeros(0, bool)
    lead = whole.doc[np.flatnonzero(first)][np.cumsum(first) - 1] if len(whole) else whole.doc
    later = whole.doc != lead
    return whole.take(first), (whole.cls[later], whole.doc[later])


class Family:
    """Levels whose sizes grow geometrically.  ``add`` gives the suffixes that turn out to be covered."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def add(self, key: np.ndarray, cls: np.ndarray, doc: np.ndarray) -> list[Covered]:
        batch, covered = settle(key, cls, doc)
        out = [covered]
        for level in self.levels:
            if not len(level) or not len(batch):
                continue
            at = np.minimum(np.searchsorted(level.code, batch.code), len(level) - 1)
            hit = (level.key[at] == batch.key) & (level.cls[at] == batch.cls)
            at, old, new = at[hit], level.doc[at[hit]], batch.doc[hit]
            differ = old != new
            out.append((batch.cls[hit][differ], np.maximum(old, new)[differ]))
            level.doc[at] = np.minimum(old, new)
            batch = batch.take(~hit)
        self.levels = [v for v in [*self.levels, batch] if len(v)]
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(b.merged(a))
        return out

    def mixed(self) -> Iterator[tuple[int, Covered]]:
        """(kind, (class, document)) of the suffixes that may share a window with one of another document.

        They have the key and the bytes on one side in common.
        """
        if not self.levels:
            return
        key, cls, doc = (np.concatenate(x) for x in zip(*[(v.key, v.cls, v.doc) for v in self.levels], strict=True))
        for kind, shift in ((MIXED_BEFORE, 52), (MIXED_AFTER, 40)):
            side = (cls >> u64(shift)) & _TWELVE
            order = np.lexsort((side, key))
            k, x, d = key[order], side[order], doc[order]
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1])])[: len(k)]
            at = np.flatnonzero(new)
            if len(at):
                differ = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
                open_ = order[differ[np.cumsum(new) - 1]]
                yield kind, (cls[open_], doc[open_])


def _order(doc_ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned numbers in the same order."""
    return doc_ids.astype(np.int64).view(u64) ^ u64(1 << 63)


def _rows(shards: np.ndarray, n_shards: int, columns: list[np.ndarray], sorted_by: tuple[int, ...] = ()) -> Iterator[tuple[int, bytes]]:
    """(shard, blob) for every shard that has rows."""
    order = np.argsort(shards, kind="stable")
    bounds = np.searchsorted(shards[order], np.arange(n_shards + 1))
    columns = [c[order] for c in columns]
    for s in range(n_shards):
        a, b = bounds[s], bounds[s + 1]
        if a < b:
            own = [c[a:b] for c in columns]
            for c in sorted_by:
                own[c] = _differences(own[c])
            yield s, _squeeze(*own)


_BLOB = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_BLOB_DDL = "shard int, kind int, blob binary"
#: Kinds of blobs.
ARRAY, COVERED, MIXED_BEFORE, MIXED_AFTER, SHARED, CONTEXT, TEXT, PENDING, DONE = range(9)


def _blobs(kind: int, rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for s, blob in rows:
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([kind], pa.int32()), pa.array([blob], pa.binary())], schema=_BLOB)


def _doc_shard(doc: np.ndarray, n: int) -> np.ndarray:
    """The shard of each document (ids in unsigned order): Spark's own xxhash64 of the id, modulo n."""
    distinct, back = np.unique(doc, return_inverse=True)
    raw = (distinct ^ u64(1 << 63)).view(np.int64)
    hashed = np.fromiter((xxhash.xxh64_intdigest(struct.pack("<q", i), 42) for i in raw.tolist()), u64, len(raw))
    return (hashed.view(np.int64) % n)[back]


def _by_document(kind: int, n: int, doc: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Blobs of (document, value) for the shards of documents; values as differences too, small but where a document begins."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    yield from _blobs(kind, _rows(_doc_shard(doc, n), n, [doc, value], sorted_by=(0, 1)))


def _by_shard(batches: Iterator[pa.RecordBatch]):
    """(shard, stream of its rows) from batches (shard, kind, ...) sorted by shard."""
    rows = ((batch.column(0)[i].as_py(), batch, i) for batch in batches for i in range(batch.num_rows))
    return groupby(rows, key=lambda r: r[0])


def make_arrays(docs: DataFrame, n: int) -> DataFrame:
    """Suffix arrays of batches by shard, and what a batch settles by itself, from (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1, BATCH_BYTES):
            doc, texts = _order(batch.column(0).to_numpy()), batch.column(1).to_pylist()
            found = []
            for numbers, _, own, s in pieces(texts):
                low, high = np.array(own).T
                inside = s.at - s.starts[s.unit]
                keep = (inside >= low[s.unit]) & (inside < high[s.unit])
                found.append((s.key[keep], s.cls[keep], doc[np.array(numbers)[s.unit[keep]]]))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            # what is no longer read goes before the next copy: a worker holds a few columns, not all steps of them
            del texts, found, s
            if not len(columns[0]):
                continue
            columns = _distinct(*columns)
            array, (cls, d) = settle(*columns)
            del columns
            if len(cls):
                yield from _by_document(COVERED, n, d, cls)
            del cls, d
            order = np.argsort(array.key, kind="stable")
            columns = array.key[order], array.cls[order], array.doc[order]
            del array, order
            yield from _blobs(ARRAY, _arrays(*columns, n))

    return docs.mapInArrow(released(run), _BLOB_DDL)


def _arrays(key, cls, doc, n):
    """(shard, blob): the array's part for each shard, from rows sorted by key; documents travel as numbers into a sorted list."""
    shard = ((key * u64(n)) >> u64(KEY_BITS)).astype(np.int64)  # keys are hashes: ranges are as even, and their differences smaller
    bounds = np.searchsorted(shard, np.arange(n + 1))
    for s in range(n):
        own = slice(bounds[s], bounds[s + 1])
        if bounds[s] < bounds[s + 1]:
            names, number = np.unique(doc[own], return_inverse=True)
            head = _squeeze(_differences(names))
            yield s, len(head).to_bytes(8, "little") + head + _squeeze(_differences(key[own]), cls[own], number.astype(u64))


def _read_array(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    names = np.cumsum(_unsqueeze(blob[8 : 8 + size])[0], dtype=u64)
    key, cls, number = _unsqueeze(blob[8 + size :])
    return np.cumsum(key, dtype=u64), cls, names[number.astype(np.int64)]


def merge_arrays(arrays: DataFrame, n: int) -> DataFrame:
    """Per shard of documents: the classes that an earlier document covers, and those that may share windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_shard(batches):
            family, covered = Family(), []
            for _, batch, i in rows:
                if batch.column(1)[i].as_py() == COVERED:
                    yield batch.slice(i, 1)
                    continue
                covered += family.add(*_read_array(batch.column(2)[i].as_py()))
            if covered := [c for c in covered if len(c[0])]:
                cls, doc = (np.concatenate(c) for c in zip(*covered, strict=True))
                yield from _by_document(COVERED, n, doc, cls)
            for kind, (cls, doc) in family.mixed():
                if len(cls):
                    yield from _by_document(kind, n, doc, cls)

    return arrays.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(released(run), _BLOB_DDL)


def _pair(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _mix(_mix(doc * _M1) + value)


class Told:
    """What is known about the documents of a shard: sets of (document, value) by kind."""

    def __init__(self) -> None:
        self.parts: dict[int, list[np.ndarray]] = {}
        self.sets: dict[int, np.ndarray] = {}

    def add(self, kind: int, blob: bytes) -> None:
        doc, value = _unsqueeze(blob)
        self.parts.setdefault(kind, []).append(_pair(np.cumsum(doc, dtype=u64), np.cumsum(value, dtype=u64)))

    def add_bits(self, blob: bytes) -> None:
        doc, cls, bits = _unsqueeze(blob)
        self.parts.setdefault(SHARED, []).append(np.stack([_pair(np.cumsum(doc, dtype=u64), cls), bits]))

    def bits(self, doc: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The bits told for each (document, class), 0 where nothing is told."""
        if SHARED not in self.sets:
            both = np.concatenate([np.zeros((2, 0), u64), *self.parts.pop(SHARED, [])], axis=1)
            self.sets[SHARED] = both[:, np.argsort(both[0], kind="stable")]
        known, bits = self.sets[SHARED]
        if not len(known):
            return np.zeros(len(doc), u64)
        pair = _pair(doc, cls)
        at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
        return np.where(known[at] == pair, bits[at], u64(0))

    def has(self, kind: int, doc: np.ndarray, value: np.ndarray) -> np.ndarray:
        if kind not in self.sets:
            self.sets[kind] = np.unique(np.concatenate(self.parts.pop(kind, [np.zeros(0, u64)])))
        known = self.sets[kind]
        if not len(known):
            return np.zeros(len(doc), bool)
        pair = _pair(doc, value)
        return known[np.minimum(np.searchsorted(known, pair), len(known) - 1)] == pair


def _runs(mask: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of true, as rows."""
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return edges.reshape(-1, 2)


def _cover(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, first, 1)
    np.add.at(mark, last, -1)
    return np.cumsum(mark, out=mark)[:n] > 0


def _mark(removed: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """Mark the windows that the bits name; bit j is the window that starts j bytes before the anchor."""
    starts = np.concatenate([at[((bits >> u64(j)) & u64(1)).astype(bool)] - j for j in range(RUN)])
    if len(starts):
        removed |= _cover(len(removed), starts, starts + MATCH)


class Open:
    """Anchors with open windows: number of the text, place in all texts, key, class, document, left, bits of the windows, context bytes."""

    def __init__(self, rows: list[tuple[np.ndarray, ...]]):
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), *[np.zeros(0, u64)] * 3, np.zeros(0, np.int64), np.zeros(0, u64), np.zeros((0, REACH), np.uint8))
        self.text, self.at, self.key, self.cls, self.doc, self.left, self.bits, self.data = (np.concatenate(c) for c in zip(*[empty, *rows], strict=True))

    def take(self, mask: np.ndarray) -> Open:
        return Open([(self.text[mask], self.at[mask], self.key[mask], self.cls[mask], self.doc[mask], self.left[mask], self.bits[mask], self.data[mask])])

    def once(self) -> tuple[Open, np.ndarray]:
        """Each class of a document once, with the windows of all its places; and where each row went."""
        _, first, back = np.unique(_pair(self.doc, self.cls), return_index=True, return_inverse=True)
        found = self.take(first)
        found.bits[:] = 0
        np.bitwise_or.at(found.bits, back, self.bits)
        return found, back

    def windows(self) -> Windows:
        rows, places = np.nonzero((self.bits[:, None] >> np.arange(RUN, dtype=u64)) & u64(1))
        return Windows.cut(self.data, rows, self.left[rows] - places, self.doc[rows], self.cls[rows], places.astype(np.uint8))

    def blobs(self, n_shards: int) -> Iterator[tuple[int, bytes]]:
        """(shard of the key, blob) of the rows; of the context only the bytes that open windows reach, one row after another."""
        shards = (_mix(self.key) % u64(n_shards)).astype(np.int64)
        order = np.lexsort((self.key, shards))
        bounds = np.searchsorted(shards[order], np.arange(n_shards + 1))
        reached = np.zeros(self.data.shape, bool)
        for j in range(RUN):
            rows = np.flatnonzero((self.bits >> u64(j)) & u64(1))
            first = self.left[rows] - j
            # a window's ends: what lies between is filled below
            reached[rows, first] = reached[rows, first + MATCH - 1] = True
        reached = np.maximum.accumulate(reached, axis=1) & np.maximum.accumulate(reached[:, ::-1], axis=1)[:, ::-1]
        data = np.where(reached, self.data, 0).astype(np.uint8)
        press = zstandard.ZstdCompressor(level=5).compress
        for s in range(n_shards):
            own = order[bounds[s] : bounds[s + 1]]
            if len(own):
                head = _squeeze(_differences(self.key[own]), self.cls[own], self.doc[own], self.left[own].astype(u64), self.bits[own])
                yield s, len(head).to_bytes(8, "little") + head + press(data[own].tobytes())

    @classmethod
    def read(cls_, blob: bytes) -> Open:
        size = int.from_bytes(blob[:8], "little")
        key, cls, doc, left, bits = _unsqueeze(blob[8 : 8 + size])
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8 + size :]), np.uint8).reshape(-1, REACH)
        nothing = np.zeros(len(key), np.int64)
        return Open([(nothing, nothing, np.cumsum(key, dtype=u64), cls, doc, left.astype(np.int64), bits, data)])


class Windows:
    """A suffix array: of suffixes that start a window the MATCH bytes, in byte order, then by document; class and place for the answer."""

    def __init__(self, string: np.ndarray, doc: np.ndarray, cls: np.ndarray, place: np.ndarray):
        self.string, self.doc, self.cls, self.place = string, doc, cls, place

    @classmethod
    def cut(cls_, data: np.ndarray, rows: np.ndarray, starts: np.ndarray, doc, cls, place) -> Windows:
        strings = np.empty((len(rows), MATCH), np.uint8)
        for part in slices([MATCH] * len(rows), MATCH * 50_000):
            strings[part] = data[rows[part, None], starts[part, None] + np.arange(MATCH)]
        found = Windows(strings.view(f"S{MATCH}").ravel(), doc, cls, place)
        return found.take(np.argsort(doc, kind="stable"))._sorted()

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, which: np.ndarray) -> Windows:
        return Windows(self.string[which], self.doc[which], self.cls[which], self.place[which])

    def _sorted(self) -> Windows:
        return self.take(np.argsort(self.string, kind="stable"))

    def merged(self, other: Windows) -> Windows:
        """Both in order; two sorted runs with no string in common but of one document."""
        return Windows(*(np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("string", "doc", "cls", "place")))._sorted()

    def settled(self) -> tuple[Windows, Windows]:
        """(the windows of the first document that has them, those of later ones)."""
        if not len(self):
            return self, self
        new = np.concatenate([[True], self.string[1:] != self.string[:-1]])
        late = self.doc != self.doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        return self.take(~late), self.take(late)


class WindowFamily:
    """Levels of suffix arrays, each with the windows of their first documents."""

    def __init__(self) -> None:
        self.levels: list[Windows] = []

    def add(self, array: Windows) -> list[Windows]:
        """The windows that turn out to stand in an earlier document, of the array or of the levels."""
        batch, late = array.settled()
        out = [late]
        for i, level in enumerate(self.levels):
            if not len(level) or not len(batch):
                continue
            at = np.searchsorted(level.string, batch.string)
            inside = np.minimum(at, len(level) - 1)
            hit = level.string[inside] == batch.string
            old = level.doc[inside]
            over = np.flatnonzero(hit & (old > batch.doc))
            if len(over):
                upto = np.searchsorted(level.string, batch.string[over], side="right")
                gone = _cover(len(level), at[over], upto)
                out.append(level.take(gone))
                self.levels[i] = level.take(~gone)
            lost = hit & (old < batch.doc)
            out.append(batch.take(lost))
            batch = batch.take(~lost)
        self.levels = [v for v in [*self.levels, batch] if len(v)]
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(b.merged(a))
        return out


def _told_bits(late: list[Windows]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, class, bits) of settled windows, sorted by document and class."""
    doc, cls = (np.concatenate([np.zeros(0, u64), *[getattr(w, c) for w in late]]) for c in ("doc", "cls"))
    bit = u64(1) << np.concatenate([np.zeros(0, np.uint8), *[w.place for w in late]]).astype(u64)
    order = np.lexsort((cls, doc))
    doc, cls, bit = doc[order], cls[order], bit[order]
    if not len(doc):
        return doc, cls, bit
    at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (cls[1:] != cls[:-1])]))
    return doc[at], cls[at], np.bitwise_or.reduceat(bit, at)


def _first_look(docs: np.ndarray, texts: list[bytes], told: Told) -> tuple[np.ndarray, Open]:
    """The mask of removed bytes of all texts, one after another, and the anchors with windows that are still open."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(sizes) - sizes
    removed = np.zeros(int(sizes.sum()), bool)
    rows = []
    for numbers, places, _, s in pieces(texts):
        if not len(s.at):
            continue
        numbers = np.array(numbers)
        doc, start = docs[numbers[s.unit]], base[numbers] + np.array(places)
        covered = told.has(COVERED, doc, s.cls)
        first, last = s.at - s.left, s.at + s.right
        if covered.any():
            gone = _cover(len(s.data), first[covered], last[covered])
            for u in np.unique(s.unit[covered]).tolist():
                removed[start[u] : start[u] + s.ends[u] - s.starts[u]] |= gone[s.starts[u] : s.ends[u]]
        before, after = (told.has(kind, doc, s.cls) & ~covered for kind in (MIXED_BEFORE, MIXED_AFTER))
        own = np.flatnonzero(before | after)
        if not len(own):
            continue
        # windows that fit and have the side in question, and that no neighbour has settled
        known = _cover(len(s.data), first[covered], last[covered] - MATCH + 1)
        place = np.arange(RUN)
        fits = (place <= s.left[own, None]) & (place >= MATCH - s.right[own, None])
        fits &= (before[own, None] & _BEFORE) | (after[own, None] & _AFTER)
        fits &= ~known[np.maximum(s.at[own, None] - place, 0)]
        bits = (fits.astype(u64) << place.astype(u64)).sum(axis=1, dtype=u64)
        own, bits = own[bits > 0], bits[bits > 0]
        unit = s.unit[own]
        rows.append((numbers[unit], start[unit] + s.at[own] - s.starts[unit], s.key[own], s.cls[own], doc[own], s.left[own], bits, _context(s, own)))
    found = Open(rows)
    # what an earlier document of these texts has is settled here
    once, back = found.once()
    here = np.zeros(len(once.doc), u64)
    doc, cls, bits = _told_bits([once.windows().settled()[1]])
    if len(doc):  # ``once`` is in the order of the pairs
        here[np.searchsorted(_pair(once.doc, once.cls), _pair(doc, cls))] = bits
    _mark(removed, found.at, here[back])
    found.bits &= ~here[back]
    return removed, found.take(found.bits > 0)


def _context(s: Suffixes, chosen: np.ndarray) -> np.ndarray:
    """The bytes that windows around the chosen anchors reach, zeros behind."""
    first, size = (s.at - s.left)[chosen], (s.left + s.right)[chosen]
    place = first[:, None] + np.arange(REACH)
    data = s.data[np.minimum(place, len(s.data) - 1)]
    return np.where(np.arange(REACH) < size[:, None], data, 0).astype(np.uint8)


def _open_row(spans: np.ndarray, cls: np.ndarray, at: np.ndarray) -> bytes:
    """What is known about a text with open windows: removed spans, and class and place of the anchors."""
    return b"".join([len(spans).to_bytes(8, "little"), spans.astype("<i8").tobytes(), cls.astype("<u8").tobytes(), at.astype("<i8").tobytes()])


def _read_open_row(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    spans = np.frombuffer(blob, "<i8", 2 * n, 8).reshape(-1, 2)
    rest = np.frombuffer(blob, "<u8", offset=8 + 16 * n)
    return spans, rest[: len(rest) // 2], rest[len(rest) // 2 :].view("<i8")


def _blanked(text: bytes, removed: np.ndarray, pressed: bytes) -> bytes:
    """The compressed text with zeros for the removed bytes, which nobody reads again."""
    if not removed.any():
        return pressed
    return zstandard.ZstdCompressor(level=3).compress(np.where(removed, 0, np.frombuffer(text, np.uint8)).astype(np.uint8).tobytes())


_ANSWER = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.int64())), ("sha256", pa.string()), ("kept", pa.binary())]
_ANSWER_DDL = "n_bytes bigint, n_removed bigint, spans array<bigint>, sha256 string, kept binary"


def _answers(texts: list[bytes], removed: list[np.ndarray], with_text: bool) -> list[pa.Array]:
    rows = []
    for t, mask in zip(texts, removed, strict=True):
        spans = _runs(mask)
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes() if len(spans) else t
        rows.append((len(t), len(t) - len(kept), spans.reshape(-1).tolist(), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
    return [pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), _ANSWER, strict=True)]


def remove_repeats(docs: DataFrame, with_text: bool = True, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, spans, sha256, kept, and ``row``, its other columns.

    Every byte in a string of MATCH bytes that also starts in a row with a smaller
    doc_id is removed.  ``spans`` are starts and ends of the removed runs, ``kept``
    the bytes left (null without ``with_text``), ``sha256`` their hash.  A null text
    is empty; rows without doc_id are neither changed nor matched; rows that share
    a doc_id do not change each other; an empty table gives no rows; columns of any
    name go along in ``row``.

    Shards are as many as the session's shuffle partitions.  Texts are moved once,
    to the shard of their document, compressed; those with open windows are written,
    without the bytes already removed, with their anchors and moved again, to be cut once these are settled.  All that
    is kept for a shard at a time are its suffixes, or what is told about its
    documents; texts stream by.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("string").alias("nothing"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), text_bytes(F.col(text_col)).alias("text"), rest.alias("row"))
    row_ddl = rows.schema["row"].dataType.simpleString()
    wide = f"shard int, kind int, blob binary, doc bigint, text binary, row {row_ddl}"

    arrays = make_arrays(rows.where("doc IS NOT NULL").select("doc", "text"), n)
    told = _widened(merge_arrays(arrays, n), rows)
    first_ddl = f"shard int, kind int, blob binary, doc bigint, text binary, {_ANSWER_DDL}, row {row_ddl}"
    mixed = told.unionByName(_placed(_pressed(rows).withColumn("blob", F.lit(None).cast("binary")), n))
    looked = mixed.repartition(n, "shard").sortWithinPartitions("shard", "kind").mapInArrow(released(_looker(True, n, with_text)), first_ddl)
    path = scratch_path(spark, "repeats")
    looked.write.option("compression", "zstd").parquet(path)
    looked = spark.read.schema(looked.schema).parquet(path)

    contexts = looked.where(F.col("kind") == CONTEXT).select("shard", "kind", "blob")
    told = _widened(_settle_contexts(contexts, n), rows)
    open_ = _placed(looked.where(F.col("kind") == PENDING).select("doc", "text", "row", "blob"), n)
    again = told.unionByName(open_).repartition(n, "shard").sortWithinPartitions("shard", "kind")
    again = again.mapInArrow(released(_looker(False, n, with_text)), first_ddl)
    done = looked.where(F.col("kind") == DONE).unionByName(again)
    return done.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "spans", "sha256", "kept", "row")


def _placed(rows: DataFrame, n: int) -> DataFrame:
    """Documents with their shard; those without id are spread by their text."""
    hashed = F.when(F.col("doc").isNotNull(), F.xxhash64("doc")).otherwise(F.xxhash64("text"))
    shard = F.pmod(hashed, F.lit(n))
    return rows.select(shard.cast("int").alias("shard"), F.lit(TEXT).alias("kind"), "blob", "doc", "text", "row")


def _widened(told: DataFrame, rows: DataFrame) -> DataFrame:
    empty = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("doc", "text", "row")]
    return told.select("shard", "kind", "blob", *empty)


def _looker(first: bool, n: int, with_text: bool):
    """The task that holds a shard's facts and lets its documents stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, shard = Told(), None
        for batch in batches:
            shards, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            at = 0
            while at < batch.num_rows:
                if shards[at] != shard:
                    told, shard = Told(), shards[at]
                upto = at + int(np.argmax(np.append((shards[at:] != shard) | (kinds[at:] != kinds[at]), True)))
                if kinds[at] != TEXT:
                    for i in range(at, upto):
                        blob = batch.column(2)[i].as_py()
                        told.add_bits(blob) if kinds[i] == SHARED else told.add(int(kinds[i]), blob)
                else:
                    sizes = [zstandard.frame_content_size(batch.column(4)[i].as_py()) for i in range(at, upto)]
                    for part in slices(sizes, LOOK_BYTES):
                        yield from look(batch.slice(at + part.start, part.stop - part.start), told)
                at = upto

    def look(batch: pa.RecordBatch, told: Told) -> Iterator[pa.RecordBatch]:
        pressed, ids = batch.column(4).to_pylist(), batch.column(3)
        open_ = zstandard.ZstdDecompressor().decompress
        texts = [open_(z) for z in pressed]
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        docs = _order(ids.fill_null(0).to_numpy())
        ends = np.cumsum([len(t) for t in texts])
        if first:
            # rows without an id have no part in the search; their texts count as empty in it
            read = [t if k else b"" for t, k in zip(texts, known, strict=True)]
            marked, found = _first_look(docs, read, told)
            ends = np.cumsum([len(t) for t in read])
            removed = [m if k else np.zeros(len(t), bool) for m, k, t in zip(np.split(marked, ends[:-1]), known, texts, strict=True)]
            pending = np.bincount(found.text, minlength=len(texts)) > 0
            once = found.once()[0]
            for s, blob in once.blobs(CONTEXT_SHARDS * n):
                yield answer(batch.slice(0, 0), [s], CONTEXT, [blob], [], [])
            order = np.argsort(found.text, kind="stable")
            bounds = np.searchsorted(found.text[order], np.arange(len(texts) + 1))
            for kind, mask in ((DONE, ~pending), (PENDING, pending)):
                at = np.flatnonzero(mask)
                if len(at):
                    own = batch.take(pa.array(at))
                    blobs = []
                    for i in at.tolist() if kind == PENDING else []:
                        mine = order[bounds[i] : bounds[i + 1]]
                        blobs.append(_open_row(_runs(removed[i]), found.cls[mine], found.at[mine] - (ends[i] - len(read[i]))))
                    sent = [_blanked(texts[i], removed[i], pressed[i]) for i in at] if kind == PENDING else [texts[i] for i in at]
                    yield answer(own, None, kind, blobs or None, sent, [removed[i] for i in at])
        else:
            base = ends - [len(t) for t in texts]
            spans, cls, at = zip(*map(_read_open_row, batch.column(2).to_pylist()), strict=True)
            owner = np.repeat(np.arange(len(texts)), [len(c) for c in cls])
            known_spans = np.concatenate([s + b for s, b in zip(spans, base.tolist(), strict=True)])
            marked = _cover(int(ends[-1]), known_spans[:, 0], known_spans[:, 1])
            _mark(marked, np.concatenate(at) + base[owner], told.bits(docs[owner], np.concatenate(cls)))
            yield answer(batch, None, DONE, None, texts, np.split(marked, ends[:-1]))

    def answer(own: pa.RecordBatch, shards, kind, blobs, texts, removed) -> pa.RecordBatch:
        rows = len(shards) if shards is not None else own.num_rows
        nulls = lambda t: pa.nulls(rows, t)
        row_type = own.schema.field(5).type
        blob = pa.array(blobs, pa.binary()) if blobs is not None else nulls(pa.binary())
        text = pa.array(texts, pa.binary()) if kind == PENDING else nulls(pa.binary())
        told = _answers(texts, removed, with_text) if kind == DONE else [nulls(t) for _, t in _ANSWER]
        doc, row = (own.column(3), own.column(5)) if shards is None else (nulls(pa.int64()), nulls(row_type))
        head = [pa.array(shards if shards is not None else [0] * rows, pa.int32()), pa.array([kind] * rows, pa.int32())]
        names = ["shard", "kind", "blob", "doc", "text", *[k for k, _ in _ANSWER], "row"]
        return pa.RecordBatch.from_arrays([*head, blob, doc, text, *told, row], names=names)

    return run


def _settle_contexts(contexts: DataFrame, n: int) -> DataFrame:
    """Per shard of documents: of each class with open windows those that an earlier document has too.

    Contexts come by shards of keys, of which a task has several, one after
    another.  Of a string that very many documents have, each task sent one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_shard(batches):
            family, late, held, count = WindowFamily(), [], [], 0
            for _, batch, i in rows:
                held.append(Open.read(batch.column(2)[i].as_py()).windows())
                count += len(held[-1])
                if count >= BATCH_WINDOWS:
                    late += family.add(_joined(held))
                    held, count = [], 0
            if held:
                late += family.add(_joined(held))
            doc, cls, bits = _told_bits(late)
            if len(doc):
                yield from _blobs(SHARED, _rows(_doc_shard(doc, n), n, [doc, cls, bits], sorted_by=(0,)))

    return contexts.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(released(run), _BLOB_DDL)


def _joined(arrays: list[Windows]) -> Windows:
    """Arrays that hold the same strings for different documents, in one order."""
    whole = Windows(*(np.concatenate([getattr(w, c) for w in arrays]) for c in ("string", "doc", "cls", "place")))
    return whole.take(np.argsort(whole.doc, kind="stable"))._sorted()


def _pressed(rows: DataFrame) -> DataFrame:
    """Texts compressed before they are moved."""
    ddl = f"doc bigint, text binary, row {rows.schema['row'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=5).compress
        for batch in batches:
            text = pa.array([press(t) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), text, batch.column(2)], names=["doc", "text", "row"])

    return rows.mapInArrow(released(run), ddl)
