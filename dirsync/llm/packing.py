"""Pack documents into fixed windows by multiway differencing.

A document's full windows stand alone.  What is left of it is cut into pieces,
and groups of pieces are spread over windows by the largest differencing method
for many parts: partial partitions are merged largest sum against smallest, the
most unequal ones first.  The windows of a group come out nearly equal; if one
is over capacity, the group is spread over one window more.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, small_batches, text_bytes
from .encoding import KEPT_SEGMENTS, TEXT_AT_ONCE, library_encoder

WINDOW = 2048
#: Longest piece of a document's last, partial window.
PIECE = 512
#: Pieces that are spread together.
GROUP = 512


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The part (0 to k - 1) of each item, by Karmarkar and Karp's method for k parts."""
    n = len(sizes)
    if n == 0 or k <= 1:
        return np.zeros(n, np.int64)
    first = np.zeros((n, k), np.int64)
    first[:, 0] = sizes
    sums: list[np.ndarray | None] = list(first)
    made: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        made.append((a, b, order))
        sums[a] = sums[b] = None
        sums.append(total - total[-1])
        heapq.heappush(heap, (-int(total[0] - total[-1]), len(sums) - 1))
    parts: list[np.ndarray | None] = [None] * len(sums)
    parts[-1] = np.arange(k)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, order = made[node - n]
        own = np.empty(k, np.int64)
        own[order] = parts[node]
        parts[a], parts[b], parts[node] = own, own[::-1], None
    return np.array([p[0] for p in parts[:n]])


def spread(sizes: np.ndarray, capacity: int = WINDOW) -> np.ndarray:
    """A window for each piece; as few windows as the method fits them into."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        part = differencing(sizes, k)
        if np.bincount(part, sizes, k).max() <= capacity:
            return part
        k += 1


_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
    + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("padding", pa.int64())]
)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, piece: int = PIECE, id_col="doc_id", text_col="text",
    together: int = TEXT_AT_ONCE, kept: int = KEPT_SEGMENTS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian u32), doc_tokens, sequence_id, offset, padding.

    Each task packs what it reads, ``GROUP`` pieces at a time, so nothing is
    shuffled and memory is bounded; sequence ids carry the number of the task.
    Null and empty texts are one end id; rows that share a doc_id are packed each;
    an empty table gives no rows; other columns are not read.  ``padding`` fills
    the sequence to ``window``, unless its length is a power of two.  A worker
    encodes ``together`` bytes at once and keeps the ids of ``kept`` segments; fewer
    of both need less memory and more time, and give the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, kept)
        number = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []

        def rows_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE, strict=True)], schema=_PIECE)

        def settle(group: list[tuple]) -> list[tuple]:
            nonlocal number
            sizes = np.array([p[2] for p in group], np.int64)
            part = spread(sizes, window)
            used, part = np.unique(part, return_inverse=True)
            total = np.bincount(part, sizes).astype(np.int64)
            filled = [0] * len(used)
            rows = []
            for p, w in zip(group, part.tolist(), strict=True):
                t = int(total[w])
                rows.append((*p, number + w, filled[w], 0 if t & (t - 1) == 0 else window - t))
                filled[w] += p[2]
            number += len(used)
            return rows

        for batch in small_batches(batches, 1, together):
            names = batch.column(0).to_pylist()
            ids, sizes = encoder.encode(batch.column(1).cast(pa.string()).to_pylist())
            at, out = 0, []
            for name, n in zip(names, sizes.tolist(), strict=True):
                own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                at, n = at + n, n + 1
                full = n - n % window
                for s in range(0, full, window):
                    out.append((name, s, window, own[s : s + window].tobytes(), n, number, 0, 0))
                    number += 1
                if n > full:
                    cuts = np.linspace(full, n, -(-(n - full) // piece) + 1).astype(int).tolist()
                    waiting += [(name, a, b - a, own[a:b].tobytes(), n) for a, b in zip(cuts, cuts[1:])]
                while len(waiting) >= GROUP:
                    out += settle(waiting[:GROUP])
                    del waiting[:GROUP]
                if len(out) >= 4 * GROUP:
                    yield rows_of(out)
                    out = []
            if out:
                yield rows_of(out)
        if waiting:
            yield rows_of(settle(waiting))

    rows = docs.select(F.col(id_col).cast("bigint"), text_bytes(F.col(text_col)))
    ddl = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, padding bigint"
    return rows.mapInArrow(released(run), ddl)
