"""Token ids in binary form: blocks of ids, turned into planes, each compressed.

A table of segments.  A segment holds whole documents in ascending doc_id order;
its ids are cut into blocks of a fixed size, a block is transposed into bit or
byte planes, and each plane is compressed with zstandard.  ``blocks`` is the
chunk index: where a block starts in the segment, its length, its planes.  The
table is Parquet without compression of its own, so it lies in any store that
Spark writes, and each segment can be read without the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import released, small_batches, text_bytes
from .encoding import library_encoder

BLOCK_IDS = 65_536
#: Ids after which a segment ends with the document at hand.
SEGMENT_IDS = 1 << 20
#: Bytes of text that a task holds as Python strings.
_AT_ONCE = 8_000_000

_PLANES = pa.list_(pa.binary())
_BLOCK = pa.struct([("first", pa.int64()), ("n", pa.int32()), ("planes", _PLANES)])
_SEGMENT = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("kind", pa.string()),
        ("blocks", pa.list_(_BLOCK)),
    ]
)
_SEGMENT_DDL = (
    "shard int, segment int, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>, kind string,"
    " blocks array<struct<first: bigint, n: int, planes: array<binary>>>"
)


def to_planes(ids: np.ndarray, kind: str = "bit", level: int = 1) -> list[bytes]:
    """The compressed planes of a block, lowest first; planes above the highest id are left out."""
    ids = np.ascontiguousarray(ids, "<u4")
    press = zstandard.ZstdCompressor(level=level).compress
    if kind == "byte":
        raw = ids.view(np.uint8).reshape(-1, 4)
        top = max(1, (int(ids.max()).bit_length() + 7) // 8) if len(ids) else 0
        return [press(raw[:, i].tobytes()) for i in range(top)]
    if kind != "bit":
        raise ValueError(f"kind is bit or byte, not {kind}")
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 0
    return [press(np.packbits((ids >> np.uint32(i)).astype(np.uint8) & 1).tobytes()) for i in range(top)]


def from_planes(planes: list[bytes], n: int, kind: str = "bit") -> np.ndarray:
    out = np.zeros(n, np.uint32)
    open_ = zstandard.ZstdDecompressor().decompress
    for i, plane in enumerate(planes):
        raw = np.frombuffer(open_(plane), np.uint8)
        if kind == "byte":
            out |= raw.astype(np.uint32) << np.uint32(8 * i)
        else:
            out |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(i)
    return out


def _segment(shard: int, segment: int, docs: list, counts: list, ids: np.ndarray, kind: str) -> pa.RecordBatch:
    blocks = [
        {"first": i, "n": len(ids[i : i + BLOCK_IDS]), "planes": to_planes(ids[i : i + BLOCK_IDS], kind)}
        for i in range(0, len(ids), BLOCK_IDS)
    ]
    row = {"shard": shard, "segment": segment, "n_ids": len(ids), "doc_ids": docs, "doc_tokens": counts, "kind": kind}
    return pa.RecordBatch.from_pylist([row | {"blocks": blocks}], schema=_SEGMENT)


def write_token_table(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, kind: str = "bit", id_col="doc_id", text_col="text"
) -> None:
    """Encode every whole text and write the segments under ``path``.

    Null and empty texts are one end id.  Rows that share a doc_id are written
    each, in the order of their texts' hashes; rows without doc_id come first.  An
    empty table gives an empty token table.  Other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        shard, segment = TaskContext.get().partitionId(), 0
        docs, counts, parts, held = [], [], [], 0
        for batch in small_batches(batches, 1, _AT_ONCE):
            names = batch.column(0).to_pylist()
            ids, sizes = encoder.encode(batch.column(1).cast(pa.string()).to_pylist())
            at = 0
            for name, n in zip(names, sizes.tolist(), strict=True):
                docs.append(name)
                counts.append(n + 1)
                parts += [ids[at : at + n], np.array([end_id], np.uint32)]
                at, held = at + n, held + n + 1
                if held >= SEGMENT_IDS:
                    yield _segment(shard, segment, docs, counts, np.concatenate(parts), kind)
                    segment, docs, counts, parts, held = segment + 1, [], [], [], 0
        if docs:
            yield _segment(shard, segment, docs, counts, np.concatenate(parts), kind)

    text = text_bytes(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows.mapInArrow(released(encode), _SEGMENT_DDL).write.option("compression", "uncompressed").parquet(path)


def read_token_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: shard, segment, doc_id, start in the segment, n_tokens, ids (little-endian u32)."""
    out = pa.schema(
        [("shard", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("in_segment", pa.int64())]
        + [("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = [from_planes(b["planes"], b["n"], row["kind"]) for b in row["blocks"]]
                raw = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                n = len(starts)
                cols = [np.full(n, row["shard"], np.int32), np.full(n, row["segment"], np.int32)]
                blobs = [raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                columns = [*map(pa.array, cols), pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64())]
                columns += [pa.array(row["doc_tokens"], pa.int64()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    ddl = "shard int, segment int, doc_id bigint, in_segment bigint, n_tokens bigint, ids binary"
    return spark.read.schema(_SEGMENT_DDL).parquet(path).mapInArrow(released(decode), ddl)


def with_starts(rows: DataFrame, path: str) -> DataFrame:
    """Replace shard, segment and in_segment by ``start``, the ids of all documents before.

    Only the index columns of the table are read; the one global sum runs over one
    row per shard.
    """
    index = rows.sparkSession.read.schema(_SEGMENT_DDL).parquet(path).select("shard", "segment", "n_ids")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    index = index.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("before"))
    start = F.col("base") + F.col("before") + F.col("in_segment")
    joined = rows.join(index.join(shards, "shard"), ["shard", "segment"])
    return joined.select(*[start.alias("start") if c == "in_segment" else c for c in rows.columns if c not in ("shard", "segment")])
