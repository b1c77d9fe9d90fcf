"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Share of rows kept apart from training: crc32(doc_id as text) mod FOLDS = HELD_OUT.
FOLDS, HELD_OUT = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(col: Column) -> Column:
    """A text as UTF-8 bytes; null is the empty text."""
    return F.coalesce(col.cast("binary"), F.lit(bytearray()))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def slices(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Consecutive runs whose sizes add up to about ``most``; a larger item runs alone."""
    start, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if i >= start:
        yield slice(start, i + 1)


def release_memory() -> None:
    """Give unused memory back to the system; a worker outlives its task, and idle ones would hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same task, which gives its memory back at its end."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return task


def small_batches(batches: Iterable[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a binary column has about ``most`` bytes in each; unused memory is given back between them."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        for part in slices(sizes, most):
            yield batch.slice(part.start, part.stop - part.start)
        release_memory()


def bound_batches(spark: SparkSession, most: int = 8_000_000) -> None:
    """Bound the bytes of the batches that go to Python workers in this session, unless a smaller bound is set."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, "67108864b").removesuffix("b")
    if not now.isdigit() or int(now) > most:
        spark.conf.set(name, str(most))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1 for every i, in one array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
