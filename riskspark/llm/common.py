"""Helpers shared by the operators of this folder.

Words are maximal runs without the ASCII white space ``\\x20 \\x09-\\x0D``;
``bytes.split()`` splits on exactly these six bytes, so Python tasks get the
words from the UTF-8 bytes.  Rows have no trusted id (``doc_id`` may be NULL
or repeated), so work that belongs to a text is keyed by ``text_key``.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.plans.cache import delete_folder
from riskspark.session import shared_path
from riskspark.sources.tables import read_table

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(columns) or None)


#: Folders that ``materialize`` and ``graph.cut`` have written in this process, in order.
SCRATCH: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it again.

    Cuts the lineage with files that every executor can read, so a lost
    executor never repeats the work above it.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    release(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    SCRATCH.append(path)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` or ``graph.cut`` wrote, once nothing reads it any more."""
    for df in frames:
        delete_folder(df.sparkSession, df.scratch_path)


def clear(spark: SparkSession) -> None:
    """Delete all scratch of this process, once the results that read it are written."""
    while SCRATCH:
        delete_folder(spark, SCRATCH.pop())


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now.

    It does so when the driver collects its garbage, which is otherwise left
    to chance; a chain of large steps would hold the files of all of them.
    Called before a step, when nothing refers to the one before any more.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Give the memory that a task has freed back to the system; a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def text_key(text: Column) -> Column:
    """Two 64-bit hashes of a text with different seeds; NULL counts as empty."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit("text"), t).alias("b"))


def map_arrow(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch],
              schema: str | T.StructType) -> DataFrame:
    """Apply a function of one record batch to every batch of ``df``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield function(piece)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` bytes (one row may be longer)."""
    if batch.num_rows <= 1 or batch.nbytes <= limit:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), limit)
    yield from slices(batch.slice(half), limit)


def binary(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def list_array(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


#: Odd multipliers of a multiplicative hash and its finalizer.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(32))) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return x ^ (x >> np.uint64(32))


def window_hash(codes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hashes of all windows of ``length`` symbols, by doubling.

    ``codes`` are 64-bit symbol hashes.  A window's hash depends on its
    symbols alone, so equal windows of different documents agree.
    """
    n = len(codes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power = mix(codes ^ mix(np.uint64([seed + 1]))[0])
    total = np.zeros(n, np.uint64)
    done, size = 0, 1
    while done < length:
        if length & size:
            total = mix(total * MIX_B + power[done:done + n])
            done += size
        size *= 2
        if size <= length:
            half = size // 2
            power = mix(power[:-half] * MIX_A + power[half:])
    return total


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` hashes, the position of its rightmost minimum.

    The upper 40 bits of a hash and its place are compared as one word, so
    the choice depends on what the window holds and not on where it lies.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    segment = max(1 << 23, width)
    if n > segment:
        return np.concatenate([start + sliding_argmin(values[start:start + segment + width - 1], width)
                               for start in range(0, n, segment)])
    low = np.uint64((1 << 24) - 1)
    size = -(-len(values) // width) * width
    keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    keys[:len(values)] = (values & ~low) | (low - np.arange(len(values), dtype=np.uint64))
    blocks = keys.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:n], left[width - 1:width - 1 + n])
    return (low - (least & low)).astype(np.int64)


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            row = np.full(n + n // 4, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS[0], _POWERS[1]


class Hashes:
    """Hashes of any run of units, from prefix sums."""

    def __init__(self, codes: np.ndarray):
        up, self.down = powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def runs(self, length: int, count: int) -> np.ndarray:
        """Hashes of the first ``count`` runs of ``length`` units."""
        raw = (self.sums[length:length + count] - self.sums[:count]) * self.down[:count]
        return mix(raw + np.uint64(length))
