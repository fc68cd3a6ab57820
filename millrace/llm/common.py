"""Helpers shared by the operators: bounded Arrow slices, word hashing, scratch space."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import scratch_path


#: Text a task works on at a time; a single longer text is a slice of its own.
SLICE_BYTES = 2_000_000

#: White space of the word operators: space and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: ``renamed(df, key="doc_id")``."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are no longer referred to.

    They go when the driver's collector finds the plan unused; on a driver with little
    to do that may be long after a query has filled the disks. Call it where the frames
    that led to a settled one have gone out of scope. The scheduler refers to the last job
    until it is told of another, so a small one is run first.
    """
    gc.collect()
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read from there, and its path.

    Columns take a fraction of what the rows of a checkpoint take.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _trim() -> None:
    """Give freed memory back: Python workers outlive their task and wait for the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers hold no more than their code when a task has ended."""
    def lean(batches):
        try:
            yield from run(batches)
        finally:
            _trim()

    return df.mapInArrow(lean, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``limit`` bytes, never inside a row."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)
                           .cast(pa.int64()))
        group = (np.cumsum(sizes) - sizes) // limit
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for begin, end in zip(starts, np.append(starts[1:], len(group))):
            yield batch.slice(begin, end - begin)


def map_slices(df: DataFrame, column: str, schema: str | StructType,
               work: Callable[[pa.RecordBatch], pa.RecordBatch],
               limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` with ``work`` on bounded slices; ``work`` may return None."""
    def run(batches):
        for part in slices(batches, column, limit):
            made = work(part)
            if made is not None and made.num_rows:
                yield made

    return map_arrow(df, run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit values that spreads every bit (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Sums that :meth:`span` turns into the hash of any stretch of ``values``."""
        self.reach(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=out[1:])
        return out

    def span(self, prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal stretches have equal values, wherever they stand."""
        return (prefix[end] - prefix[begin]) * self.down[begin]


_BYTES = Powers(0x9E3779B97F4A7C15)


def word_bounds(raw: np.ndarray, is_space: np.ndarray = _SPACE):
    """Byte offsets where words of ``raw`` begin and end."""
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~is_space[raw]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name per word, the same wherever the word occurs."""
    prefix = _BYTES.prefix(raw.astype(np.uint64) + np.uint64(1))
    return mix(_BYTES.span(prefix, begin, end) + (end - begin).astype(np.uint64))


def joined(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one space after each, and where each text begins.

    The last entry of the second array is the length of the first.
    """
    parts = [b"" if t is None else (t.lower() if lower else t).encode("utf-8", "surrogatepass")
             for t in texts.to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return np.frombuffer(b" ".join([*parts, b""]), np.uint8), offsets


def per_text(begin: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of words that begin at byte ``begin``: the first word of each text, and the total."""
    return np.searchsorted(begin, offsets)
