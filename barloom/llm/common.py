"""Helpers shared by the operators: Arrow text blocks, word hashes, checkpoints."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barloom.session import scratch_dir, ship
from barloom.sources.paths import delete

#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHIFT30, _SHIFT27, _SHIFT31 = np.uint64(30), np.uint64(27), np.uint64(31)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: A-Z to a-z; every other byte is itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True
#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED_BYTES = np.ones(256, bool)
SPACED_BYTES[[32, 9, 10, 11, 12, 13]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _SHIFT30)) * _MIX1
    x = (x ^ (x >> _SHIFT27)) * _MIX2
    return x ^ (x >> _SHIFT31)


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _ODD), np.full(size, _ODD_INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, at least n of them."""
    return _powers(max(BLOCK_BYTES + 1, 1 << max(n, 1).bit_length()))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the lower-cased bytes of each span, wherever it stands."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[LOWER[data]] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a block of texts: hash, bounds in the block's bytes, and per text a range."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD_BYTES):
        offsets = offsets - offsets[0]
        inside = kind[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        bounds = offsets[(offsets > 0) & (offsets < len(data))]
        first[bounds] = inside[bounds]
        last[bounds - 1] = inside[bounds - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.hash = np.empty(len(self.start), np.uint64)
        lo = 0
        while lo < len(self.start):  # a block of usual size at once, a very long text in parts
            at = int(self.start[lo])
            hi = max(lo + 1, int(np.searchsorted(self.end, at + BLOCK_BYTES, "right")))
            self.hash[lo:hi] = _hashes(data[at : self.end[hi - 1]], self.start[lo:hi] - at, self.end[lo:hi] - at)
            lo = hi
        #: Word range of text i: bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every run of k words within one text."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = gram_hashes(self.hash, k)
        at = np.flatnonzero(self.text[:n] == self.text[k - 1 :])
        return h[at], at


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k word hashes."""
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _ODD + words[j : j + n]
    return mix(h)


def hand_back() -> None:
    """Give freed memory back to the system at the end of a task: a worker lives through many."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _trim():
    """The C library's call for it, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


_TRIM = _trim()


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package's code at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def fields(df: DataFrame, *names: str) -> list[str]:
    """Columns as parts of a schema text."""
    return [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema if not names or f.name in names]


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns of these names out of the way, and what brings back its own columns."""
    own = {c: f"_own_{c}" for c in docs.columns if c in names}
    back = {v: k for k, v in own.items()}
    columns = docs.columns
    return docs.withColumnsRenamed(own), lambda df: df.drop(*own).withColumnsRenamed(back).select(*columns)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the folder that the cluster names in ``spark.checkpoint.dir``."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by Parquet in the same folder; unlike a checkpoint's, its size is known to the planner."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dealt(df: DataFrame, column: str, name: str) -> DataFrame:
    """Stored in the same folder in as many buckets by ``column`` as a shuffle has partitions, rows
    of one value together: what groups or joins by it reads the buckets and moves no row."""
    spark = df.sparkSession
    table = f"dealt_{uuid.uuid4().hex}"
    rows = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).sortBy(column)
    rows.options(path=scratch_dir(spark, name), compression="zstd").format("parquet").saveAsTable(table)
    try:
        return spark.table(table)
    finally:  # the name goes, the files stay
        spark.sql(f"DROP TABLE {table}")


class Scratch:
    """Tables between the steps of one call, deleted when it is over.

    ``with Scratch(spark) as scratch``: what ``scratch.stored`` returns holds within the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def stored(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        self.paths.append(scratch_dir(self.spark, name))
        df.write.options(**options).parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def __exit__(self, *failure) -> None:
        for path in self.paths:
            delete(self.spark, path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def arrays_of(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from n + 1 offsets and flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
