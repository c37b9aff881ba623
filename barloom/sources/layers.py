"""Directories of the stored layers: ids of loads, unreadable files, compaction of closed days."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.schemas import DATE_PARTS
from barloom.session import ship, stored
from barloom.sources.paths import create_text, delete, exists, names, read_text

# A larger file is not opened to see what is wrong with it.
_OPENED_BYTES = 256 << 20
TARGET_BYTES = 128 << 20
# Tasks give their files one name in all directories, so the directories belong to it.
_PLACE = r"/((?:[^/=]+=[^/]*/)*[^/]+)$"


def stored_ids(spark: SparkSession, path: str, directories: list[str], wanted: Callable[[int], bool]) -> DataFrame | None:
    """Ids of the loads for which ``wanted(number)`` holds, in these directories; None without any.

    Directories are listed by name, so a load that is not wanted costs no read.
    """
    paths = [
        f"{path}/{d}/{n}"
        for d in directories
        for n in names(spark, f"{path}/{d}")
        if n.startswith("load_id=") and wanted(int(n.removeprefix("load_id=")))
    ]
    if not paths:
        return None
    return spark.read.schema("event_id STRING").parquet(*paths)


# -- unreadable files ----------------------------------------------------------


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a Parquet layer that readers pass over: ``file``, ``reason``, ``length``, ``modified``.

    The files that are listed are compared with those that gave a row. Only the rest is opened,
    each in a task: ``no_parquet``, ``cut_short``, ``bad_content``, or ``unread`` where it is too
    large to open; a sound file without rows is none of them. A file that broke after its first
    rows counts as read, and one without a byte is no file to Spark.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    place = F.col("_metadata.file_path")
    files = listed.load(path).select(place.alias("file"), "length", F.col("modificationTime").alias("modified"))
    # no data column is asked for: a sound file costs its footer only
    reader = spark.read.schema("_none INT").option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    seen = reader.parquet(path).select(place.alias("file")).distinct()
    suspects = stored(files.join(seen, "file", "left_anti"), "suspects")
    opened = listed.load(path).filter(F.col("length") <= _OPENED_BYTES).select(place.alias("file"), "content")
    rows = suspects.join(opened.join(suspects.select("file"), "file", "left_semi"), "file", "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons = [_reason(x.as_buffer()) if x.is_valid else "unread" for x in batch.column("content")]
            columns = [batch.column("file"), pa.array(reasons, pa.string()), batch.column("length"), batch.column("modified")]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "reason", "length", "modified"])

    ship(spark)
    schema = "file STRING, reason STRING, length BIGINT, modified TIMESTAMP"
    return rows.select("file", "content", "length", "modified").mapInArrow(judge, schema).filter("reason IS NOT NULL")


def _reason(content: pa.Buffer) -> str | None:
    data = memoryview(content)
    if bytes(data[:4]) != b"PAR1":
        return "no_parquet"
    if len(data) < 12 or bytes(data[-4:]) != b"PAR1":
        return "cut_short"
    try:
        for _ in pq.ParquetFile(pa.BufferReader(content)).iter_batches():
            pass
    except (OSError, pa.ArrowException):
        return "bad_content"
    return None


def quarantine_files(spark: SparkSession, path: str, into: str) -> int:
    """Note the unreadable files that are not noted yet; how many those are."""
    found = stored(unreadable_files(spark, path), "unreadable")
    if names(spark, into):
        found = stored(found.join(spark.read.schema(found.schema).parquet(into), ["file", "length", "modified"], "left_anti").select(*found.columns), "unreadable")
    n = found.count()
    if n:
        found.write.mode("append").parquet(into)
    return n


# -- compaction ----------------------------------------------------------------


class Layer:
    """A date-partitioned layer whose closed days may be compacted.

    Compacted days stand in a folder that other readers and file streams pass over, so none of
    them reads a row twice. A pointer file names the current version of each day, and a table
    the original files it covers. :meth:`read` takes the compacted days and, of the original
    files, those that are not covered, so it gives the same rows before, during and after.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._root = f"{self.path}/_compact"

    def read(self) -> DataFrame:
        """All rows, in the layer's columns."""
        current = self._current()[1]
        if not current:
            return self._originals().drop("_file", "_size")
        covered = self._covered(current)
        rest = self._originals().join(covered, F.col("_file") == F.col("place"), "left_anti")
        return rest.drop("_file", "_size").unionByName(self._compacted(current))

    def compact(self, before: str, target_bytes: int = TARGET_BYTES) -> list[str]:
        """Compact the days before ``before`` (yyyy-MM-dd) that have more files than they need.

        A day that got files after it was compacted is compacted again, with them. Readers go
        on with the version they hold; the one before it is removed by the next run.
        """
        number, current = self._current()
        day = F.concat_ws("-", *DATE_PARTS)
        rest = self._originals().filter(day < before)
        if current:
            rest = rest.join(self._covered(current), F.col("_file") == F.col("place"), "left_anti")
        files = rest.groupBy(day.alias("_day"), "_file").agg(F.max("_size").alias("_size"))
        days = files.groupBy("_day").agg(F.count("*").alias("n"), F.sum("_size").alias("bytes")).collect()
        many = sorted(r["_day"] for r in days if r["_day"] in current or r["n"] > -(-r["bytes"] // target_bytes))
        if not many:
            return []
        version = uuid.uuid4().hex
        rows = rest.filter(day.isin(many))
        # the files are noted before they are rewritten: what comes meanwhile is not covered
        cover = f"{self._root}/covered/{version}"
        kept = self._covered({d: v for d, v in current.items() if d in many})
        noted = rows.select(F.col("_file").alias("place")).distinct()
        (noted.unionByName(kept) if kept is not None else noted).write.parquet(cover)
        noted = self.spark.read.schema("place STRING").parquet(cover)
        rows = rows.join(noted, F.col("_file") == F.col("place"), "left_semi").drop("_file", "_size")
        again = {d: v for d, v in current.items() if d in many}
        if again:
            rows = rows.unionByName(self._compacted(again))
        with _advisory(self.spark, target_bytes):
            rows = rows.withColumn("_day", day).hint("rebalance", "_day")
            rows.write.partitionBy("_day").parquet(f"{self._root}/data/{version}")
        named = current | dict.fromkeys(many, version)
        if not create_text(self.spark, self._pointer(number + 1), "\n".join(f"{d} {v}" for d, v in sorted(named.items()))):
            delete(self.spark, f"{self._root}/data/{version}")
            delete(self.spark, cover)
            raise RuntimeError(f"{self.path}: compacted by another process at the same time")
        self._clean(number)
        return many

    def _clean(self, number: int) -> None:
        """Remove versions that neither this pointer nor the one before names."""
        used = {v for n in (number, number + 1) for v in self._named(n).values()}
        for version in names(self.spark, f"{self._root}/data"):
            if version not in used:
                delete(self.spark, f"{self._root}/data/{version}")
                delete(self.spark, f"{self._root}/covered/{version}")

    def _originals(self) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.select(*self.schema.fieldNames(), F.regexp_extract("_metadata.file_path", _PLACE, 1).alias("_file"), F.col("_metadata.file_size").alias("_size"))

    def _compacted(self, current: dict[str, str]) -> DataFrame:
        paths = [f"{self._root}/data/{v}/_day={d}" for d, v in current.items()]
        return self.spark.read.schema(self.schema).parquet(*paths).select(*self.schema.fieldNames())

    def _covered(self, current: dict[str, str]) -> DataFrame | None:
        if not current:
            return None
        paths = [f"{self._root}/covered/{v}" for v in sorted(set(current.values()))]
        return self.spark.read.schema("place STRING").parquet(*paths)

    def _pointer(self, number: int) -> str:
        return f"{self._root}/current/{number:012d}"

    def _named(self, number: int) -> dict[str, str]:
        if number < 0 or not exists(self.spark, self._pointer(number)):
            return {}
        return dict(line.split(" ") for line in read_text(self.spark, self._pointer(number)).splitlines())

    def _current(self) -> tuple[int, dict[str, str]]:
        number = max((int(n) for n in names(self.spark, f"{self._root}/current") if n.isdigit()), default=-1)
        return number, self._named(number)


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def _advisory(spark: SparkSession, size: int) -> Iterator[None]:
    """The size that AQE splits and joins rebalanced partitions to."""
    before = spark.conf.get(_ADVISORY)
    spark.conf.set(_ADVISORY, size)
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, before)
