"""The three streaming hops, and their batch counterparts for backfills.

Every ``start_*`` takes any streaming DataFrame. ``every`` is a processing-time
interval; without it the query handles what is there and stops, which is how
backfills and tests run the very same code.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from barloom.functions.times import width_micros
from barloom.operators.bronze import to_bronze
from barloom.operators.candles import candles
from barloom.operators.frames import accepted, mark_records, mark_trades, only_watched, quarantined
from barloom.operators.merge import LIVE, UpsertRule
from barloom.operators.silver import first_seen, not_stored, split_future, to_silver
from barloom.schemas import BRONZE, DATE_PARTS, SILVER_PARTITIONS, SILVER_STORED
from barloom.session import ROCKSDB
from barloom.settings import CANDLE_WIDTH, FUTURE_SKEW_MS, ID_MEMORY, WATERMARK
from barloom.sources.mart import Sink
from barloom.sources.paths import make_folder
from barloom.streaming.loads import Loads
from barloom.streaming.metrics import observed, report

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """State on local disk with checkpointed changes, instead of on the heap.

    A query keeps the settings its session had at the start, so they are put back.
    """
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    timed = (
        writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    )
    return timed.option("checkpointLocation", checkpoint).start()


def _by_partition(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows of one directory brought together so that it gets few files. The hint,
    unlike a repartition, lets AQE split a directory that holds much of the data."""
    return df.hint("rebalance", *columns)


# -- bronze --------------------------------------------------------------------


def write_bronze(trades: DataFrame, path: str) -> None:
    rows = _by_partition(to_bronze(trades), DATE_PARTS)
    rows.write.mode("append").partitionBy(*DATE_PARTS).parquet(path)


def start_bronze(
    source: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    event_id: str = "record",
    topic: bool = False,
    watchlist: DataFrame | list[str] | None = None,
) -> StreamingQuery:
    """Frames, or with ``topic`` keyed records, to the date-partitioned raw layer.

    ``watchlist`` keeps out the other symbols.

    The file sink commits a batch as a whole and its log skips replayed batches.
    """
    marked = mark_records(source) if topic else mark_trades(source, event_id)
    trades = accepted(marked)
    if watchlist is not None:
        trades = only_watched(trades, watchlist)
    rows = to_bronze(observed(trades, "bronze"))
    writer = rows.writeStream.format("parquet").option("path", path).partitionBy(*DATE_PARTS)
    return _start(writer, checkpoint, every)


def start_quarantine(
    source: DataFrame, path: str, checkpoint: str, every: str | None = None, topic: bool = False
) -> StreamingQuery:
    """What :func:`start_bronze` refuses, with the reason, by reason."""
    marked = mark_records(source) if topic else mark_trades(source)
    rows = observed(quarantined(marked), "quarantine")
    writer = rows.writeStream.format("parquet").option("path", path).partitionBy("reject_reason")
    return _start(writer, checkpoint, every)


def stream_bronze(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    skip_corrupt: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """The raw layer, each file once. ``skip_corrupt`` passes over unreadable files
    instead of failing the batch; ``quarantine_files`` finds them. A batch takes at most
    ``max_files`` or, from the second file on, ``max_bytes``."""
    return _stream(spark, BRONZE, path, max_files, max_bytes, ignoreCorruptFiles=skip_corrupt)


# -- silver --------------------------------------------------------------------


def write_silver(silver: DataFrame, path: str, load_id: int = 0) -> None:
    """Append ticks, in directories of their load."""
    rows = silver.withColumn("load_id", F.lit(load_id).cast("bigint"))
    rows = _by_partition(rows.select(*SILVER_STORED.fieldNames()), SILVER_PARTITIONS)
    rows.write.mode("append").partitionBy(*SILVER_PARTITIONS, "load_id").parquet(path)


def append_silver(bronze: DataFrame, path: str, load_id: int = 0) -> None:
    """Clean a batch of the raw layer and append the ticks that are not yet stored.

    However late a tick is, it is kept; a batch that is replayed adds nothing again. A number
    belongs to one load: beside a live query, which counts from 0, take a negative one.
    """
    _append(to_silver(bronze), path, load_id, lambda load: True)


def _append(silver: DataFrame, path: str, load_id: int, wanted: Callable[[int], bool]) -> None:
    """Append the ticks that the ``wanted`` loads lack. No ticks leave no trace."""
    silver = silver.persist()
    try:
        if silver.isEmpty():
            return
        fresh = not_stored(silver, path, wanted)
        report("silver_kept", fresh)
        write_silver(fresh, path, load_id)
    finally:
        silver.unpersist()


def start_silver(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    dedup: str = "state",
    memory: str = ID_MEMORY,
) -> StreamingQuery:
    """Raw layer to the clean layer; the number of the load is stored as ``load_id``.

    ``state`` remembers the ids of the last ``memory`` in the query's state and looks up, in
    the directories the batch touches, only the loads before that, so what a batch reads does
    not grow with the day. ``stored`` looks up all loads. Both recognise a redelivery in any
    later batch. ``batch`` forgets between batches. However late a tick is, it is kept.

    A replayed batch reads back its own load and adds what is missing of it, if anything.
    """
    if dedup not in ("state", "stored", "batch"):
        raise ValueError(f"unknown dedup {dedup!r}")
    spark = bronze.sparkSession
    make_folder(spark, path)
    loads = Loads(spark, path, checkpoint, width_micros(memory) // 1000)

    def append(batch: DataFrame, batch_id: int) -> None:
        own = loads.number(batch_id)
        if dedup == "state":
            known = loads.remembered(own)
            _append(batch, path, own, lambda load: load not in known)
        elif dedup == "stored":
            append_silver(batch, path, own)
        else:
            _append(to_silver(batch), path, own, own.__eq__)

    ticks = observed(bronze, "silver_read")
    if dedup == "state":
        ticks = first_seen(to_silver(ticks, "none"), memory)
    with _rocksdb(spark):
        return _start(ticks.writeStream.foreachBatch(append), checkpoint, every)


def stream_silver(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    return _stream(spark, SILVER_STORED, path, max_files, max_bytes)


# -- gold ----------------------------------------------------------------------


def start_gold(
    silver: DataFrame,
    mart: Sink,
    checkpoint: str,
    every: str | None = None,
    width: str = CANDLE_WIDTH,
    watermark: str = WATERMARK,
    decimals: int = 6,
    skew_ms: int | None = FUTURE_SKEW_MS,
    rule: UpsertRule = LIVE,
) -> StreamingQuery:
    """Clean layer to candles, upserted by ``rule`` whenever they change.

    Ticks stamped more than ``skew_ms`` ahead of their arrival stay out: one of them would
    move the watermark past all others.

    A candle is written again with its full value on every change, so a replayed
    batch leaves the table as it was. A failed write fails the query.
    """
    if skew_ms is not None:
        silver, _ = split_future(silver, skew_ms)
    bars = candles(silver, width, watermark=watermark, decimals=decimals)

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        mart.merge(batch, rule)

    writer = bars.writeStream.outputMode("update").foreachBatch(upsert)
    with _rocksdb(silver.sparkSession):
        return _start(writer, checkpoint, every)


def _stream(
    spark: SparkSession,
    schema: StructType,
    path: str,
    max_files: int | None,
    max_bytes: int | None,
    **options,
) -> DataFrame:
    if max_files and max_bytes:
        raise ValueError("bound a batch by files or by bytes, not by both")
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
