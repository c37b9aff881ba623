"""Connectors: frame streams, the keyed topic, Delta tables, a relational mart.

Kafka and Delta need their jars on the cluster; nothing else here depends on them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.bars import as_moment
from barloom.operators.frames import encode_trades
from barloom.operators.merge import UpsertRule, last_per_key
from barloom.schemas import MART_KEYS, SILVER_STORED


def read_frames(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """A stream of frames: any source with a ``value`` column (text files, Kafka).

    Topic records keep their place as ``record``, so that a redelivery is recognised.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return _placed(reader.load(path) if path else reader.load())


def load_frames(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """The frames that are there now, for a backfill."""
    reader = spark.read.format(fmt).options(**options)
    return _placed(reader.load(path) if path else reader.load())


def _placed(frames: DataFrame) -> DataFrame:
    place = ("topic", "partition", "offset")
    if set(place) <= set(frames.columns):
        return frames.select("value", F.concat_ws("/", *place).alias("record"))
    return frames.select("value")


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None
) -> DataFrame:
    """The trade topic from its start; a batch is all that has arrived, or ``max_records``.

    Offsets live in the query's checkpoint and advance only after a batch is written.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().select("key", "value")


# Delivery and batching settings of the topic writer.
TOPIC_WRITER = {
    "kafka.acks": "all",
    "kafka.linger.ms": "5",
    "kafka.batch.size": "16384",
    "kafka.compression.type": "snappy",
}


def write_topic(trades: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Trades to the topic, keyed by symbol."""
    return (
        encode_trades(trades)
        .writeStream.format("kafka")
        .options(**TOPIC_WRITER)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def read_silver(spark: SparkSession, path: str, as_of: str | None = None, fmt: str = "parquet"):
    """The clean layer, or the state it had at ``as_of`` (``yyyy-MM-ddTHH:mm:ss``).

    The layer only ever gains files, so its earlier state is the files that were
    there by then; a Delta table answers the same question from its log.
    """
    if fmt == "delta":
        reader = spark.read.format("delta")
        return (reader.option("timestampAsOf", as_of) if as_of else reader).load(path)
    reader = spark.read.schema(SILVER_STORED)
    return (reader.option("modifiedBefore", as_of) if as_of else reader).parquet(path)


def merge_statement(
    target: str, columns: Sequence[str], rule: UpsertRule, keys: Sequence[str] = MART_KEYS
) -> str:
    """``MERGE INTO`` text for a table format that has it; the source view is ``s``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    changes = [f"t.{c} = s.{c}" for c in rule.update if c in columns]
    values = {c: f"s.{c}" for c in columns}
    if "created_at" in rule.update and "created_at" not in columns:
        changes.append("t.created_at = current_timestamp()")
        values["created_at"] = "current_timestamp()"
    updates = ", ".join(changes)
    for name, default in rule.insert_defaults.items():
        values.setdefault(name, "NULL" if default is None else repr(default))
    return (
        f"MERGE INTO {target} t USING s ON {on} "
        f"WHEN MATCHED{f' AND ({rule.when})' if rule.when else ''} THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(values)}) VALUES ({', '.join(values.values())})"
    )


def upsert_statement(
    table: str,
    columns: Sequence[str],
    rule: UpsertRule,
    keys: Sequence[str] = MART_KEYS,
    mark: str = "%s",
    rows: int = 1,
) -> str:
    """``INSERT ... ON CONFLICT`` text of several rows, with one ``mark`` per column."""
    inserted = [*columns, *(c for c in rule.insert_defaults if c not in columns)]
    literals = [
        "NULL" if rule.insert_defaults[c] is None else repr(rule.insert_defaults[c])
        for c in inserted[len(columns) :]
    ]
    updates = [f"{c} = EXCLUDED.{c}" for c in rule.update if c in columns]
    if "created_at" in rule.update and "created_at" not in columns:
        updates.append("created_at = CURRENT_TIMESTAMP")
    row = f"({', '.join([mark] * len(columns) + literals)})"
    condition = rule.when and re.sub(r"\b([ts])\.", lambda m: {"t": f"{table}.", "s": "EXCLUDED."}[m[1]], rule.when)
    return (
        f"INSERT INTO {table} ({', '.join(inserted)}) "
        f"VALUES {', '.join([row] * rows)} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {', '.join(updates)}"
        + (f" WHERE {condition}" if condition else "")
    )


def upsert_relational(
    bars: DataFrame,
    table: str,
    rule: UpsertRule,
    connect: Callable[[], Any],
    keys: Sequence[str] = MART_KEYS,
    mark: str = "%s",
    connections: int = 8,
    chunk: int = 1_000,
    order: Sequence[str] = (),
) -> None:
    """Upsert candles into a relational table straight from the executors.

    Rows are first reduced to one per key. ``connect`` opens a DB-API connection inside the
    task. A partition is one transaction of statements of ``chunk`` rows; a retried task
    repeats the same upserts, which changes nothing. ``connections`` bounds the load on the
    database; rows are spread over them evenly, whatever their symbol.
    """
    bars = last_per_key(bars, keys, order)
    columns = bars.columns

    def send(rows) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            batch: list[Any] = []
            for row in rows:
                batch += row
                if len(batch) == chunk * len(columns):
                    cursor.execute(upsert_statement(table, columns, rule, keys, mark, chunk), batch)
                    batch = []
            if batch:
                n = len(batch) // len(columns)
                cursor.execute(upsert_statement(table, columns, rule, keys, mark, n), batch)
            connection.commit()
        finally:
            connection.close()

    bars.repartition(connections, *keys).foreachPartition(send)


class RelationalSink:
    """A relational candle table that the live, daily and healing jobs can write."""

    def __init__(self, table: str, columns: Sequence[str], connect: Callable[[], Any], **options: Any):
        self.table, self.columns = table, tuple(columns)
        self.connect, self.options = connect, options

    def merge(self, source: DataFrame, rule: UpsertRule, order: Sequence[str] = (), now=None) -> None:
        """Upsert ``source``; ``created_at`` is the database's own time, or ``now``."""
        names = [c for c in self.columns if c in source.columns and c != "created_at"]
        rows = last_per_key(source.select(*names, *(c for c in order if c not in names)), MART_KEYS, order).select(*names)
        # drivers know text, not zone-less times
        rows = rows.withColumn("window_start", F.substring(F.col("window_start").cast("string"), 1, 19))
        if now is not None and "created_at" in self.columns:
            rows = rows.withColumn("created_at", F.substring(as_moment(now).cast("string"), 1, 19))
        upsert_relational(rows, self.table, rule, self.connect, **self.options)
