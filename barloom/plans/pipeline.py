"""The whole path from frames to candles: live, or as a backfill."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom import settings
from barloom.operators.bronze import between_dates
from barloom.operators.candles import candles
from barloom.operators.frames import accepted, mark_records, mark_trades, only_watched, quarantined
from barloom.operators.merge import GROWING, LIVE
from barloom.schemas import BRONZE, DATE_PARTS, OHLCV_1M, SILVER_STORED
from barloom.sources.mart import Mart, Sink
from barloom.sources.paths import delete
from barloom.streaming import jobs
from barloom.streaming.repair import start_repair


EPOCH = datetime(1970, 1, 1)


def minute_mart(spark: SparkSession, root: str, grain: str = "hour") -> Mart:
    return Mart(spark, f"{root}/ohlcv_1m", OHLCV_1M, grain)


def start_live(
    frames: DataFrame,
    root: str,
    mart: Sink,
    topic: bool = False,
    watchlist: DataFrame | list[str] | None = None,
    skip_corrupt: bool = False,
    max_bytes: int | None = None,
) -> list[StreamingQuery]:
    """Start all hops at their usual intervals; the caller awaits or stops them.

    ``max_bytes`` bounds what a batch of the inner hops takes, so that a restart after an
    outage works through the backlog in steps; ``frames`` has the bound of its own reader
    (``maxBytesPerTrigger`` for files, ``maxOffsetsPerTrigger`` for a topic).
    """
    spark = frames.sparkSession
    paths = _paths(root)
    if isinstance(mart, Mart):
        mart.ensure()
    return [
        jobs.start_bronze(
            frames,
            paths["bronze"],
            paths["ck_bronze"],
            settings.BRONZE_TRIGGER,
            topic=topic,
            watchlist=watchlist,
        ),
        jobs.start_quarantine(
            frames, paths["rejects"], paths["ck_rejects"], settings.BRONZE_TRIGGER, topic
        ),
        jobs.start_silver(
            jobs.stream_bronze(spark, paths["bronze"], skip_corrupt=skip_corrupt, max_bytes=max_bytes),
            paths["silver"],
            paths["ck_silver"],
            settings.SILVER_TRIGGER,
        ),
        jobs.start_gold(
            jobs.stream_silver(spark, paths["silver"], max_bytes=max_bytes),
            mart,
            paths["ck_gold"],
            settings.GOLD_TRIGGER,
            rule=GROWING,
        ),
        start_repair(
            jobs.stream_silver(spark, paths["silver"], max_bytes=max_bytes),
            paths["silver"],
            mart,
            paths["late"],
            paths["ck_late"],
            settings.GOLD_TRIGGER,
        ),
    ]


def backfill(
    frames: DataFrame,
    root: str,
    mart: Sink,
    topic: bool = False,
    watchlist: DataFrame | list[str] | None = None,
    days_at_once: int = 31,
    load_id: int = 0,
) -> None:
    """Run a batch of frames through all layers, and stop.

    Days are cleaned and aggregated ``days_at_once`` together, so the work at hand has a bound.
    The clean layer's new ticks are marked with ``load_id``.
    Without streaming state there is no watermark, and no tick is late. What is refused goes
    to the quarantine, as in the live path.
    """
    spark = frames.sparkSession
    paths = _paths(root)
    # Parsed once, and the ids that elements get stay what they are.
    parsed = f"{root.rstrip('/')}/parsed-{uuid.uuid4().hex}"
    (mark_records(frames) if topic else mark_trades(frames)).write.parquet(parsed)
    marked = spark.read.parquet(parsed)
    quarantined(marked).write.mode("append").partitionBy("reject_reason").parquet(paths["rejects"])
    trades = accepted(marked)
    if watchlist is not None:
        trades = only_watched(trades, watchlist)
    jobs.write_bronze(trades, paths["bronze"])
    ends = trades.agg(F.min("source_timestamp"), F.max("source_timestamp")).first()
    delete(spark, parsed)
    if ends[0] is None:
        return
    bronze = spark.read.schema(BRONZE).parquet(paths["bronze"])
    span = [f"{EPOCH + timedelta(milliseconds=ms):%Y-%m-%d}" for ms in ends]
    days = sorted("-".join(r) for r in between_dates(bronze, *span).select(*DATE_PARTS).distinct().collect())
    for i in range(0, len(days), days_at_once):
        first, last = days[i], days[min(i + days_at_once, len(days)) - 1]
        jobs.append_silver(between_dates(bronze, first, last), paths["silver"], load_id)
        silver = spark.read.schema(SILVER_STORED).parquet(paths["silver"])
        mart.merge(candles(between_dates(silver, first, last)), LIVE)


def _paths(root: str) -> dict[str, str]:
    base = root.rstrip("/")
    layers = {name: f"{base}/{name}" for name in ("bronze", "rejects", "silver", "late")}
    marks = {f"ck_{n}": f"{base}/checkpoints/{n}" for n in ("bronze", "rejects", "silver", "gold", "late")}
    return layers | marks
