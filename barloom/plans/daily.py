"""Incremental daily bars for the whole watchlist in one job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators.lookup import high_watermark
from barloom.operators.merge import DAILY
from barloom.schemas import DATE_PARTS
from barloom.session import stored
from barloom.sources.mart import Sink


def daily_increment(
    bars: DataFrame, stored: DataFrame, watchlist: DataFrame, now: datetime | Column | None = None
) -> DataFrame:
    """Clean bars each symbol still needs; its last stored day is refreshed."""
    return _increment(bars, high_watermark(stored, watchlist), watchlist, now)


def _increment(bars: DataFrame, last: DataFrame, watchlist: DataFrame, now: datetime | Column | None) -> DataFrame:
    symbols = B.map_symbols(watchlist).join(last, "symbol")
    mapped = B.with_original_symbol(B.normalise_bars(bars), symbols.drop("asset_class"))
    wanted = B.since_last_day(mapped, B.as_moment(now))
    return B.drop_unclosed(wanted).select("symbol", "window_start", *B.OHLCV)


def load_daily(
    bars: DataFrame,
    mart: Sink,
    watchlist: DataFrame,
    now: datetime | Column | None = None,
    backup: str | None = None,
    rejects: str | None = None,
    stored_bars: DataFrame | None = None,
) -> None:
    """Load the increment into ``mart``, keeping the raw bars under ``backup`` and those that
    are refused under ``rejects``.

    ``stored_bars`` is what a sink that cannot be read holds. The earliest start of all
    symbols is a literal bound of the scan of ``bars``.
    """
    last = mart.last_bars(watchlist) if stored_bars is None else high_watermark(stored_bars, watchlist)
    last = stored(last, "last-bars")
    start = last.select(F.min(B.first_day(B.as_moment(now))).cast("timestamp_ntz")).first()[0]
    if start is not None:
        bars = B.bars_from(bars, start)
    if rejects:
        B.refused_bars(bars).write.mode("append").parquet(rejects)
    rows = _increment(bars, last, watchlist, now)
    if backup:
        copy = B.raw_backup(rows, now)
        (
            copy.hint("rebalance", "series")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*B.BACKUP_PARTITIONS)
            .parquet(backup)
        )
    mart.merge(rows, DAILY, now=now)


def read_backup(spark, path: str) -> DataFrame:
    """Backed-up bars with the load day as text columns."""
    ddl = (
        "symbol STRING, window_start TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, "
        "close DOUBLE, volume DOUBLE, "
        + ", ".join(f"{p} STRING" for p in (*DATE_PARTS, "series"))
    )
    return spark.read.schema(ddl).parquet(path)
