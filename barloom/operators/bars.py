"""Vendor bars: column naming, symbol mapping, incremental ranges, cleaning."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.symbols import asset_class, path_safe, vendor_symbol
from barloom.functions.times import as_utc, utc_wall
from barloom.operators.merge import OHLCV
from barloom.settings import DAILY_HISTORY_YEARS, HEAL_LOOKBACK_DAYS


def utc_now() -> Column:
    return utc_wall(F.current_timestamp())


def as_moment(now: datetime | Column | None) -> Column:
    """``now`` as a zone-less UTC column; the current time when it is None."""
    if now is None:
        return utc_now()
    if isinstance(now, datetime):
        return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return now


def plain_names(df: DataFrame) -> DataFrame:
    """Lower-case column names; ``('Close', 'AAPL')`` is flattened to ``close``."""

    def plain(name: str) -> str:
        pair = re.match(r"^\('([^']*)'.*\)$", name)
        return (pair.group(1) if pair else name).lower()

    return df.toDF(*(plain(c) for c in df.columns))


def _time_column(df: DataFrame) -> str:
    names = {c.lower(): c for c in df.columns}
    found = next((names[c] for c in ("datetime", "date") if c in names), None)
    if found is None:
        raise ValueError(f"no datetime or date column in {df.columns}")
    return found


def mark_bars(bars: DataFrame) -> DataFrame:
    """Vendor bars as ``symbol, window_start, open, high, low, close, volume``, with
    ``reject_reason`` NULL when they are sound.

    The time column is ``datetime`` when there is one, else ``date``. A time with a zone
    becomes UTC. A bar without symbol or time, or with a text that is no number, is refused
    alone; a missing number is no fault.
    """
    named = plain_names(bars)
    time_col = _time_column(named)
    if named.schema[time_col].dataType.typeName() == "string":
        named = named.withColumn(time_col, F.col(time_col).try_cast("timestamp_ntz"))
    numbers = {c: F.col(c).try_cast("double") for c in OHLCV}
    wrong = [F.col(c).isNotNull() & n.isNull() for c, n in numbers.items()]
    moment = as_utc(named, time_col).cast("timestamp_ntz")
    reason = (
        F.when(F.col("symbol").isNull(), "bad_symbol")
        .when(moment.isNull(), "bad_time")
        .when(reduce(or_, wrong), "bad_number")
    )
    return named.select(
        "symbol", moment.alias("window_start"), *(n.alias(c) for c, n in numbers.items()), reason.alias("reject_reason")
    )


def normalise_bars(bars: DataFrame) -> DataFrame:
    """The sound bars of :func:`mark_bars`."""
    return mark_bars(bars).filter("reject_reason IS NULL").drop("reject_reason")


def refused_bars(bars: DataFrame) -> DataFrame:
    """The others, with the reason."""
    return mark_bars(bars).filter("reject_reason IS NOT NULL")


def bars_from(bars: DataFrame, start: datetime) -> DataFrame:
    """Vendor bars from ``start`` on. The bound is a literal, so it reaches the scan."""
    name = _time_column(bars)
    kind = bars.schema[name].dataType.typeName()
    if kind not in ("date", "timestamp_ntz"):
        return bars
    return bars.filter(F.col(f"`{name}`") >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz").cast(kind))


def map_symbols(watchlist: DataFrame) -> DataFrame:
    """Watchlist symbols with their vendor name and class."""
    symbol = F.col("symbol")
    return watchlist.select(
        "symbol",
        vendor_symbol(symbol).alias("vendor_symbol"),
        asset_class(symbol).alias("asset_class"),
    ).distinct()


def with_original_symbol(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Replace the vendor name by the watchlist symbol it stands for.

    ``symbols`` is joined without a hint: Spark broadcasts it when it is small and
    falls back to a shuffle join, with skew splitting, when it is not.
    """
    s = symbols.withColumnRenamed("symbol", "_original")
    return (
        bars.withColumnRenamed("symbol", "vendor_symbol")
        .join(s, "vendor_symbol")
        .drop("vendor_symbol")
        .withColumnRenamed("_original", "symbol")
    )


def since_last_day(bars: DataFrame, now: Column, years: int = DAILY_HISTORY_YEARS) -> DataFrame:
    """Daily rule: restart at the day of ``last_window``, or ``years`` back without one."""
    return bars.filter(F.col("window_start") >= first_day(now, years).cast("timestamp_ntz"))


def first_day(now: Column, years: int = DAILY_HISTORY_YEARS) -> Column:
    """The day a symbol restarts at, by its ``last_window``."""
    return F.coalesce(F.to_date("last_window"), F.to_date(F.add_months(F.to_date(now), -12 * years)))


def lookback_start(now: Column, days: int = HEAL_LOOKBACK_DAYS) -> Column:
    """Start of the earliest day the healer may ask the vendor for."""
    return F.to_date(now - F.expr(f"INTERVAL {days} DAYS")).cast("timestamp_ntz")


def after_last_bar(bars: DataFrame, now: Column, days: int = HEAL_LOOKBACK_DAYS) -> DataFrame:
    """Healer rule: within the lookback, strictly after ``last_window``."""
    return bars.filter(F.col("window_start") >= lookback_start(now, days)).filter(
        F.col("last_window").isNull() | (F.col("window_start") > F.col("last_window"))
    )


def drop_unclosed(bars: DataFrame) -> DataFrame:
    """Drop bars whose close is NULL or NaN. Other missing numbers are kept as NaN."""
    kept = bars.dropna(subset=["close"])
    return kept.withColumns({c: F.coalesce(c, F.lit(float("nan"))) for c in OHLCV})


def raw_backup(bars: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Cleaned bars with the load day and a path-safe symbol as partition columns."""
    day = F.to_date(as_moment(now))
    return bars.withColumns(
        {
            "year": F.lpad(F.year(day).cast("string"), 4, "0"),
            "month": F.lpad(F.month(day).cast("string"), 2, "0"),
            "day": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
            "series": path_safe(F.col("symbol")),
        }
    )


BACKUP_PARTITIONS = ("year", "month", "day", "series")


def stamp(moment: Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` of a zone-less time."""
    return F.substring(moment.cast("string"), 1, 19)
