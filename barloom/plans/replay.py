"""Rebuild candles from the raw layer, and read the layers back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators.bronze import between_dates
from barloom.operators.candles import candles
from barloom.operators.silver import to_silver
from barloom.settings import CANDLE_WIDTH
from barloom.sources.mart import Mart


def replay(
    bronze: DataFrame,
    first: str | None = None,
    last: str | None = None,
    dedup: str = "global",
    width: str = CANDLE_WIDTH,
    decimals: int = 6,
) -> DataFrame:
    """Candles of the raw days ``first`` to ``last``, through the live transforms."""
    if first or last:
        bronze = between_dates(bronze, first or "0001-01-01", last or "9999-12-31")
    return candles(to_silver(bronze, dedup), width, decimals=decimals)


def register_views(minutes: Mart, days: Mart | None = None) -> None:
    """Temporary views ``ohlcv_1m`` and ``ohlcv_daily`` for ad-hoc SQL, kept up to date."""
    minutes.view("ohlcv_1m")
    if days is not None:
        days.view("ohlcv_daily")


def as_of(ticks: DataFrame, load: int, column: str = "load_id") -> DataFrame:
    """The rows present after load number ``load``."""
    return ticks.filter(ticks[column] <= load)
