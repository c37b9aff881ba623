"""Last known bar per symbol, for all symbols in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def watchlist_frame(spark: SparkSession, symbols: Sequence[str]) -> DataFrame:
    """The symbols as a DataFrame whose size Spark knows at planning time."""
    return spark.sql("SELECT explode(:symbols) AS symbol", args={"symbols": list(symbols)})


def last_bars(bars: DataFrame) -> DataFrame:
    """``max(window_start)`` per symbol; partial maxima keep the shuffle tiny."""
    return bars.groupBy("symbol").agg(F.max("window_start").alias("last_window"))


def high_watermark(bars: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Every watchlist symbol with its last bar, NULL when it has none."""
    return watchlist.select("symbol").distinct().join(last_bars(bars), "symbol", "left")
