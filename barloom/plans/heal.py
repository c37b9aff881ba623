"""Patch missing one-minute bars from the vendor's bars."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame

from barloom.operators import bars as B
from barloom.operators.lookup import high_watermark
from barloom.operators.merge import HEAL
from barloom.schemas import MART_KEYS
from barloom.settings import HEAL_LOOKBACK_DAYS
from barloom.sources.mart import Sink


def heal_increment(
    bars: DataFrame,
    stored: DataFrame,
    watchlist: DataFrame,
    now: datetime | Column | None = None,
    mode: str = "tail",
) -> DataFrame:
    """Bars to patch in.

    ``tail`` takes what lies after each symbol's last stored bar. ``gaps`` takes
    every bar of the lookback that is not stored, holes in the middle included.
    """
    moment = B.as_moment(now)
    named = B.with_original_symbol(B.normalise_bars(bars), B.map_symbols(watchlist))
    if mode == "tail":
        # The left side is the large one; AQE can split its hot symbols.
        wanted = B.after_last_bar(
            named.join(high_watermark(stored, watchlist), "symbol", "left"), moment
        )
    elif mode == "gaps":
        recent = named.filter(named.window_start >= B.lookback_start(moment))
        wanted = recent.join(stored.select(*MART_KEYS), list(MART_KEYS), "left_anti")
    else:
        raise ValueError(f"mode must be 'tail' or 'gaps', not {mode!r}")
    return B.drop_unclosed(wanted).select("symbol", "asset_class", "window_start", *B.OHLCV)


def heal_minutes(
    bars: DataFrame,
    mart: Sink,
    watchlist: DataFrame,
    now: datetime | Column | None = None,
    mode: str = "tail",
    rejects: str | None = None,
    stored_bars: DataFrame | None = None,
) -> None:
    """Upsert the missing bars into ``mart``, keeping those that are refused under ``rejects``.

    Only the periods of the lookback are read: an older last bar and none at all
    lead to the same start. ``stored_bars`` is what a sink that cannot be read holds.
    """
    start = B.lookback_start(B.as_moment(now))
    if stored_bars is None:
        stored_bars = mart.read(since=start)
    if isinstance(now, datetime):
        bars = B.bars_from(bars, datetime.combine(now.date() - timedelta(days=HEAL_LOOKBACK_DAYS), time()))
    if rejects:
        B.refused_bars(bars).write.mode("append").parquet(rejects)
    mart.merge(heal_increment(bars, stored_bars, watchlist, now, mode), HEAL, now=now)
