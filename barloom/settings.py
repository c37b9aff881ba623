"""Settings a caller may override: the watchlist and the operating cadence."""

from __future__ import annotations

import os

# The default watchlist.
DEFAULT_WATCHLIST = "AAPL,MSFT,GOOGL,AMZN,NVDA,TSLA,META"

# Windows and triggers of the live pipeline.
CANDLE_WIDTH = "1 minute"
WATERMARK = "5 minutes"
BRONZE_TRIGGER = "30 seconds"
SILVER_TRIGGER = "10 seconds"
GOLD_TRIGGER = "30 seconds"

# How far ahead of its arrival a tick may claim to be, before it is kept out of the candles.
FUTURE_SKEW_MS = 300_000

# How long the clean layer's stream remembers an id before it looks it up: over a day, so that
# the loads of the day at hand are never read again.
ID_MEMORY = "26 hours"

# How far the batch jobs look back.
HEAL_LOOKBACK_DAYS = 6
DAILY_HISTORY_YEARS = 3


def watchlist() -> list[str]:
    """Symbols from ``WATCHLIST`` (comma separated, not trimmed) or the default."""
    return os.environ.get("WATCHLIST", DEFAULT_WATCHLIST).split(",")
