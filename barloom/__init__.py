"""Barloom: market ticks to OHLCV candles, written as Spark DataFrame transforms.

Every transform takes and returns a DataFrame, so the same code serves a batch
replay and a Structured Streaming query.
"""

from barloom.operators.bars import map_symbols, raw_backup
from barloom.operators.bronze import to_bronze
from barloom.operators.candles import candles
from barloom.operators.frames import encode_trades, parse_trades
from barloom.operators.lookup import high_watermark
from barloom.operators.merge import merge_upsert
from barloom.operators.silver import quality_counters, to_silver
from barloom.plans.daily import load_daily
from barloom.plans.heal import heal_minutes
from barloom.plans.monitor import gaps, latency, pulse
from barloom.plans.pipeline import backfill, start_live
from barloom.plans.replay import replay
from barloom.sources.mart import Mart

__all__ = [
    "Mart",
    "backfill",
    "candles",
    "encode_trades",
    "gaps",
    "heal_minutes",
    "high_watermark",
    "latency",
    "load_daily",
    "map_symbols",
    "merge_upsert",
    "parse_trades",
    "pulse",
    "quality_counters",
    "raw_backup",
    "replay",
    "start_live",
    "to_bronze",
    "to_silver",
]
