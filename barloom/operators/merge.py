"""Keyed upsert as one full outer join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schemas import MART_KEYS

OHLCV = ("open", "high", "low", "close", "volume")


@dataclass(frozen=True)
class UpsertRule:
    """What an upsert does to the columns outside the key.

    ``update`` columns are replaced on a match. Every other column keeps its stored
    value, and on insert takes the source's value or else its ``insert_default``.
    ``when`` names a match that is updated at all, as SQL over the stored row ``t`` and the
    source row ``s``; unknown is no.
    """

    update: tuple[str, ...]
    insert_defaults: Mapping[str, Any] = field(default_factory=dict)
    when: str | None = None


# Live candles replace everything but the asset class.
LIVE = UpsertRule(update=(*OHLCV, "vwap", "tick_count", "created_at"))
# Daily bars carry prices and volume only.
DAILY = UpsertRule(update=(*OHLCV, "created_at"))
# Healed bars keep a stored vwap and tick count; a new one has neither.
HEAL = UpsertRule(update=(*OHLCV, "created_at"), insert_defaults={"vwap": None, "tick_count": 1})
# As LIVE, whatever the order in which candles of one window are written: a window only gains
# ticks, so the candle of more ticks is the later one. Any replaces a healed bar, whose vwap is unknown.
GROWING = replace(LIVE, when="t.vwap IS NULL OR s.tick_count >= t.tick_count")
# As HEAL, but a bar made of ticks stays what it is, so no vwap stands beside prices it is not of.
HEAL_MISSING = replace(HEAL, when="t.vwap IS NULL")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by ``order``, then by every other column."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(*keys, "_last.*")
        .select(*df.columns)
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    rule: UpsertRule,
    keys: Sequence[str] = MART_KEYS,
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Target after upserting ``source``.

    The source is first reduced to one row per key unless ``unique`` says it already
    is. Presence is told by marker columns, so NULL values are carried faithfully.
    """
    if not unique:
        source = last_per_key(source, keys, order)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    joined = t.join(s, list(keys), "full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    updated = in_s if rule.when is None else in_s & (~in_t | F.coalesce(F.expr(rule.when), F.lit(False)))

    def value(name: str) -> Column:
        stored = F.col(f"t.`{name}`")
        if name in rule.update and name in source.columns:
            return F.when(updated, F.col(f"s.`{name}`")).otherwise(stored)
        if name in source.columns:
            return F.when(in_t, stored).otherwise(F.col(f"s.`{name}`"))
        default = F.lit(rule.insert_defaults.get(name)).cast(target.schema[name].dataType)
        return F.when(in_t, stored).otherwise(default)

    return joined.select(
        *(F.col(c) if c in keys else value(c).alias(c) for c in target.columns)
    )
