"""Clean layer: quality filter, enrichment, deduplication, schema enforcement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.symbols import asset_class
from barloom.functions.times import ms_to_instant
from barloom.schemas import SILVER, SILVER_PARTITIONS
from barloom.sources.layers import stored_ids


# NaN orders above infinity in Spark, so the upper bound is what turns it away.
VALID = " AND ".join(f"{c} > 0 AND {c} <= double('Infinity')" for c in ("price", "volume"))


def clean(ticks: DataFrame) -> DataFrame:
    """Keep the ticks with price and volume above zero; NULL and NaN fail."""
    return ticks.filter(VALID)


def enrich(ticks: DataFrame) -> DataFrame:
    """Add the event time as an instant and the asset class."""
    return ticks.withColumns(
        {
            "trade_time": ms_to_instant(F.col("source_timestamp")),
            "asset_class": asset_class(F.col("symbol")),
        }
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key: the first by ``order``, then by every other column.

    A minimum over a struct is combined on the map side, so a key that holds a
    large share of all rows leaves each task as one row. A ranking window would
    send all its copies to one task. NULL keys count as equal.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys]
    if not ordered and not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*ordered, *rest)).alias("_first"))
        .select(*keys, "_first.*")
        .select(*df.columns)
    )


def dedupe(
    ticks: DataFrame,
    scope: str = "global",
    order: tuple[str, ...] = ("ingestion_timestamp",),
) -> DataFrame:
    """One tick per ``event_id``.

    ``global`` covers the whole batch DataFrame and keeps the earliest by ``order``.
    ``none`` leaves redelivered ticks in place. Across micro-batches :func:`not_stored`
    does the same: a watermark would discard every late tick, copy or not.
    """
    if scope == "none":
        return ticks
    if scope == "global":
        return first_per_key(ticks, ["event_id"], list(order))
    raise ValueError(f"unknown dedupe scope {scope!r}")


def enforce(ticks: DataFrame) -> DataFrame:
    """The silver columns in order and type; anything else is dropped."""
    return ticks.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER))


def not_stored(silver: DataFrame, path: str, wanted: Callable[[int], bool] = lambda load: True) -> DataFrame:
    """The ticks whose id the stored layer lacks, in the directories they belong to.

    Only those directories are read, of them only the loads for which ``wanted(load_id)``
    holds, and of these only the ids. A missing id counts as an id. The driver learns the
    directories of one batch, never rows.
    """
    parts = [F.concat(F.lit(f"{c}="), F.col(c)) for c in SILVER_PARTITIONS]
    touched = [r[0] for r in silver.select(F.concat_ws("/", *parts)).distinct().collect()]
    stored = stored_ids(silver.sparkSession, path.rstrip("/"), touched, wanted)
    if stored is None:
        return silver
    stored = stored.select(F.col("event_id").alias("_stored"))
    return silver.join(stored, F.col("event_id").eqNullSafe(F.col("_stored")), "left_anti")


def to_silver(bronze: DataFrame, dedup: str = "global") -> DataFrame:
    """Bronze to silver. Filtering comes first, so rejected rows never shuffle."""
    ticks = enrich(clean(bronze.drop("trade_conditions")))
    return enforce(dedupe(ticks, dedup))


def first_seen(silver: DataFrame, memory: str) -> DataFrame:
    """Of a stream, the ticks whose id has not come within ``memory``; of copies in one batch any.

    The clock of the state is the time of the batch, not of the tick: a tick is never late,
    however old its trade. An id is held for ``memory`` at least and twice that at most.
    """
    seen = silver.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", memory)
    return seen.dropDuplicatesWithinWatermark(["event_id"]).drop("_seen")


def quality_counters(bronze: DataFrame) -> DataFrame:
    """One row: ticks read, valid, distinct among the valid, and dropped."""
    per_id = (
        bronze.selectExpr("event_id", f"coalesce({VALID}, false) AS _ok")
        .groupBy("event_id")
        .agg(F.count("*").alias("n"), F.count_if("_ok").alias("valid"))
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_read"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("n_valid"),
        F.count_if(F.col("valid") > 0).alias("n_kept"),
    ).withColumn("n_dropped", F.col("n_read") - F.col("n_kept"))


def split_future(ticks: DataFrame, skew_ms: int) -> tuple[DataFrame, DataFrame]:
    """``(plausible, quarantine)``: ticks stamped ahead of their arrival are set aside.

    One such tick would move the global watermark and age out every other symbol.
    """
    ahead = F.coalesce(
        F.col("source_timestamp") > F.col("ingestion_timestamp") + F.lit(skew_ms), F.lit(False)
    )
    return ticks.filter(~ahead), ticks.filter(ahead)
