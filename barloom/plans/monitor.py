"""Latency, flow rate, silence and gaps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.times import as_utc, floor_div, micros_of_day_time
from barloom.operators.bars import as_moment
from barloom.session import stored


_BINS = 1024
# Rank error of the sketches is at most n / _ACCURACY.
_ACCURACY = 10_000


def latency(ticks: DataFrame, percents: tuple[int, ...] = (50, 95, 99)) -> DataFrame:
    """Arrival delay per symbol in milliseconds, with exact quantiles.

    A quantile is the least delay that the share of the ticks reaches. Mergeable sketches give
    a bracket for each, in one pass. Then the ticks are counted in the bins of the brackets,
    which shrink to the bin that holds the rank, until they are single delays: seldom more
    than two passes. However many ticks and distinct delays a symbol has, tasks send on a row
    for each sketch or bin, and no task ranks more than the bins of a bracket.
    """
    delays = ticks.select("symbol", (F.col("ingestion_timestamp") - F.col("source_timestamp")).alias("_d"))
    ends = [x for p in percents for x in (max(0.0, p / 100 - 2 / _ACCURACY), min(1.0, p / 100 + 2 / _ACCURACY))]
    stats = stored(
        delays.groupBy("symbol").agg(
            F.count("_d").alias("n_ticks"),
            F.expr("try_divide(sum(_d), count(_d))").alias("avg_ms"),
            F.min("_d").alias("min_ms"),
            F.max("_d").alias("max_ms"),
            F.percentile_approx("_d", ends, _ACCURACY).alias("_ends"),
        ),
        "delays",
    )
    brackets = stats.filter("n_ticks > 0").select(
        "symbol",
        F.explode(F.array(*[
            F.struct(
                F.lit(p).alias("percent"),
                F.expr(f"(n_ticks * {p} + 99) div 100").alias("rank"),
                F.col("_ends")[2 * i].alias("lo"),
                F.col("_ends")[2 * i + 1].alias("hi"),
                F.col("min_ms").alias("_min"),
                F.col("max_ms").alias("_max"),
            )
            for i, p in enumerate(percents)
        ])).alias("_q"),
    ).select("symbol", "_q.*")
    brackets, open_ = brackets.withColumn("_sure", F.lit(False)), True
    while open_:
        brackets = stored(_narrowed(delays, brackets), "brackets")
        open_ = not brackets.filter("NOT _sure").isEmpty()
    columns = [F.max(F.when(F.col("percent") == p, F.col("lo"))).alias(f"p{p}_ms") for p in percents]
    found = brackets.groupBy(F.col("symbol").alias("_symbol")).agg(*columns)
    rows = stats.join(found, F.col("symbol").eqNullSafe(F.col("_symbol")), "left")
    return rows.select("symbol", "n_ticks", "avg_ms", "min_ms", "max_ms", *(f"p{p}_ms" for p in percents))


def _narrowed(delays: DataFrame, brackets: DataFrame) -> DataFrame:
    """Each bracket cut to the bin that holds its rank, or moved to the side where the rank is."""
    held = brackets.withColumnRenamed("symbol", "_symbol").filter("NOT _sure")
    rows = delays.join(held, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_d") <= F.col("hi")))
    step = f"((hi - lo) div {_BINS} + 1)"
    bins = rows.withColumn("_bin", F.expr(f"CASE WHEN _d < lo THEN -1 ELSE (_d - lo) div {step} END"))
    keys = ["symbol", "percent"]
    counted = bins.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin"))
    at = counted.withColumn("_upto", upto).join(
        held.select("_symbol", F.col("percent").alias("_percent"), "rank"),
        F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("percent") == F.col("_percent")),
    )
    reached = at.filter("_upto >= rank").groupBy(F.col("symbol").alias("_s"), F.col("percent").alias("_p")).agg(F.min("_bin").alias("_bin"))
    cut = brackets.join(reached, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("percent") == F.col("_p")), "left")
    low = f"CASE WHEN _sure THEN lo WHEN _bin IS NULL THEN hi + 1 WHEN _bin < 0 THEN _min ELSE lo + _bin * {step} END"
    high = f"CASE WHEN _sure THEN hi WHEN _bin IS NULL THEN _max WHEN _bin < 0 THEN lo - 1 ELSE least(hi, lo + (_bin + 1) * {step} - 1) END"
    cut = cut.select("symbol", "percent", "rank", F.expr(low).alias("lo"), F.expr(high).alias("hi"), "_min", "_max", "_bin", "_sure")
    # a bin of one delay is the answer; a side to which the rank moved is counted again
    return cut.withColumn("_sure", F.expr("_sure OR (lo = hi AND coalesce(_bin >= 0, false))")).drop("_bin")


def flow_rate(ticks: DataFrame, width: str = "1 minute", ts: str = "trade_time") -> DataFrame:
    """Ticks and volume per window, class and symbol."""
    grouped = ticks.groupBy(F.window(ts, width).alias("_w"), "asset_class", "symbol").agg(
        F.count("*").alias("n_ticks"), F.sum("volume").alias("volume")
    )
    starts = grouped.withColumn("_start", F.col("_w.start"))
    return starts.select(
        as_utc(starts, "_start").alias("window_start"),
        "asset_class",
        "symbol",
        "n_ticks",
        "volume",
    )


def pulse(
    ticks: DataFrame,
    watchlist: DataFrame,
    now: datetime | Column | None = None,
    silence_seconds: int = 300,
    ts: str = "trade_time",
) -> DataFrame:
    """Seconds since each watchlist symbol's last tick, and whether it fell silent."""
    utc = ticks.withColumn("_t", as_utc(ticks, ts))
    last = utc.groupBy("symbol").agg(F.max("_t").alias("last_tick"), F.count("*").alias("n_ticks"))
    idle = floor_div(micros_of_day_time(as_moment(now) - F.col("last_tick")), 1_000_000)
    return (
        watchlist.select("symbol")
        .distinct()
        .join(last, "symbol", "left")
        .select(
            "symbol",
            "last_tick",
            F.coalesce("n_ticks", F.lit(0)).alias("n_ticks"),
            idle.alias("idle_seconds"),
            (F.col("last_tick").isNull() | (idle > silence_seconds)).alias("no_data"),
        )
    )


def gaps(bars: DataFrame) -> DataFrame:
    """Minutes without a bar between each symbol's first and last bar.

    Neighbours are found within a symbol's day, then across its days, so no task
    ever holds more than one day of minutes or one row per day of a symbol.
    """
    keyed = bars.select("symbol", "window_start", F.to_date("window_start").alias("_day"))
    in_day = Window.partitionBy("symbol", "_day").orderBy("window_start")
    inside = keyed.select(
        "symbol",
        F.col("window_start").alias("_from"),
        F.lead("window_start").over(in_day).alias("_to"),
    )
    days = keyed.groupBy("symbol", "_day").agg(
        F.min("window_start").alias("_first"), F.max("window_start").alias("_last")
    )
    across = days.select(
        "symbol",
        F.col("_last").alias("_from"),
        F.lead("_first").over(Window.partitionBy("symbol").orderBy("_day")).alias("_to"),
    )
    minute = F.expr("INTERVAL 1 MINUTE")
    holes = inside.unionByName(across).filter(F.col("_to") > F.col("_from") + minute)
    # A long hole is spread over its days first, so no row builds a huge array.
    per_day = holes.select(
        "symbol",
        "_from",
        "_to",
        F.explode(F.sequence(F.to_date("_from"), F.to_date("_to"))).alias("_d"),
    )
    start = F.greatest(F.col("_from") + minute, F.col("_d").cast("timestamp_ntz"))
    end = F.least(
        F.col("_to") - minute,
        F.col("_d").cast("timestamp_ntz") + F.expr("INTERVAL '23:59' HOUR TO MINUTE"),
    )
    return (
        per_day.select("symbol", start.alias("_s"), end.alias("_e"))
        .filter("_s <= _e")
        .select("symbol", F.explode(F.sequence("_s", "_e", minute)).alias("window_start"))
    )
