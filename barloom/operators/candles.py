"""Event-time windows to OHLCV candles, for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.times import as_utc, epoch_micros, floor_div, width_micros
from barloom.settings import CANDLE_WIDTH

_GROUP = ("_start", "symbol", "asset_class")
_UNIT_MICROS = {"ms": 1_000, "us": 1}
# Digits of DECIMAL(38), one of them kept for the sum's carry.
_KEY_DIGITS = 37


def rounded(value: str, decimals: int) -> str:
    """``round``, skipping its decimal arithmetic for values that are round already."""
    scale = f"{10**decimals}D"
    return (
        f"CASE WHEN abs({value}) < {2**52 // 10**decimals}D"
        f" AND floor({value} * {scale} + 0.5D) / {scale} = {value}"
        f" THEN {value} ELSE round({value}, {decimals}) END"
    )


# Prices are rounded beforehand (_p): rounding keeps order, so the extremes agree.
# Ties at one instant give the lowest price as the first and the highest as the last.
_AGGREGATES = {
    "open": "min_by(_p, _k)",
    "high": "max(_p)",
    "low": "min(_p)",
    "close": "max_by(_p, _k)",
    "volume": "sum(volume)",
    "_notional": "sum(price * volume)",
    "tick_count": "count(*)",
}


def _aggregates() -> list[Column]:
    return [F.expr(f"{text} AS {name}") for name, text in _AGGREGATES.items()]


def _ordered(offset: str, step: int, decimals: int) -> str:
    """One number in the order of (time within the window, price).

    A minimum by a struct would make Spark sort its input; by a DECIMAL it aggregates by
    hash. The price only decides between ticks of one instant, so those beyond the digits
    left for it count as equal there, and keep their own value as open and close.
    """
    moments = len(str(step))
    digits = min(27, _KEY_DIGITS - moments)
    most = f"1e{digits - 1 - decimals}D"
    price = f"CAST(least(greatest(_p, -{most}), {most}) * {10**decimals}D AS DECIMAL({digits},0))"
    return f"CAST({offset} AS DECIMAL({moments},0)) * CAST('1{'0' * digits}' AS DECIMAL({digits + 1},0)) + {price}"


def _finish(parts: DataFrame, start: str, decimals: int) -> DataFrame:
    vwap = "try_divide(_notional, volume)"
    return parts.selectExpr(
        "symbol",
        "asset_class",
        f"{start} AS window_start",
        "open",
        "high",
        "low",
        "close",
        f"{rounded('volume', decimals)} AS volume",
        f"coalesce({rounded(vwap, decimals)}, 0D) AS vwap",
        "tick_count",
    )


def candles(
    ticks: DataFrame,
    width: str = CANDLE_WIDTH,
    ts: str = "trade_time",
    watermark: str | None = None,
    decimals: int = 6,
    unit: str = "ms",
) -> DataFrame:
    """Candles per window, symbol and asset class.

    ``watermark`` bounds the state of a streaming query and drops later ticks; it is
    ignored for a batch DataFrame. ``ts`` is a timestamp of either type or, in batch,
    epoch milliseconds. ``unit`` (``ms`` or ``us``) is the resolution of the event
    time; a batch over finer times than declared fails rather than misorder them.

    Partial aggregation reduces each task's ticks to one row per candle before the
    only shuffle, so a hot symbol costs no more there than a quiet one.
    """
    per_unit = _UNIT_MICROS[unit]
    step = width_micros(width) // per_unit
    if ticks.isStreaming:
        if watermark:
            ticks = ticks.withWatermark(ts, watermark)
        moment = floor_div(epoch_micros(ticks, ts), per_unit)
        keys = [F.window(ts, width).alias("_w"), "symbol", "asset_class"]
    else:
        ticks = ticks.filter(F.col(ts).isNotNull())
        moment = _in_units(ticks, ts, unit)
        keys = list(_GROUP)
    priced = (
        ticks.select(*([ts] if ticks.isStreaming else []), "symbol", "asset_class", "price", "volume", moment.alias("_t"))
        .selectExpr("*", f"_t - pmod(_t, {step}) AS _start", f"{rounded('price', decimals)} AS _p")
        .selectExpr("*", f"{_ordered(f'pmod(_t, {step})', step, decimals)} AS _k")
    )
    grouped = priced.groupBy(*keys).agg(*_aggregates())
    if ticks.isStreaming:
        grouped = grouped.withColumn("_start", F.col("_w.start"))
        return _finish(grouped.withColumn("_start", as_utc(grouped, "_start")), "_start", decimals)
    start = f"timestampadd(MICROSECOND, _start * {per_unit}, timestamp_ntz'1970-01-01 00:00:00')"
    return _finish(grouped, start, decimals)


def _in_units(ticks: DataFrame, ts: str, unit: str) -> Column:
    if ticks.schema[ts].dataType.typeName() == "long":
        return F.col(ts)
    micros = epoch_micros(ticks, ts)
    if unit == "us":
        return micros
    finer = F.raise_error(F.lit(f"{ts} is finer than a millisecond: pass unit='us'"))
    return F.when(micros % 1000 != 0, finer.cast("bigint")).otherwise(floor_div(micros, 1000))


def distinct_symbols(bars: DataFrame) -> DataFrame:
    """Symbols and candles per window."""
    return bars.groupBy("window_start").agg(
        F.countDistinct("symbol").alias("n_symbols"), F.count("*").alias("n_candles")
    )
