import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.functions.symbols import asset_class
from barloom.functions.times import epoch_ms, ms_to_utc, utc_wall
from barloom.operators.candles import candles, distinct_symbols, rounded

EPOCH = datetime(1970, 1, 1)


def ticks(spark, rows):
    """rows: (symbol, ms, price, volume)"""
    df = spark.createDataFrame(rows, "symbol string, ms bigint, price double, volume double")
    return df.withColumns(
        {"trade_time": F.timestamp_millis("ms"), "asset_class": asset_class(F.col("symbol"))}
    )


def brute(rows, step_ms, decimals=6):
    groups = {}
    for symbol, ms, price, volume in rows:
        groups.setdefault((symbol, ms - ms % step_ms), []).append((ms, price, volume))
    out = {}
    for (symbol, start), members in groups.items():
        total = sum(v for _, _, v in members)
        out[symbol, EPOCH + timedelta(milliseconds=start)] = (
            min(m[:2] for m in members)[1],
            max(m[1] for m in members),
            min(m[1] for m in members),
            max(m[:2] for m in members)[1],
            total,
            sum(p * v for _, p, v in members) / total,
            len(members),
        )
    return out


def check(df, want, decimals=6):
    rows = df.collect()
    got = {
        (r.symbol, r.window_start): (r.open, r.high, r.low, r.close, r.volume, r.vwap, r.tick_count)
        for r in rows
    }
    assert len(rows) == len(got)
    assert got.keys() == want.keys()
    for key, values in want.items():
        for a, b in zip(got[key], values, strict=True):
            assert math.isclose(a, b, rel_tol=1e-12, abs_tol=0.6 * 10**-decimals), (key, got[key], values)


def test_ties_open_low_close_high(spark):
    rows = [("A", 5, 10.0, 1.0), ("A", 5, 9.0, 1.0), ("A", 9, 7.0, 2.0), ("A", 9, 8.0, 1.0)]
    row = candles(ticks(spark, rows)).collect()[0]
    assert (row.open, row.high, row.low, row.close) == (9.0, 10.0, 7.0, 8.0)
    assert (row.volume, row.vwap, row.tick_count) == (5.0, 8.2, 4)
    assert row.window_start == EPOCH


@pytest.mark.parametrize(
    ("width", "step", "unit"),
    [
        ("1 minute", 60_000, "ms"),
        ("1 minute", 60_000, "us"),
        ("1 hour", 3_600_000, "ms"),
        ("1 day", 86_400_000, "ms"),
        ("1 day", 86_400_000, "us"),
        ("1 week", 604_800_000, "ms"),
    ],
)
def test_against_brute_force(spark, width, step, unit):
    """Prices on both sides of what the packed key can hold, many equal times."""
    rnd = random.Random(step)
    base = 1704067200000
    prices = [0.01, 1.5, 66.0, 70.0, 2146.0, 2150.25, 68000.0, 70000.0, 137000.0, 138000.5, 1.5e8, 9e12]
    rows = [
        (
            rnd.choice("ABC"),
            base + rnd.randrange(0, 4 * step, max(step // 40, 1)),
            rnd.choice(prices) + rnd.randrange(100) / 100,
            float(rnd.randrange(1, 50)),
        )
        for _ in range(600)
    ]
    if step == 604_800_000:  # weeks are counted from the epoch, a Thursday
        base -= base % step
    check(candles(ticks(spark, rows), width, unit=unit), brute(rows, step))


def test_packed_and_odd_ticks_share_a_candle(spark):
    rows = [("A", 1, 2e8, 1.0), ("A", 2, 5.0, 1.0), ("A", 3, 4.0, 1.0), ("A", 4, 3e8, 1.0), ("B", 1, 3.0, 2.0)]
    check(candles(ticks(spark, rows)), brute(rows, 60_000))


def test_time_columns_agree(spark):
    rows = [("A", 61_001, 2.0, 1.0), ("A", 61_000, 3.0, 1.0), ("A", -1, 4.0, 1.0)]
    df = ticks(spark, rows).withColumn("ntz", ms_to_utc(F.col("ms")))
    want = brute(rows, 60_000)
    for column in ("trade_time", "ntz", "ms"):
        check(candles(df, ts=column), want)


def test_zone_does_not_matter(new_york):
    # 2024-03-10 02:30 does not exist in this zone, 2024-11-03 01:30 exists twice.
    moments = [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30), datetime(2024, 7, 1, 0, 0, 30)]
    rows = [("A", int((m - EPOCH).total_seconds() * 1000), 2.0, 1.0) for m in moments]
    df = ticks(new_york, rows).withColumn("ntz", ms_to_utc(F.col("ms")))
    want = brute(rows, 60_000)
    for column in ("trade_time", "ntz", "ms"):
        check(candles(df, ts=column), want)
    same = df.select(epoch_ms(df, "ntz").alias("a"), epoch_ms(df, "trade_time").alias("b"), "ms")
    assert same.filter("a <> ms OR b <> ms").count() == 0
    assert df.filter(utc_wall(F.col("trade_time")) != F.col("ntz")).count() == 0


def test_finer_times_are_refused_or_declared(spark):
    df = ticks(spark, [("A", 0, 2.0, 1.0), ("A", 0, 1.0, 1.0)]).withColumn(
        "trade_time", F.timestamp_micros(F.when(F.col("price") == 2, 3).otherwise(7))
    )
    with pytest.raises(Exception, match="finer than a millisecond"):
        candles(df).collect()
    row = candles(df, unit="us").collect()[0]
    assert (row.open, row.close) == (2.0, 1.0)


def test_missing_values(spark):
    df = ticks(spark, [("A", 0, None, 1.0), (None, 0, 2.0, 1.0), (None, 1, 4.0, 1.0), ("A", 5, 3.0, 0.0)])
    rows = {r.symbol: r for r in candles(df).collect()}
    assert (rows[None].open, rows[None].close, rows[None].tick_count) == (2.0, 4.0, 2)
    assert (rows["A"].open, rows["A"].close, rows["A"].tick_count) == (None, 3.0, 2)
    assert candles(df.filter("false")).count() == 0


def test_zero_volume_has_zero_vwap(spark):
    assert candles(ticks(spark, [("A", 0, 3.0, 0.0)])).collect()[0].vwap == 0.0


def test_rounding(spark):
    values = [0.1234565, 5e-7, -0.1234565, 1e17, 2.5, float("nan"), float("inf"), None, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.selectExpr(f"{rounded('x', 6)} AS a", "round(x, 6) AS b")
    assert got.filter("NOT a <=> b").count() == 0
    row = candles(ticks(spark, [("A", 0, 1.23456789, 1.0)]), decimals=2).collect()[0]
    assert (row.open, row.high, row.low, row.close, row.vwap) == (1.23,) * 5


def test_candle_properties(spark):
    rnd = random.Random(3)
    rows = [("A", rnd.randrange(600_000), rnd.uniform(1, 9), rnd.uniform(1, 5)) for _ in range(500)]
    bars = candles(ticks(spark, rows))
    assert bars.filter("open > high OR open < low OR close > high OR close < low").count() == 0
    assert bars.filter("vwap > high + 1e-6 OR vwap < low - 1e-6").count() == 0
    assert math.isclose(bars.agg(F.sum("volume")).first()[0], sum(r[3] for r in rows), abs_tol=1e-4)
    assert bars.groupBy("symbol", "window_start").count().filter("count > 1").count() == 0


def test_aggregates_by_hash_in_one_shuffle(spark):
    df = candles(ticks(spark, [("A", 1, 2.0, 1.0)]))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("HashAggregate") >= 2
    assert "SortAggregate" not in plan
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_distinct_symbols(spark):
    bars = candles(ticks(spark, [("A", 0, 1.0, 1.0), ("B", 0, 1.0, 1.0), ("A", 60_000, 1.0, 1.0)]))
    assert sorted(tuple(r)[1:] for r in distinct_symbols(bars).collect()) == [(1, 1), (2, 2)]
