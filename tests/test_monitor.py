import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators.lookup import watchlist_frame
from barloom.plans.monitor import flow_rate, gaps, latency, pulse

T0 = datetime(2024, 1, 1)


def bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz")


@pytest.mark.parametrize("seed", range(3))
def test_gaps_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    present = {s: sorted(rnd.sample(range(6000), 40)) for s in "AB"}
    present["C"] = [5]
    present["D"] = [1439, 1440, 1442]
    rows = [(s, T0 + timedelta(minutes=m)) for s, ms in present.items() for m in ms]
    want = {
        (s, T0 + timedelta(minutes=m))
        for s, ms in present.items()
        for m in range(ms[0], ms[-1])
        if m not in set(ms)
    }
    got = gaps(bars(spark, rows)).collect()
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_gaps_ignore_the_session_zone(new_york):
    start = datetime(2024, 3, 10, 1, 58)
    rows = [("A", start), ("A", start + timedelta(minutes=5))]
    got = sorted(r.window_start for r in gaps(bars(new_york, rows)).collect())
    assert got == [start + timedelta(minutes=m) for m in range(1, 5)]


def test_gap_windows_stay_within_a_day(spark):
    df = gaps(bars(spark, [("A", T0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def ticks(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, ms bigint, seen bigint")
    return df.select(
        "symbol",
        F.col("ms").alias("source_timestamp"),
        F.col("seen").alias("ingestion_timestamp"),
        F.timestamp_millis("ms").alias("trade_time"),
        F.lit("Stock").alias("asset_class"),
        F.lit(2.0).alias("volume"),
    )


def test_latency(spark):
    row = latency(ticks(spark, [("A", 0, d) for d in range(1, 101)])).collect()[0]
    assert (row.n_ticks, row.avg_ms, row.min_ms, row.max_ms) == (100, 50.5, 1, 100)
    assert (row.p50_ms, row.p95_ms, row.p99_ms) == (50, 95, 99)


def test_flow_rate(new_york):
    rows = flow_rate(ticks(new_york, [("A", 0, 0), ("A", 59_999, 0), ("A", 60_000, 0)])).collect()
    got = sorted((r.window_start, r.n_ticks, r.volume) for r in rows)
    assert got == [(datetime(1970, 1, 1), 2, 4.0), (datetime(1970, 1, 1, 0, 1), 1, 2.0)]


def test_pulse(new_york):
    rows = [("A", 0, 0), ("A", 100_000, 0), ("B", 390_000, 0), ("Z", 0, 0)]
    watchlist = watchlist_frame(new_york, ["A", "B", "C"])
    now = datetime(1970, 1, 1, 0, 6, 41)
    got = {r.symbol: tuple(r)[1:] for r in pulse(ticks(new_york, rows), watchlist, now).collect()}
    assert got == {
        "A": (datetime(1970, 1, 1, 0, 1, 40), 2, 301, True),
        "B": (datetime(1970, 1, 1, 0, 6, 30), 1, 11, False),
        "C": (None, 0, None, True),
    }


@pytest.mark.parametrize("spread", [1, 3, 500, 10**6, 2**40])
def test_quantiles_are_exact(spark, spread):
    """One symbol with most rows; ties, negative and missing delays, and a symbol without any."""
    rnd = random.Random(spread)
    delays = {"HOT": [rnd.randrange(-spread, spread) for _ in range(5000)], "ONE": [7], "TIES": [3] * 40 + [9] * 60, None: [1, 2]}
    rows = [(s, 0, d) for s, ds in delays.items() for d in ds] + [("HOT", 0, None), ("NONE", None, 5)]
    got = {r["symbol"]: r for r in latency(ticks(spark, rows).repartition(4)).collect()}
    assert set(got) == {*delays, "NONE"}
    for symbol, ds in delays.items():
        ds = sorted(ds)
        r = got[symbol]
        assert (r["n_ticks"], r["min_ms"], r["max_ms"]) == (len(ds), ds[0], ds[-1])
        assert r["avg_ms"] == pytest.approx(sum(ds) / len(ds))
        assert [r[f"p{p}_ms"] for p in (50, 95, 99)] == [ds[-(-len(ds) * p // 100) - 1] for p in (50, 95, 99)]
    assert (got["NONE"]["n_ticks"], got["NONE"]["p50_ms"], got["NONE"]["avg_ms"]) == (0, None, None)


def test_quantiles_do_not_hang_on_the_sketch(spark, monkeypatch):
    """Brackets that miss the rank on either side are moved, not trusted."""
    from barloom.plans import monitor

    rows = [("A", 0, i * i) for i in range(3000)]
    for wrong in (0.1, 0.9):
        approx = F.percentile_approx
        with monkeypatch.context() as patch:
            patch.setattr(monitor.F, "percentile_approx", lambda c, ends, accuracy, w=wrong: approx(c, [w] * len(ends), accuracy))
            got = latency(ticks(spark, rows)).first()
        assert [got[f"p{p}_ms"] for p in (50, 95, 99)] == [(3000 * p // 100 - 1) ** 2 for p in (50, 95, 99)]
