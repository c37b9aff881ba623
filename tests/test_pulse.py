import random
import time

import pytest
from test_streams import trade

from barloom.schemas import TRADE
from barloom.streaming.pulse import joined, judged, start_pulse, stretches

SCHEMA = "symbol STRING, status STRING, since TIMESTAMP_NTZ, at TIMESTAMP_NTZ"
MINUTE = 60_000


def land(spark, path, name, times, symbol="AAPL"):
    rows = [trade(f"{name}{i}", ms, symbol=symbol) for i, ms in enumerate(times)]
    spark.createDataFrame(rows, TRADE).write.parquet(f"{path}/{name}")


def run(spark, tmp_path, watchlist=("AAPL", "MSFT"), **how):
    source = spark.readStream.schema(TRADE).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    return start_pulse(source, list(watchlist), str(tmp_path / "out"), str(tmp_path / "ck"), **how)


def minutes(spark, tmp_path, symbol="AAPL"):
    rows = spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).filter(f"symbol = '{symbol}'")
    as_minute = lambda t: None if t is None else int((t - t.min.replace(year=1970)).total_seconds() // 60)
    return sorted((as_minute(r["at"]), r["status"], as_minute(r["since"])) for r in rows.collect())


def test_alarms_over_restarts(spark, tmp_path):
    """Silence within a batch, between batches and runs; a tick out of order prevents an alarm."""
    land(spark, tmp_path / "in", "a", [m * MINUTE for m in (0, 3, 12, 14)])
    land(spark, tmp_path / "in", "a2", [m * MINUTE for m in range(0, 16, 2)], "MSFT")
    run(spark, tmp_path, delay="3 minutes").awaitTermination()
    assert minutes(spark, tmp_path) == [(8, "silent", 3)]  # the feed stands at 14 - 3
    land(spark, tmp_path / "in", "b", [21 * MINUTE, 18 * MINUTE])
    run(spark, tmp_path, delay="3 minutes").awaitTermination()
    assert minutes(spark, tmp_path) == [(8, "silent", 3), (12, "back", 3)]
    land(spark, tmp_path / "in", "c", [m * MINUTE for m in (40, 44, 48)])
    run(spark, tmp_path, delay="3 minutes").awaitTermination()
    want = [(8, "silent", 3), (12, "back", 3), (26, "silent", 21), (40, "back", 21)]
    assert minutes(spark, tmp_path) == want
    run(spark, tmp_path, delay="3 minutes").awaitTermination()
    assert minutes(spark, tmp_path) == want
    assert minutes(spark, tmp_path, "MSFT") == [(19, "silent", 14)]


def test_the_clock_goes_on_without_ticks(spark, tmp_path):
    land(spark, tmp_path / "in", "a", [0])
    query = run(spark, tmp_path, every="1 second", silence="4 seconds", clock="arrival")
    try:
        def status(symbol):
            rows = spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).filter(f"symbol = '{symbol}'")
            return [r["status"] for r in rows.orderBy("at").collect()]

        def until(check):
            deadline = time.time() + 90
            while time.time() < deadline and not check():
                time.sleep(0.5)
            assert check()

        until(lambda: status("AAPL") == ["silent"] and status("MSFT") == ["silent"])
        land(spark, tmp_path / "in", "b", [MINUTE], "MSFT")
        until(lambda: status("MSFT")[:2] == ["silent", "back"])
        assert status("AAPL") == ["silent"]
    finally:
        query.stop()


def plain(times, limit, now):
    """All rows that are certain once every tick up to ``now`` is there."""
    rows, times = [], sorted(set(times))
    for i, t in enumerate(times):
        following = times[i + 1] if i + 1 < len(times) else None
        if t <= now and t + limit <= now and (following is None or following > t + limit):
            rows.append(("silent", t, t + limit))
            if following is not None and following <= now:
                rows.append(("back", t, following))
    return rows


@pytest.mark.parametrize("seed", range(200))
def test_judged_in_any_order_of_arrival(seed):
    rnd = random.Random(seed)
    limit, times = rnd.choice([1, 5, 20]), [rnd.randrange(300) for _ in range(rnd.randrange(1, 40))]
    delay = rnd.choice([0, 10, 50])
    arrival = sorted(times, key=lambda t: (t + rnd.randrange(delay + 1), t))
    state, rows, now = (None, False, []), [], -1
    for t in arrival:
        last, silent, ahead = state
        state, out = (lambda x: (x[:3], x[3]))(judged(last, silent, [*ahead, (t, t)], limit, now))
        rows += out
        now = max(now, t - delay - 1)
        state, out = (lambda x: (x[:3], x[3]))(judged(*state, limit, now))
        rows += out
    assert sorted(rows) == sorted(plain(times, limit, now))


def test_stretches_hold_what_the_pulse_needs(spark):
    rnd = random.Random(1)
    rows = [trade(str(i), rnd.randrange(10_000), symbol=rnd.choice(["A", "B"])) for i in range(400)] + [trade("x", None), trade("y", 5, symbol=None)]
    found = stretches(spark.createDataFrame(rows, TRADE).repartition(3), 60).collect()
    for symbol in "AB":
        times = sorted(r[4] for r in rows if r[1] == symbol and r[4] is not None)
        assert joined([(r["first"], r["last"]) for r in found if r["symbol"] == symbol], 60) == joined([(t, t) for t in times], 60)
    assert {r["symbol"] for r in found} == {"A", "B"}


def test_an_unknown_clock_is_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="sundial"):
        run(spark, tmp_path, clock="sundial")
