import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators.candles import candles
from barloom.operators.silver import to_silver
from barloom.plans.replay import register_views, replay
from barloom.schemas import BRONZE, OHLCV_1M, SILVER, SILVER_STORED, TRADE
from barloom.sources.connectors import read_frames, read_silver
from barloom.sources.mart import Mart
from barloom.streaming import jobs
from barloom.streaming.metrics import RowCounters, late_rows

START = 1704103200000  # 2024-01-01 10:00 UTC
EPOCH = datetime(1970, 1, 1)


def at(minute, second=0):
    return START + (minute * 60 + second) * 1000


def clock(minute):
    return EPOCH + timedelta(milliseconds=at(minute))


def trade(event_id, ms, price=1.0, volume=1.0, symbol="AAPL"):
    return (event_id, symbol, price, volume, ms, ms, [])


def land(spark, path, rows, name):
    """One more file; file time orders the files of a stream."""
    jobs.to_bronze(spark.createDataFrame(rows, TRADE)).coalesce(1).write.parquet(f"{path}/{name}")
    time.sleep(1.1)


def bars_of(df):
    cols = ["symbol", "asset_class", "window_start", "open", "high", "low", "close", "volume", "vwap", "tick_count"]
    return sorted(df.select(*cols).collect())


def files_as_stream(spark, path, schema, max_files=1):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", "true").parquet(path)


def write_files(spark, path, silver, n):
    rows = silver.orderBy("source_timestamp").collect()
    size = -(-len(rows) // n)
    for i in range(n):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], silver.schema).coalesce(1)
        part.write.mode("append").parquet(path)
        if n > 1:
            time.sleep(1.05)


@pytest.mark.parametrize("n_files", [1, 3])
def test_stream_equals_batch(spark, tmp_path, n_files):
    rows = [
        trade(f"e{i}", at(i // 7, (i * 13) % 60), 1.0 + (i * 37) % 11, 1.0 + i % 5, "AAPL" if i % 3 else "BINANCE:X")
        for i in range(90)
    ]
    silver = to_silver(jobs.to_bronze(spark.createDataFrame(rows, TRADE)))
    write_files(spark, str(tmp_path / "in"), silver, n_files)
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M, "hour")
    stream = files_as_stream(spark, str(tmp_path / "in"), SILVER)
    query = jobs.start_gold(stream, mart, str(tmp_path / "ck"))
    query.awaitTermination()
    assert late_rows(query) == 0
    assert bars_of(mart.read()) == bars_of(candles(silver))


def test_late_ticks(spark, tmp_path):
    """Up to 10:20 first; 10:16 still counts, and 10:00:50 comes too late. Spark lets a
    batch drop what was late at the end of the batch before its predecessor."""
    ticks = str(tmp_path / "in")
    frames = [
        [trade("a", at(0, 10), 5.0), trade("b", at(20), 6.0)],
        [trade("c", at(16), 7.0), trade("e", at(20, 30), 9.0)],
        [trade("d", at(0, 50), 8.0), trade("f", at(20, 40), 4.0)],
    ]
    silver = [to_silver(jobs.to_bronze(spark.createDataFrame(f, TRADE))) for f in frames]
    for part in silver:
        part.coalesce(1).write.mode("append").parquet(ticks)
        time.sleep(1.1)
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M, "hour")
    query = jobs.start_gold(files_as_stream(spark, ticks, SILVER), mart, str(tmp_path / "ck"))
    query.awaitTermination()
    assert late_rows(query) == 1
    got = {r.window_start: (r.open, r.close, r.tick_count) for r in mart.read().collect()}
    assert got == {
        clock(0): (5.0, 5.0, 1),
        clock(16): (7.0, 7.0, 1),
        clock(20): (6.0, 4.0, 3),
    }


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    ticks, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M, "hour")
    for i, prices in enumerate([(5.0, 3.0), (9.0, 2.0)]):
        rows = [trade(f"{i}-{j}", at(0, 10 * i + j), p) for j, p in enumerate(prices)]
        to_silver(jobs.to_bronze(spark.createDataFrame(rows, TRADE))).write.mode("append").parquet(ticks)
        stream = files_as_stream(spark, ticks, SILVER, 10)
        jobs.start_gold(stream, mart, ck).awaitTermination()
        time.sleep(1.1)
    row = mart.read().collect()[0]
    assert (row.open, row.high, row.low, row.close) == (5.0, 9.0, 2.0, 2.0)
    assert (row.volume, row.tick_count) == (4.0, 4)
    jobs.start_gold(files_as_stream(spark, ticks, SILVER, 10), mart, ck).awaitTermination()
    assert mart.read().collect()[0].tick_count == 4


def test_failed_write_fails_the_query(spark, tmp_path):
    class Broken(Mart):
        def merge(self, *args, **kwargs):
            raise RuntimeError("no store")

    ticks = str(tmp_path / "in")
    to_silver(jobs.to_bronze(spark.createDataFrame([trade("a", at(0))], TRADE))).write.parquet(ticks)
    mart = Broken(spark, str(tmp_path / "mart"), OHLCV_1M)
    query = jobs.start_gold(files_as_stream(spark, ticks, SILVER), mart, str(tmp_path / "ck"))
    with pytest.raises(Exception, match="no store"):
        query.awaitTermination()
    good = Mart(spark, str(tmp_path / "mart"), OHLCV_1M)
    stream = files_as_stream(spark, ticks, SILVER)
    jobs.start_gold(stream, good, str(tmp_path / "ck")).awaitTermination()
    assert good.read().count() == 1


@pytest.mark.parametrize(("dedup", "kept"), [("state", 2), ("stored", 2), ("batch", 3)])
def test_redelivery_in_a_later_batch(spark, tmp_path, dedup, kept):
    bronze = str(tmp_path / "bronze")
    land(spark, bronze, [trade("a", at(0)), trade("a", at(0)), trade("z", at(0), -1.0)], "f1")
    land(spark, bronze, [trade("a", at(0)), trade("b", at(1))], "f2")
    out, ck = str(tmp_path / "silver"), str(tmp_path / "ck")
    stream = files_as_stream(spark, bronze, BRONZE)
    jobs.start_silver(stream, out, ck, dedup=dedup).awaitTermination()
    assert spark.read.schema(SILVER).parquet(out).count() == kept


def frame(*elements):
    return json.dumps({"type": "trade", "data": list(elements)})


def test_medallion_from_text_files(spark, tmp_path):
    good = [{"s": "AAPL", "p": 10 + i, "v": 2, "t": at(0, i)} for i in range(3)]
    lines = [frame(*good), '{"type":"ping"}', "junk", frame({"s": "AAPL"}), frame({"s": "X", "p": 0, "v": 1, "t": at(0)})]
    (tmp_path / "frames").mkdir()
    (tmp_path / "frames" / "a.txt").write_text("\n".join(lines))
    counters = RowCounters()
    spark.streams.addListener(counters)
    try:
        source = read_frames(spark, "text", str(tmp_path / "frames"))
        root = str(tmp_path)
        jobs.start_bronze(source, f"{root}/bronze", f"{root}/c1", event_id="payload").awaitTermination()
        jobs.start_quarantine(source, f"{root}/bad", f"{root}/c2").awaitTermination()
        bronze = jobs.stream_bronze(spark, f"{root}/bronze", max_files=5)
        jobs.start_silver(bronze, f"{root}/silver", f"{root}/c3").awaitTermination()
        mart = Mart(spark, f"{root}/mart", OHLCV_1M)
        silver = jobs.stream_silver(spark, f"{root}/silver")
        jobs.start_gold(silver, mart, f"{root}/c4").awaitTermination()
        deadline = time.time() + 20
        while time.time() < deadline and counters.totals["silver_kept"] < 3:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(counters)
    reasons = spark.read.parquet(f"{root}/bad").groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in reasons} == {"bad_json": 1, "bad_price": 1}
    row = mart.read().collect()[0]
    assert (row.symbol, row.open, row.close, row.volume, row.tick_count) == ("AAPL", 10.0, 12.0, 6.0, 3)
    assert counters.totals["bronze"] == 4
    assert counters.totals["quarantine"] == 2
    assert counters.totals["silver_read"] == 4
    assert counters.totals["silver_kept"] == 3
    assert counters.failures == 0

    stored = spark.read.schema(BRONZE).parquet(f"{root}/bronze")
    assert bars_of(replay(stored)) == bars_of(mart.read())
    assert replay(stored, "2024-01-02").count() == 0
    register_views(mart)
    assert spark.sql("SELECT max(high) AS h FROM ohlcv_1m WHERE symbol = 'AAPL'").first().h == 12.0


def test_silver_as_of_an_earlier_moment(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = to_silver(jobs.to_bronze(spark.createDataFrame([trade("a", at(0))], TRADE)))
    jobs.write_silver(first, path)
    time.sleep(2.1)
    moment = spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss\") AS t").first().t
    time.sleep(1.1)
    second = to_silver(jobs.to_bronze(spark.createDataFrame([trade("b", at(1))], TRADE)))
    jobs.write_silver(second, path)
    assert [r.event_id for r in read_silver(spark, path, as_of=moment).collect()] == ["a"]
    assert read_silver(spark, path).count() == 2


def test_skewed_day_is_split_by_the_writer(spark, tmp_path):
    """The rebalance hint leaves the split of a large day to AQE."""
    df = jobs._by_partition(spark.range(10).withColumn("year", F.lit("2024")), ("year",))
    df.collect()
    assert "REBALANCE_PARTITIONS_BY_COL" in df._jdf.queryExecution().executedPlan().toString()


def test_topic_records_as_source(spark, tmp_path):
    from barloom.operators.frames import encode_trades

    records = encode_trades(spark.createDataFrame([trade("a", at(0))], TRADE))
    broken = spark.createDataFrame([(b"k", b"{x")], records.schema)
    records.unionByName(broken).coalesce(1).write.parquet(str(tmp_path / "topic"))
    source = spark.readStream.schema(records.schema).parquet(str(tmp_path / "topic"))
    out = str(tmp_path / "bronze")
    jobs.start_bronze(source, out, str(tmp_path / "ck"), topic=True).awaitTermination()
    assert [r.event_id for r in spark.read.schema(BRONZE).parquet(out).collect()] == ["a"]
    bad = str(tmp_path / "bad")
    jobs.start_quarantine(source, bad, str(tmp_path / "ck2"), topic=True).awaitTermination()
    assert spark.read.parquet(bad).count() == 1


def test_live_triggers(spark, tmp_path):
    """With an interval the query keeps running until it is stopped."""
    ticks = str(tmp_path / "in")
    to_silver(jobs.to_bronze(spark.createDataFrame([trade("a", at(0))], TRADE))).write.parquet(ticks)
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M)
    stream = files_as_stream(spark, ticks, SILVER)
    query = jobs.start_gold(stream, mart, str(tmp_path / "ck"), every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
        assert mart.read().count() == 1
    finally:
        query.stop()


def test_live_pipeline(spark, tmp_path, monkeypatch):
    """All hops at once, started before there is any data."""
    from barloom import settings
    from barloom.plans.pipeline import minute_mart, start_live

    for name in ("BRONZE_TRIGGER", "SILVER_TRIGGER", "GOLD_TRIGGER"):
        monkeypatch.setattr(settings, name, "1 second")
    root = str(tmp_path / "lake")
    (tmp_path / "frames").mkdir()
    mart = minute_mart(spark, root)
    queries = start_live(read_frames(spark, "text", str(tmp_path / "frames")), root, mart)
    try:
        (tmp_path / "frames" / "a.txt").write_text(frame({"s": "AAPL", "p": 3, "v": 2, "t": at(0)}))
        deadline = time.time() + 90
        while time.time() < deadline and mart.read().count() == 0:
            time.sleep(0.5)
        assert all(q.isActive for q in queries)
        assert [r.close for r in mart.read().collect()] == [3.0]
    finally:
        for q in queries:
            q.stop()


def test_late_ticks_stay_in_the_clean_layer(spark, tmp_path):
    """Hours late, after another batch moved on; one is delivered twice, one batch replayed."""
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for i, rows in enumerate(
        [[trade("a", at(60))], [trade("b", at(61))], [trade("c", at(0)), trade("d", at(62)), trade("a", at(60))]]
    ):
        land(spark, bronze, rows, f"f{i}")
    jobs.start_silver(files_as_stream(spark, bronze, BRONZE), out, str(tmp_path / "ck")).awaitTermination()
    stored = spark.read.parquet(out)
    assert {r.event_id: r.load_id for r in stored.collect()} == {"a": 0, "b": 1, "c": 2, "d": 2}
    jobs.append_silver(spark.read.schema(BRONZE).option("recursiveFileLookup", "true").parquet(bronze), out, 3)
    assert spark.read.parquet(out).count() == 4


def test_a_tick_from_the_future_moves_no_watermark(spark, tmp_path):
    ticks = str(tmp_path / "in")
    ahead = ("x", "AAPL", 1.0, 1.0, at(3000), at(0), [])
    for rows in ([trade("a", at(0)), ahead], [trade("b", at(1))], [trade("c", at(2))]):
        to_silver(jobs.to_bronze(spark.createDataFrame(rows, TRADE))).coalesce(1).write.mode("append").parquet(ticks)
        time.sleep(1.1)
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M, "hour")
    jobs.start_gold(files_as_stream(spark, ticks, SILVER), mart, str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.window_start for r in mart.read().collect()) == [clock(0), clock(1), clock(2)]


def test_backfill_loses_nothing(spark, tmp_path):
    """Equal frames are two trades, a redelivered record is one, and what is refused is kept."""
    from barloom.plans.pipeline import backfill, minute_mart

    same = frame({"s": "AAPL", "p": 10, "v": 2, "t": at(0)})
    rows = [(same, "t/0/1"), (same, "t/0/2"), (same, "t/0/1"), ("junk", "t/0/3"), (frame({"s": "X"}), "t/0/4")]
    rows += [(frame({"s": "MSFT", "p": 1, "v": 1, "t": at(60 * 24 * d)}), f"t/1/{d}") for d in range(4)]
    frames = spark.createDataFrame(rows, "value string, record string")
    root = str(tmp_path / "lake")
    mart = minute_mart(spark, root)
    backfill(frames, root, mart, watchlist=["AAPL", "MSFT"], days_at_once=2)
    got = {(r.symbol, r.window_start): r.tick_count for r in mart.read().collect()}
    assert got == {("AAPL", clock(0)): 2} | {("MSFT", clock(60 * 24 * d)): 1 for d in range(4)}
    assert sorted(r.reject_reason for r in spark.read.parquet(f"{root}/rejects").collect()) == ["bad_json", "bad_price"]
    backfill(frames, root, mart, watchlist=["AAPL"], load_id=7)
    assert spark.read.schema(SILVER_STORED).parquet(f"{root}/silver").filter("load_id <> 0").count() == 0
    assert {(r.symbol, r.window_start): r.tick_count for r in mart.read().collect()} == got


def test_corrupt_files_can_be_skipped(spark, tmp_path):
    path = tmp_path / "bronze"
    jobs.write_bronze(spark.createDataFrame([trade("a", at(0))], TRADE), str(path))
    day = next(path.rglob("*.parquet")).parent
    (day / "broken.parquet").write_bytes(b"not parquet")
    strict = jobs.stream_bronze(spark, str(path))
    with pytest.raises(Exception, match="broken.parquet"):
        jobs.start_silver(strict, str(tmp_path / "s1"), str(tmp_path / "c1")).awaitTermination()
    lenient = jobs.stream_bronze(spark, str(path), skip_corrupt=True)
    jobs.start_silver(lenient, str(tmp_path / "s2"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.schema(SILVER).parquet(str(tmp_path / "s2")).count() == 1


class Stopped(Exception):
    pass


@pytest.mark.parametrize("dedup", ["state", "stored", "batch"])
def test_a_batch_that_is_replayed_after_its_write_adds_nothing(spark, tmp_path, monkeypatch, dedup):
    """The query fails between the write and the commit; rows without an id are rows too."""
    bronze, out, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    land(spark, bronze, [trade("a", at(0)), trade(None, at(3)), trade("b", at(60 * 24))], "f1")
    write, calls = jobs.write_silver, []

    def failing(silver, path, load_id=0):
        if not calls:  # the first attempt leaves only a part of its load
            silver = silver.where("event_id = 'a'")
        write(silver, path, load_id)
        calls.append(load_id)
        if len(calls) < 3:
            raise Stopped("after the write")

    monkeypatch.setattr(jobs, "write_silver", failing)
    for _ in range(2):
        with pytest.raises(Exception, match="after the write"):
            jobs.start_silver(files_as_stream(spark, bronze, BRONZE), out, ck, dedup=dedup).awaitTermination()
    jobs.start_silver(files_as_stream(spark, bronze, BRONZE), out, ck, dedup=dedup).awaitTermination()
    assert calls == [0, 0, 0]
    rows = spark.read.schema(SILVER_STORED).parquet(out).collect()
    assert sorted((str(r.event_id), r.load_id) for r in rows) == [("None", 0), ("a", 0), ("b", 0)]


def looked_up(monkeypatch):
    """The loads that each batch reads back, filled as batches run."""
    from barloom.operators import silver

    read, seen = silver.stored_ids, []

    def spy(spark, path, directories, wanted):
        loads = set()
        found = read(spark, path, directories, lambda n: wanted(n) and (loads.add(n) or True))
        seen.append(loads)
        return found

    monkeypatch.setattr(silver, "stored_ids", spy)
    return seen


def test_what_a_batch_reads_back_does_not_grow_with_the_day(spark, tmp_path, monkeypatch):
    bronze, out, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    seen = looked_up(monkeypatch)
    for i in range(4):
        land(spark, bronze, [trade("a", at(0)), trade(f"b{i}", at(i)), trade(f"late{i}", at(-60 * 24 * i))], f"f{i}")
    jobs.start_silver(files_as_stream(spark, bronze, BRONZE), out, ck).awaitTermination()
    assert seen == [set()] * 4
    assert spark.read.schema(SILVER).parquet(out).count() == 9
    # a new query over the layer remembers nothing: it counts on and looks all up
    jobs.start_silver(files_as_stream(spark, bronze, BRONZE), out, str(tmp_path / "other")).awaitTermination()
    assert seen[4:] == [{0, 1, 2, 3}] * 4
    assert spark.read.schema(SILVER_STORED).parquet(out).count() == 9


def test_loads_before_the_memory_are_looked_up(spark, tmp_path, monkeypatch):
    bronze, out, ck = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "ck")
    seen = looked_up(monkeypatch)
    for i in range(3):
        land(spark, bronze, [trade("a", at(0)), trade(f"b{i}", at(i))], f"f{i}")
        jobs.start_silver(files_as_stream(spark, bronze, BRONZE), out, ck, memory="1 second").awaitTermination()
    assert [len(x) for x in seen] == [0, 1, 2]
    assert sorted(r.event_id for r in spark.read.schema(SILVER).parquet(out).collect()) == ["a", "b0", "b1", "b2"]


def test_which_loads_the_state_remembers(spark, tmp_path):
    from barloom.streaming.loads import Loads

    loads = Loads(spark, str(tmp_path), "ck", 64_000)
    assert [loads.remembered(n, t) for n, t in ((0, 0), (1, 900), (2, 1000), (3, 30_000))] == [range(0, n) for n in range(4)]
    assert loads.remembered(4, 64_500) == range(2, 4)  # loads 0 and 1 may be forgotten
    assert loads.remembered(3, 64_600) == range(2, 3)  # a replay
    assert loads.remembered(5, 200_000) == range(5, 5)
    assert Loads(spark, str(tmp_path), "ck/", 64_000).number(7) == 7
