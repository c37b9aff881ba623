import time

import pytest
from pyspark.sql import functions as F
from test_streams import at, bars_of, trade

from barloom.operators.candles import candles
from barloom.operators.merge import GROWING
from barloom.operators.silver import split_future, to_silver
from barloom.schemas import OHLCV_1M, SILVER_STORED, TRADE
from barloom.sources.mart import Mart
from barloom.streaming import jobs
from barloom.streaming.repair import _Newest, candles_anew, start_repair


def land(spark, path, rows, load):
    jobs.append_silver(jobs.to_bronze(spark.createDataFrame(rows, TRADE)), path, load)
    time.sleep(1.1)


def start(kind, spark, tmp_path, mart, **how):
    path = str(tmp_path / "silver")
    stream = jobs.stream_silver(spark, path, max_files=1)
    if kind == "gold":
        return jobs.start_gold(stream, mart, str(tmp_path / "ck"), rule=GROWING, **how)
    return start_repair(stream, path, mart, str(tmp_path / "late"), str(tmp_path / "ck_late"), **how)


LOADS = [
    [trade("a", at(0, 10), 5.0), trade("b", at(30), 6.0), trade("x", at(5), 1.0, symbol="MSFT")],
    [trade("c", at(31), 7.0), trade("d", at(0, 50), 9.0)],
    [trade("e", at(0, 5), 2.0), trade("f", at(50), 4.0), trade("g", at(5, 1), 3.0, symbol="MSFT"), trade("h", at(-60 * 24), 8.0)],
]


@pytest.mark.parametrize("order", [("gold", "repair"), ("repair", "gold")])
def test_late_ticks_end_in_their_candles(spark, tmp_path, order):
    """Whichever query runs ahead."""
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M, "day")
    for i, rows in enumerate(LOADS):
        land(spark, str(tmp_path / "silver"), rows, i)
    for kind in order:
        start(kind, spark, tmp_path, mart).awaitTermination()
    layer = spark.read.schema(SILVER_STORED).parquet(str(tmp_path / "silver"))
    assert bars_of(mart.read()) == bars_of(candles(layer))
    late = spark.read.parquet(str(tmp_path / "late"))
    assert sorted(r.event_id for r in late.collect()) == list("adeghx")  # a and x within their own load
    start("repair", spark, tmp_path, mart).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "late")).count() == 6


def test_a_failed_repair_is_done_again(spark, tmp_path):
    class Broken(Mart):
        def merge(self, *args, **kwargs):
            raise RuntimeError("no store")

    path = str(tmp_path / "silver")
    land(spark, path, LOADS[0], 0)
    land(spark, path, LOADS[1], 1)
    broken = Broken(spark, str(tmp_path / "mart"), OHLCV_1M)
    with pytest.raises(Exception, match="no store"):
        start("repair", spark, tmp_path, broken).awaitTermination()
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M)
    start("repair", spark, tmp_path, mart).awaitTermination()
    # MSFT at 10:05 was behind 10:30 within its own batch
    assert sorted((r.symbol, r.tick_count) for r in mart.read().collect()) == [("AAPL", 2), ("MSFT", 1)]
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "late")).collect()) == ["a", "d", "x"]


def test_only_the_days_of_the_late_windows_are_read(spark, tmp_path):
    path = str(tmp_path / "silver")
    for day in range(4):
        land(spark, path, [trade(f"{day}-{i}", at(60 * 24 * day, i), 1.0 + i) for i in range(3)], day)
    layer = spark.read.schema(SILVER_STORED).parquet(path)
    late = layer.filter("event_id = '2-1'")
    anew = candles_anew(late, path)
    assert [(r.tick_count, r.close) for r in anew.collect()] == [(3, 3.0)]
    assert "day=03" in str(anew.inputFiles()) and anew.filter(F.col("tick_count") > 3).count() == 0
    plan = anew._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Stock/2024/01/03" in plan
    wide = candles_anew(late, path, "1 week")
    assert wide.collect()[0].tick_count == 9  # 28 December to 3 January


def test_future_ticks_stay_out(spark, tmp_path):
    path = str(tmp_path / "silver")
    ahead = ("x", "AAPL", 9.0, 1.0, at(3000), at(0), [])
    land(spark, path, [trade("a", at(0)), ahead], 0)
    land(spark, path, [trade("b", at(1))], 1)
    mart = Mart(spark, str(tmp_path / "mart"), OHLCV_1M)
    start("repair", spark, tmp_path, mart).awaitTermination()
    assert spark.read.schema(SILVER_STORED).parquet(str(tmp_path / "late")).count() == 0 and mart.read().count() == 0
    layer = spark.read.schema(SILVER_STORED).parquet(path)
    assert split_future(layer, 300_000)[1].count() == 1 and to_silver(layer.withColumn("trade_conditions", F.array())).count() == 3


def test_the_newest_time_of_replayed_batches(spark, tmp_path):
    notes = _Newest(spark, str(tmp_path))
    assert [notes.upto(*x) for x in ((0, 50), (1, 40), (1, 40), (2, 90), (2, 90), (3, -5))] == [50, 50, 50, 90, 90, 90]
    assert _Newest(spark, str(tmp_path)).upto(4, 1) == 90
