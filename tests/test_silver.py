import pytest
from pyspark.sql import functions as F

from barloom.operators.bronze import between_dates, to_bronze
from barloom.operators.silver import (
    clean,
    dedupe,
    first_per_key,
    quality_counters,
    split_future,
    to_silver,
)
from barloom.schemas import BRONZE, SILVER, TRADE

NAN = float("nan")


def trade(event_id, price=1.0, volume=1.0, ms=0, seen=0, symbol="AAPL"):
    return (event_id, symbol, price, volume, ms, seen, ["1"])


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), TRADE)


def test_quality_filter(spark):
    values = [1.0, 0.0, -1.0, NAN, None, float("inf")]
    rows = [trade(f"p{i}", price=v) for i, v in enumerate(values)]
    rows += [trade(f"v{i}", volume=v) for i, v in enumerate(values)]
    kept = sorted(r.event_id for r in clean(trades(spark, *rows)).collect())
    assert kept == ["p0", "p5", "v0", "v5"]


def test_counters(spark):
    rows = [trade("a"), trade("a"), trade("b", price=-1.0), trade("c"), trade(None), trade(None)]
    row = quality_counters(trades(spark, *rows)).collect()[0]
    assert (row.n_read, row.n_valid, row.n_kept, row.n_dropped) == (6, 5, 3, 3)
    empty = quality_counters(trades(spark, trade("a")).filter("false")).collect()[0]
    assert tuple(empty) == (0, 0, 0, 0)


def test_first_arrival_wins(spark):
    rows = [trade("a", 2.0, seen=2), trade("a", 1.0, seen=1), trade("b", 3.0), trade(None, 4.0), trade(None, 5.0)]
    silver = to_silver(to_bronze(trades(spark, *rows)))
    assert sorted((r.event_id or "", r.price) for r in silver.collect()) == [
        ("", 4.0),
        ("a", 1.0),
        ("b", 3.0),
    ]
    assert to_silver(to_bronze(trades(spark, *rows)), "none").count() == 5
    with pytest.raises(ValueError, match="scope"):
        dedupe(trades(spark, *rows), "weekly")


def test_dedupe_combines_before_the_shuffle(spark):
    plan = first_per_key(trades(spark, trade("a")), ["event_id"], ["ingestion_timestamp"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text
    assert "Window" not in text


def test_first_per_key_without_other_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert first_per_key(df, ["k"], []).count() == 2


def test_schema_is_enforced(spark):
    bronze = to_bronze(trades(spark, trade("a", symbol="BINANCE:BTCUSDT"))).withColumn(
        "__index_level_0__", F.lit(1)
    )
    silver = to_silver(bronze)
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    assert silver.collect()[0].asset_class == "Crypto"


def test_date_parts_are_padded_utc_text(new_york):
    rows = to_bronze(
        trades(new_york, trade("a", ms=0), trade("b", ms=-1), trade("c", ms=1704067199999))
    ).collect()
    assert [(r.year, r.month, r.day) for r in rows] == [
        ("1970", "01", "01"),
        ("1969", "12", "31"),
        ("2023", "12", "31"),
    ]


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day = 1709251200000  # 2024-03-01
    rows = trades(spark, trade("a", ms=day), trade("b", ms=day + 9 * 86_400_000))
    to_bronze(rows).write.partitionBy("year", "month", "day").parquet(path)
    back = spark.read.schema(BRONZE).parquet(path)
    assert sorted((r.month, r.day) for r in back.collect()) == [("03", "01"), ("03", "10")]
    few = between_dates(back, "2024-03-02", "2024-12-31")
    assert [r.event_id for r in few.collect()] == ["b"]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_future_ticks_are_set_aside(spark):
    rows = [trade("a", ms=100, seen=50), trade("b", ms=61, seen=50), trade("c", ms=1, seen=50)]
    kept, ahead = split_future(trades(spark, *rows), 10)
    assert sorted(r.event_id for r in kept.collect()) == ["c"]
    assert sorted(r.event_id for r in ahead.collect()) == ["a", "b"]
