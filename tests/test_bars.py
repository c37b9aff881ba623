from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators.lookup import high_watermark, watchlist_frame
from barloom.operators.merge import LIVE
from barloom.plans.daily import load_daily, read_backup
from barloom.plans.heal import heal_increment, heal_minutes
from barloom.schemas import OHLCV_1M, OHLCV_DAILY
from barloom.sources.mart import Mart

DDL = "symbol string, Date timestamp_ntz, Open double, High double, Low double, Close double, Volume double"
NOW = datetime(2024, 1, 28, 15, 0)


def vendor(spark, *rows, time_col="Date"):
    full = [(s, t, c, c, c, c, 1.0) for s, t, c in rows]
    return spark.createDataFrame(full, DDL.replace("Date", time_col))


def day(n):
    return datetime(2024, 1, n)


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["('Close', 'AAPL')", "DateTime"])
    assert B.plain_names(df).columns == ["close", "datetime"]


def test_time_column(spark):
    for name in ("Datetime", "Date"):
        bars = B.normalise_bars(vendor(spark, ("A", day(1), 1.0), time_col=name))
        assert bars.collect()[0].window_start == day(1)
    both = vendor(spark, ("A", day(1), 1.0)).withColumn("datetime", F.lit(day(2)).cast("timestamp_ntz"))
    assert B.normalise_bars(both).collect()[0].window_start == day(2)
    with pytest.raises(ValueError, match="no datetime or date"):
        B.normalise_bars(vendor(spark, ("A", day(1), 1.0), time_col="When"))


def test_vendor_time_with_zone_becomes_utc(new_york):
    bars = new_york.sql(
        "SELECT 'A' AS symbol, timestamp'2024-01-02 09:30:00 America/New_York' AS datetime, "
        "1D AS open, 1D AS high, 1D AS low, 1D AS close, 1D AS volume"
    )
    assert B.normalise_bars(bars).collect()[0].window_start == datetime(2024, 1, 2, 14, 30)


def test_symbol_map(spark):
    names = ["AAPL", "BINANCE:BTCUSDT", "BINANCE:ETHBTC", "BINANCE:USDT", "XBINANCE:BTCUSDT"]
    got = {r.symbol: (r.vendor_symbol, r.asset_class) for r in B.map_symbols(watchlist_frame(spark, names)).collect()}
    assert got == {
        "AAPL": ("AAPL", "Stock"),
        "BINANCE:BTCUSDT": ("BTC-USD", "Crypto"),
        "BINANCE:ETHBTC": ("BINANCE:ETHBTC", "Crypto"),
        "BINANCE:USDT": ("-USD", "Crypto"),
        "XBINANCE:BTCUSDT": ("XBINANCE:BTCUSDT", "Crypto"),
    }


def test_small_watchlist_is_broadcast(spark):
    bars = B.normalise_bars(vendor(spark, ("A", day(1), 1.0)))
    joined = B.with_original_symbol(bars, B.map_symbols(watchlist_frame(spark, ["A"])))
    joined.collect()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_two_names_for_one_vendor_symbol(spark):
    bars = B.normalise_bars(vendor(spark, ("BTC-USD", day(1), 1.0)))
    symbols = B.map_symbols(watchlist_frame(spark, ["BTC-USD", "BINANCE:BTCUSDT"]))
    got = B.with_original_symbol(bars, symbols).collect()
    assert sorted(r.symbol for r in got) == ["BINANCE:BTCUSDT", "BTC-USD"]


def test_missing_close_and_other_columns(spark):
    rows = [("A", day(1), None, 1.0), ("A", day(2), 1.0, float("nan")), ("A", day(3), None, 2.0)]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz, open double, close double")
    for c in ("high", "low", "volume"):
        df = df.withColumn(c, F.lit(1.0))
    got = sorted((r.window_start.day, str(r.open)) for r in B.drop_unclosed(df).collect())
    assert got == [(1, "nan"), (3, "nan")]


def test_high_watermark(spark):
    stored = spark.createDataFrame([("A", day(1)), ("A", day(2)), ("C", day(9))], "symbol string, window_start timestamp_ntz")
    got = high_watermark(stored, watchlist_frame(spark, ["A", "B", "B"])).collect()
    assert sorted((r.symbol, r.last_window) for r in got) == [("A", day(2)), ("B", None)]


def test_daily_load(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "daily"), OHLCV_DAILY, "month")
    watchlist = watchlist_frame(spark, ["A", "BINANCE:BTCUSDT"])
    backup = str(tmp_path / "backup")
    old = datetime(2020, 12, 31)
    first = vendor(spark, ("A", old, 1.0), ("A", day(1), 1.0), ("A", day(2), 2.0), ("BTC-USD", day(2), 3.0), ("Z", day(2), 1.0))
    load_daily(first, mart, watchlist, NOW, backup)
    got = sorted((r.symbol, r.window_start, r.close) for r in mart.read().collect())
    assert got == [("A", day(1), 1.0), ("A", day(2), 2.0), ("BINANCE:BTCUSDT", day(2), 3.0)]
    second = vendor(spark, ("A", day(1), 9.0), ("A", day(2), 9.0), ("A", day(3), 4.0), ("A", day(4), None))
    load_daily(second, mart, watchlist, NOW, backup)
    got = sorted((r.symbol, r.window_start, r.close) for r in mart.read().filter("symbol = 'A'").collect())
    assert got == [("A", day(1), 1.0), ("A", day(2), 9.0), ("A", day(3), 4.0)]
    kept = sorted((r.series, r.year, r.month, r.day, r.close) for r in read_backup(spark, backup).collect())
    assert kept == [
        ("A", "2024", "01", "28", 4.0),
        ("A", "2024", "01", "28", 9.0),
        ("BINANCE_BTCUSDT", "2024", "01", "28", 3.0),
    ]
    load_daily(second.filter("false"), mart, watchlist, NOW, backup)
    assert mart.read().count() == 4


def minute(d, h, m):
    return datetime(2024, 1, d, h, m)


def stored_bars(spark, *moments):
    rows = [("A", "Stock", t, 1.0, 1.0, 1.0, 1.0, 1.0, 1.5, 7) for t in moments]
    ddl = "symbol string, asset_class string, window_start timestamp_ntz, open double, high double, low double, close double, volume double, vwap double, tick_count bigint"
    return spark.createDataFrame(rows, ddl)


def test_heal_tail(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "m"), OHLCV_1M)
    mart.merge(stored_bars(spark, minute(27, 10, 0), minute(27, 10, 5)), LIVE)
    bars = vendor(
        spark,
        ("A", minute(27, 10, 2), 2.0),
        ("A", minute(27, 10, 5), 2.0),
        ("A", minute(27, 10, 6), 3.0),
        ("A", minute(27, 10, 7), None),
        ("BTC-USD", minute(21, 23, 59), 4.0),
        ("BTC-USD", minute(22, 0, 0), 4.0),
        time_col="Datetime",
    )
    watchlist = watchlist_frame(spark, ["A", "BINANCE:BTCUSDT"])
    heal_minutes(bars, mart, watchlist, NOW)
    got = {(r.symbol, r.window_start): (r.close, r.vwap, r.tick_count, r.asset_class) for r in mart.read().collect()}
    assert got == {
        ("A", minute(27, 10, 0)): (1.0, 1.5, 7, "Stock"),
        ("A", minute(27, 10, 5)): (1.0, 1.5, 7, "Stock"),
        ("A", minute(27, 10, 6)): (3.0, None, 1, "Stock"),
        ("BINANCE:BTCUSDT", minute(22, 0, 0)): (4.0, None, 1, "Crypto"),
    }
    heal_minutes(bars, mart, watchlist, NOW, mode="gaps")
    closes = {r.window_start: r.close for r in mart.read().filter("symbol = 'A'").collect()}
    assert closes[minute(27, 10, 2)] == 2.0
    with pytest.raises(ValueError, match="mode"):
        heal_increment(bars, mart.read(), watchlist, NOW, mode="all")


@pytest.mark.parametrize("last", [minute(22, 10, 0), minute(21, 10, 0)])
def test_old_last_bar_equals_full_read(spark, tmp_path, last):
    """The healer reads only recent periods; the whole table would say the same."""
    mart = Mart(spark, str(tmp_path / "m"), OHLCV_1M)
    mart.merge(stored_bars(spark, last), LIVE)
    moments = [last + timedelta(minutes=m) for m in range(-2, 3)]
    bars = vendor(spark, *(("A", t, 2.0) for t in moments), time_col="Datetime")
    watchlist = watchlist_frame(spark, ["A"])
    recent = mart.read(since=B.lookback_start(B.as_moment(NOW)))
    pruned = heal_increment(bars, recent, watchlist, NOW)
    whole = heal_increment(bars, mart.read(), watchlist, NOW)
    assert sorted(pruned.collect()) == sorted(whole.collect())
