"""The registered queries. Each reads a whole table and names every column."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.times import ms_to_utc
from barloom.operators import bars as B
from barloom.operators import frames as FR
from barloom.operators.bronze import partition_counts, to_bronze
from barloom.operators.candles import candles, distinct_symbols
from barloom.operators.lookup import high_watermark, watchlist_frame
from barloom.operators.merge import DAILY, GROWING, HEAL, HEAL_MISSING, LIVE, merge_upsert
from barloom.operators.silver import (
    clean,
    first_per_key,
    quality_counters,
    split_future,
    to_silver,
)
from barloom.plans import ticks as T
from barloom.plans.daily import daily_increment, load_daily, read_backup
from barloom.plans.heal import heal_increment, heal_minutes
from barloom.plans.monitor import flow_rate, gaps, latency, pulse
from barloom.plans.pipeline import backfill, minute_mart
from barloom.plans.replay import as_of, register_views, replay
from barloom.schemas import BRONZE, DATE_PARTS, OHLCV_1M, OHLCV_DAILY, SILVER, SILVER_PARTITIONS, TRADE
from barloom.session import scratch_dir, stored
from barloom.sources.connectors import read_frames, read_silver
from barloom.sources.layers import Layer, unreadable_files
from barloom.sources.mart import Mart
from barloom.sources.paths import create_text
from barloom.streaming import jobs
from barloom.streaming.metrics import RowCounters, totals_of
from barloom.streaming.pulse import start_flow, start_pulse
from barloom.streaming.repair import start_repair

Query = Callable[[SparkSession, str], DataFrame]

# Decimals kept of compared averages.
DECIMALS = 4

# The moments and symbols the queries are asked about.
NOW = datetime(2024, 1, 31)
HEAL_NOW = datetime(2024, 1, 28, 12)
# 2024-01-10 00:30 and 2024-01-20 00:30 in epoch milliseconds.
CUTS = (1_704_846_600_000, 1_705_710_600_000)
LOADED_UNTIL = "2024-01-25 09:30:00"
DAYS_LOADED = "2024-01-20"
WATCHED = ["AAPL", "MSFT", "GOOGL", "BINANCE:BTCUSDT", "BINANCE:ETHUSDT"]

BAR_COLUMNS = ("symbol", "window_start", *B.OHLCV)


def _watchlist(spark: SparkSession, symbols: list[str] = WATCHED) -> DataFrame:
    return watchlist_frame(spark, symbols)


def _comparable(bars: DataFrame) -> DataFrame:
    """``vwap`` to four places. Engines add doubles in their own order, so a value
    half way between two results is always taken up, never left to the last bit."""
    return bars.withColumn("vwap", F.floor(F.col("vwap") * 10_000 + 0.505) / 10_000)


def _bars(spark: SparkSession, sf_dir: str, width: str) -> DataFrame:
    return _comparable(candles(clean(T.timed(T.trades(spark, sf_dir))), width))


def _vendor_bars(bars: DataFrame, time_col: str) -> DataFrame:
    """Candles as the bar vendor would deliver them: own symbols, mixed-case names,
    and no close on every eleventh day of the year or minute of the hour."""
    part = F.dayofyear if time_col == "Date" else F.minute
    hole = part("window_start") % 11 == 0
    return bars.select(
        B.vendor_symbol(F.col("symbol")).alias("Symbol"),
        F.col("window_start").alias(time_col),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.when(~hole, F.col("close")).alias("Close"),
        F.col("volume").alias("Volume"),
    )


def _with_a_bad_bar(bars: DataFrame, time_col: str) -> DataFrame:
    """The bars with numbers as text, and for each symbol one more that has none."""
    texts = bars.withColumn("Open", F.col("Open").cast("string"))
    bad = texts.groupBy("Symbol").agg(F.max(time_col).alias(time_col))
    bad = bad.select("Symbol", time_col, F.lit("n/a").alias("Open"), *(F.lit(1.0).alias(c) for c in ("High", "Low", "Close", "Volume")))
    return texts.unionByName(bad)


def _until(bars: DataFrame, moment: str) -> DataFrame:
    return bars.filter(F.col("window_start") <= F.lit(moment).cast("timestamp_ntz"))


# -- candles -----------------------------------------------------------------


def candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir, "1 minute")


def candles_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir, "1 hour")


def candles_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir, "1 day")


def candles_high_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of prices up to 5e11, ten minutes of ticks at one moment each."""
    n = F.col("event_id").cast("bigint") % 4
    factor = F.when(n == 0, 1).when(n == 1, 1000).when(n == 2, 1_000_000).otherwise(1_000_000_000)
    ms = F.col("source_timestamp")
    ticks = clean(T.trades(spark, sf_dir)).withColumns({"price": F.col("price") * factor, "source_timestamp": ms - F.pmod(ms, F.lit(600_000))})
    bars = candles(T.timed(ticks), "1 hour", ts="source_timestamp", decimals=2)
    return bars.drop("vwap")


def distinct_symbols_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_symbols(_bars(spark, sf_dir, "1 hour"))


# -- raw and clean layers ------------------------------------------------------


def frame_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = FR.parse_trades(T.frames_from(T.events(spark, sf_dir)), "payload")
    return good.select(
        "symbol",
        "price",
        "volume",
        "source_timestamp",
        F.array_join("trade_conditions", ",").alias("conditions"),
    )


def malformed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = FR.parse_trades(T.frames_from(T.events(spark, sf_dir)), "payload")
    subject = F.when(F.col("reject_reason") != "bad_element", F.coalesce("symbol", "raw"))
    return bad.select("reject_reason", subject.alias("subject"))


def topic_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = FR.encode_trades(T.trades(spark, sf_dir))
    body = F.col("value").cast("string")
    return records.select(
        F.decode("key", "UTF-8").alias("topic_key"),
        F.get_json_object(body, "$.event_id").alias("event_id"),
        F.get_json_object(body, "$.symbol").alias("symbol"),
        F.get_json_object(body, "$.price").cast("double").alias("price"),
        F.get_json_object(body, "$.volume").cast("double").alias("volume"),
        F.get_json_object(body, "$.source_timestamp").cast("bigint").alias("source_timestamp"),
    )


def topic_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records read back; every thirteenth is cut short and every seventeenth
    is no UTF-8 any more."""
    trades = T.trades(spark, sf_dir)
    n = F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint")
    spoiled = (
        F.when(n % 17 == 0, F.concat("value", F.unhex(F.lit("FF"))))
        .when(n % 13 == 0, F.substring("value", 1, 20))
        .otherwise(F.col("value"))
    )
    records = FR.encode_trades(trades).select("key", spoiled.alias("value"))
    return FR.mark_records(records).select(
        F.coalesce("reject_reason", F.lit("ok")).alias("outcome"),
        F.when(F.col("reject_reason").isNull(), F.col("event_id")).alias("event_id"),
        F.when(F.col("reject_reason").isNull(), F.col("price")).alias("price"),
        F.when(F.col("reject_reason").isNull(), F.col("ingestion_timestamp")).alias(
            "ingestion_timestamp"
        ),
    )


def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition_counts(to_bronze(T.trades(spark, sf_dir)))


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer written to its date directories and read back."""
    path = scratch_dir(spark, "bronze")
    jobs.write_bronze(T.trades(spark, sf_dir), path)
    return spark.read.schema(BRONZE).parquet(path).select(
        "event_id", "symbol", "price", "source_timestamp", *DATE_PARTS
    )


def compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer in many small files, its days before the last two compacted; then more
    files come, and the days are compacted again."""
    path = scratch_dir(spark, "bronze")
    ticks = T.trades(spark, sf_dir)
    third = F.col("event_id").cast("bigint") % 3
    layer = Layer(spark, path, BRONZE)
    for i, before in enumerate((None, "2024-01-30", "2024-01-20")):
        jobs.write_bronze(ticks.filter(third == i), path)
        if before:
            layer.compact(before)
    return layer.read().select("event_id", "symbol", "price", "source_timestamp", *DATE_PARTS)


def corrupt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader takes of the raw layer when each day has one spoiled file, and what it
    passes over."""
    path = scratch_dir(spark, "bronze")
    jobs.write_bronze(T.trades(spark, sf_dir), path)
    days = spark.read.schema(BRONZE).parquet(path).select(*DATE_PARTS).distinct().collect()
    for day in days:
        folder = "/".join(f"{p}={day[p]}" for p in DATE_PARTS)
        create_text(spark, f"{path}/{folder}/spoiled.parquet", ("text", "PAR1 and PAR1", "PAR1 cut")[int(day["day"]) % 3])
    read = spark.read.schema(BRONZE).option("ignoreCorruptFiles", "true").parquet(path)
    lost = unreadable_files(spark, path).groupBy(F.col("reason").alias("outcome"))
    return read.select(F.lit("read").alias("outcome"), F.lit(0).alias("_")).groupBy("outcome").agg(
        F.count("*").alias("n"), F.lit(0).cast("bigint").alias("bytes")
    ).unionByName(lost.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")))


def watchlist_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = FR.only_watched(T.trades(spark, sf_dir), _watchlist(spark))
    return kept.select("event_id", "symbol", "price", "volume")


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = to_silver(to_bronze(T.trades(spark, sf_dir)), dedup="none")
    return silver.drop("trade_time").withColumn(
        "trade_time", ms_to_utc(F.col("source_timestamp"))
    )


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = clean(T.with_copies(T.trades(spark, sf_dir)).drop("trade_conditions"))
    return first_per_key(ticks, ["event_id"], ["ingestion_timestamp"])


def silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layer written to its partitions and read back."""
    path = scratch_dir(spark, "silver")
    jobs.write_silver(to_silver(to_bronze(T.with_copies(T.trades(spark, sf_dir)))), path)
    return spark.read.schema(SILVER).parquet(path).select(
        "event_id", "symbol", "price", "volume", *SILVER_PARTITIONS
    )


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_counters(T.with_copies(T.trades(spark, sf_dir)))


def future_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth tick claims a trade time a day ahead of its arrival."""
    ticks = T.trades(spark, sf_dir).withColumn(
        "source_timestamp",
        F.col("source_timestamp")
        + F.when(F.col("event_id").cast("bigint") % 9 == 0, 86_400_000).otherwise(0),
    )
    kept, ahead = split_future(ticks, 5_000)
    return kept.select("event_id", F.lit("kept").alias("outcome")).unionByName(
        ahead.select("event_id", F.lit("ahead").alias("outcome"))
    )


def silver_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layer after three runs of its stream, each over the whole time, with redeliveries."""
    root = scratch_dir(spark, "late")
    ticks = to_bronze(T.trades(spark, sf_dir))
    n = F.col("event_id").cast("bigint")
    again = n % 10 == 0
    for i, part in enumerate((n % 3 == 0, (n % 3 == 2) | (again & (n % 3 == 0)), (n % 3 == 1) | again)):
        ticks.filter(part).write.parquet(f"{root}/in/{i}")
        source = spark.readStream.schema(BRONZE).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        jobs.start_silver(source, f"{root}/silver", f"{root}/ck").awaitTermination()
    layer = spark.read.schema(SILVER).parquet(f"{root}/silver")
    return layer.select("event_id", "symbol", "price", "volume", "source_timestamp", *SILVER_PARTITIONS)


def asof_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles as they stood after the second of three loads into the clean layer."""
    path = scratch_dir(spark, "loads")
    bronze = to_bronze(T.trades(spark, sf_dir))
    for load, (first, last) in enumerate((("01", "10"), ("11", "20"), ("21", "31")), 1):
        jobs.append_silver(bronze.filter(F.col("day").between(first, last)), path, load)
    return _comparable(candles(as_of(read_silver(spark, path), 2), "1 hour"))


# -- keyed tables --------------------------------------------------------------


def high_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_watermark(candles_1m(spark, sf_dir), _watchlist(spark))


def symbol_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = T.trades(spark, sf_dir).select("symbol").distinct()
    return B.map_symbols(symbols).withColumn("series", B.path_safe(F.col("symbol")))


def merge_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored candles of the first half, upserted with doubled ones of the rest.

    The stored asset class is marked, to show that an update leaves it alone.
    """
    bars = stored(_bars(spark, sf_dir, "1 hour"), "candles")
    before = _until(bars, "2024-01-16 00:00:00").withColumn("asset_class", F.lit("Stored"))
    fresh = bars.filter(
        F.col("window_start") >= F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    ).withColumns({"volume": F.col("volume") * 2, "tick_count": F.col("tick_count") * 2})
    return merge_upsert(before, fresh, LIVE, unique=True)


def merge_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = stored(_bars(spark, sf_dir, "1 day"), "candles")
    before = _until(days, DAYS_LOADED).select(
        "symbol", "window_start", *(F.lit(0.0).alias(c) for c in B.OHLCV)
    )
    fresh = daily_increment(_vendor_bars(days, "Date"), before, _watchlist(spark), NOW)
    return merge_upsert(before, fresh, DAILY)


def merge_heal(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = stored(candles_1m(spark, sf_dir), "candles")
    before = _until(minutes, LOADED_UNTIL)
    fresh = heal_increment(_vendor_bars(minutes, "Datetime"), before, _watchlist(spark), HEAL_NOW)
    return merge_upsert(before, fresh, HEAL)


def heal_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holes inside the stored bars, patched: every seventh minute is missing."""
    minutes = stored(candles_1m(spark, sf_dir), "candles")
    before = minutes.filter(F.minute("window_start") % 7 != 0)
    return heal_increment(
        _vendor_bars(minutes, "Datetime"), before, _watchlist(spark), HEAL_NOW, mode="gaps"
    )


def raw_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = B.normalise_bars(_vendor_bars(_bars(spark, sf_dir, "1 day"), "Date"))
    return B.raw_backup(B.drop_unclosed(bars), NOW).withColumn(
        "window_start", B.stamp(F.col("window_start"))
    )


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job on a stored table: first load, then an increment."""
    days = stored(_bars(spark, sf_dir, "1 day"), "candles")
    path = scratch_dir(spark, "daily")
    mart = Mart(spark, f"{path}/ohlcv_daily", OHLCV_DAILY, grain="month")
    watchlist = _watchlist(spark)
    load_daily(_vendor_bars(_until(days, DAYS_LOADED), "Date"), mart, watchlist, NOW)
    later = _with_a_bad_bar(_vendor_bars(days, "Date"), "Date")
    load_daily(later, mart, watchlist, NOW, f"{path}/backup", f"{path}/rejects")
    kept = read_backup(spark, f"{path}/backup").select(
        "symbol", "window_start", F.lit(True).alias("backed_up")
    )
    return (
        mart.read()
        .select(*BAR_COLUMNS)
        .join(kept, ["symbol", "window_start"], "left")
        .withColumn("backed_up", F.coalesce("backed_up", F.lit(False)))
    )


def heal_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The healer on a stored table."""
    minutes = stored(candles_1m(spark, sf_dir), "candles")
    mart = Mart(spark, scratch_dir(spark, "minutes"), OHLCV_1M, grain="day")
    mart.merge(_until(minutes, LOADED_UNTIL), LIVE, now=NOW)
    bars = _with_a_bad_bar(_vendor_bars(minutes, "Datetime"), "Datetime")
    heal_minutes(bars, mart, _watchlist(spark), HEAL_NOW, rejects=scratch_dir(spark, "rejects"))
    return mart.read().drop("created_at")


def mart_adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-form SQL over the stored candles, through views that outlive a merge."""
    mart = Mart(spark, scratch_dir(spark, "adhoc"), OHLCV_1M, grain="day")
    bars = stored(candles_1m(spark, sf_dir), "candles")
    mart.merge(_until(bars, LOADED_UNTIL), LIVE, now=NOW)
    register_views(mart)
    mart.merge(bars, LIVE, now=NOW)
    return spark.sql(
        """
        SELECT symbol, CAST(window_start AS DATE) AS trade_day,
               max(high) AS day_high, min(low) AS day_low, sum(tick_count) AS ticks
        FROM ohlcv_1m
        WHERE asset_class = 'Crypto' AND window_start >= TIMESTAMP_NTZ '2024-01-10 00:00:00'
        GROUP BY symbol, CAST(window_start AS DATE)
        """
    )


# -- monitoring ----------------------------------------------------------------


def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick arrives with a delay of its own."""
    delay = F.pmod(F.col("event_id").cast("bigint") * 7919, F.lit(10_007))
    ticks = T.trades(spark, sf_dir).withColumn("ingestion_timestamp", F.col("source_timestamp") + delay)
    return latency(ticks).withColumn("avg_ms", F.round("avg_ms", DECIMALS))


def flow_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_rate(T.timed(T.trades(spark, sf_dir)), "1 hour")


def pulse_no_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pulse(T.timed(T.trades(spark, sf_dir)), _watchlist(spark), NOW, 4 * 3600)


def live_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms of the live pulse over three runs of the stream, the last of them a restart."""
    root = scratch_dir(spark, "pulse")
    ticks = T.trades(spark, sf_dir)
    cuts = [F.lit(0), *(F.lit(ms) for ms in CUTS), F.lit(2**62)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        ticks.filter(F.col("source_timestamp").between(a, b - 1)).write.parquet(f"{root}/in/{i}")
        source = spark.readStream.schema(TRADE).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        start_pulse(source, WATCHED, f"{root}/out", f"{root}/ck", silence="30 minutes").awaitTermination()
    return spark.read.schema("symbol STRING, status STRING, since TIMESTAMP_NTZ, at TIMESTAMP_NTZ").parquet(f"{root}/out")


def live_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow rates of the hours that are over, from three runs of the stream."""
    root = scratch_dir(spark, "flow")
    ticks = T.timed(T.trades(spark, sf_dir))
    cuts = [F.lit(0), *(F.lit(ms) for ms in CUTS), F.lit(2**62)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        ticks.filter(F.col("source_timestamp").between(a, b - 1)).write.parquet(f"{root}/in/{i}")
        source = spark.readStream.schema(ticks.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        start_flow(source, f"{root}/out", f"{root}/ck", width="1 hour").awaitTermination()
    return spark.read.schema(flow_rate(ticks).schema).parquet(f"{root}/out")


def gap_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps(candles_1m(spark, sf_dir))


# -- whole pipeline ------------------------------------------------------------


def replay_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles rebuilt from the stored raw layer for a range of days."""
    path = scratch_dir(spark, "bronze")
    jobs.write_bronze(T.with_copies(T.trades(spark, sf_dir)), path)
    bronze = spark.read.schema(BRONZE).parquet(path)
    return _comparable(replay(bronze, "2024-01-05", "2024-01-24"))


def stream_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of a stream in four runs: two cuts go through an hour, whose candles
    are written again, and the last part holds ticks that come too late."""
    root = scratch_dir(spark, "stream")
    ticks = T.trades(spark, sf_dir)
    cuts = [F.lit(0), *(F.lit(ms) for ms in CUTS), F.lit(2**62)]
    parts = [ticks.filter(F.col("source_timestamp").between(a, b - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]
    late = ticks.filter(F.col("source_timestamp") < CUTS[0] - 86_400_000).withColumn("price", F.lit(1e6))
    mart = Mart(spark, f"{root}/ohlcv_1h", OHLCV_1M, grain="day")
    for i, part in enumerate([*parts, late]):
        to_silver(to_bronze(part), "none").write.parquet(f"{root}/in/{i}")
        source = spark.readStream.schema(SILVER).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        jobs.start_gold(source, mart, f"{root}/ck", width="1 hour").awaitTermination()
    return _comparable(mart.read().drop("created_at"))


def late_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of a stream in two runs, each over the whole time: in the second, nearly
    every tick comes behind the watermark."""
    root = scratch_dir(spark, "late")
    ticks = to_bronze(T.trades(spark, sf_dir))
    part = F.col("event_id").cast("bigint") % 2
    mart = Mart(spark, f"{root}/ohlcv_1h", OHLCV_1M, grain="month")
    for i in range(2):
        jobs.append_silver(ticks.filter(part == i), f"{root}/silver", i)
        how = {"width": "1 hour", "skew_ms": None}
        jobs.start_gold(jobs.stream_silver(spark, f"{root}/silver"), mart, f"{root}/ck", rule=GROWING, **how).awaitTermination()
        layer = jobs.stream_silver(spark, f"{root}/silver")
        start_repair(layer, f"{root}/silver", mart, f"{root}/late", f"{root}/ck_late", **how).awaitTermination()
    return _comparable(mart.read().drop("created_at"))


def merge_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Healed bars every fifth minute first, then live candles of every second minute, then a
    heal of all: a live candle replaces a healed bar, a heal only what is missing or healed."""
    minutes = stored(candles_1m(spark, sf_dir), "candles")
    n = F.minute("window_start")
    healed = minutes.drop("vwap", "tick_count")
    shifted = [healed.withColumns({c: F.col(c) + by for c in B.OHLCV}) for by in (100, 200)]
    before = minutes.filter("false")
    first = merge_upsert(before, shifted[0].filter(n % 5 == 0), HEAL_MISSING, unique=True)
    second = merge_upsert(first, minutes.filter(n % 2 == 0), GROWING, unique=True)
    return merge_upsert(second, shifted[1], HEAL_MISSING, unique=True)


def _live(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """Frames as text files through the live hops up to the clean layer, each run until it has
    what is there: their folder, and the rows that each hop counted."""
    root = scratch_dir(spark, "live")
    T.frames_from(T.events(spark, sf_dir)).select("value").write.text(f"{root}/frames")
    frames = read_frames(spark, "text", f"{root}/frames")
    counters = RowCounters()
    queries = [
        jobs.start_bronze(frames, f"{root}/bronze", f"{root}/ck/bronze"),
        jobs.start_quarantine(frames, f"{root}/rejects", f"{root}/ck/rejects"),
    ]
    for query in queries:
        query.awaitTermination()
    queries.append(jobs.start_silver(jobs.stream_bronze(spark, f"{root}/bronze"), f"{root}/silver", f"{root}/ck/silver"))
    queries[-1].awaitTermination()
    return root, totals_of(*queries) | {"silver_kept": counters.totals["silver_kept"]}


def live_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of the live hops. Lines of a text file have no place: each counts."""
    root = _live(spark, sf_dir)[0]
    mart = Mart(spark, f"{root}/ohlcv_1m", OHLCV_1M, grain="month")
    mart.ensure()
    jobs.start_gold(jobs.stream_silver(spark, f"{root}/silver"), mart, f"{root}/ck/gold").awaitTermination()
    return _comparable(mart.read().drop("created_at"))


def live_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the live hops counted while rows passed by."""
    totals = _live(spark, sf_dir)[1]
    return spark.createDataFrame([(name, int(n)) for name, n in totals.items()], "counter STRING, n BIGINT")


def medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames to bronze to silver to candles, as a backfill."""
    root = scratch_dir(spark, "medallion")
    mart = minute_mart(spark, root, "day")
    backfill(T.frames_from(T.events(spark, sf_dir)), root, mart)
    return _comparable(mart.read().drop("created_at"))


def medallion_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the backfill refuses, by reason."""
    root = scratch_dir(spark, "medallion")
    backfill(T.frames_from(T.events(spark, sf_dir)), root, minute_mart(spark, root, "day"), watchlist=[])
    return spark.read.parquet(f"{root}/rejects").groupBy("reject_reason").agg(F.count("*").alias("n"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        candles_1m,
        candles_1h,
        candles_1d,
        candles_high_price,
        distinct_symbols_per_window,
        frame_parse,
        malformed_quarantine,
        topic_encode,
        topic_decode,
        bronze_partitions,
        bronze_scan,
        compacted_bronze,
        corrupt_files,
        watchlist_semi,
        silver_clean,
        silver_dedup,
        silver_scan,
        quality_counts,
        future_ticks,
        silver_late,
        asof_load,
        high_watermarks,
        symbol_map,
        merge_candles,
        merge_daily,
        merge_heal,
        merge_precedence,
        heal_gaps,
        raw_backup,
        daily_load,
        heal_job,
        mart_adhoc,
        latency_stats,
        flow_rates,
        pulse_no_data,
        live_pulse,
        live_flow,
        gap_minutes,
        replay_day_range,
        stream_candles,
        late_repair,
        live_candles,
        live_counters,
        medallion,
        medallion_rejects,
    )
}
