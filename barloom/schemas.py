"""Explicit schemas for every layer. Nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

# Frame numbers are text: the feed may quote them, and a number column in
# from_json would silently null a quoted value instead of letting us cast it.
FRAME_DDL = (
    "type STRING, "
    "data ARRAY<STRUCT<s: STRING, p: STRING, v: STRING, t: STRING, c: ARRAY<STRING>>>, "
    "_corrupt STRING"
)

TRADE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("source_timestamp", T.LongType()),
        T.StructField("ingestion_timestamp", T.LongType()),
        T.StructField("trade_conditions", T.ArrayType(T.StringType())),
    ]
)

# Partition values are text ("09", not 9), so they are declared, never inferred.
DATE_PARTS = ("year", "month", "day")
_DATE_FIELDS = [T.StructField(p, T.StringType()) for p in DATE_PARTS]

BRONZE = T.StructType(TRADE.fields + _DATE_FIELDS)

SILVER = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("source_timestamp", T.LongType()),
        T.StructField("ingestion_timestamp", T.LongType()),
        *_DATE_FIELDS,
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("asset_class", T.StringType()),
    ]
)
SILVER_PARTITIONS = ("asset_class", *DATE_PARTS)
# As stored, with the number of the load that brought a row.
SILVER_STORED = T.StructType([*SILVER.fields, T.StructField("load_id", T.LongType())])

# Mart times carry no zone and are always UTC.
OHLCV_1M = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("asset_class", T.StringType(), False),
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("open", T.DoubleType(), False),
        T.StructField("high", T.DoubleType(), False),
        T.StructField("low", T.DoubleType(), False),
        T.StructField("close", T.DoubleType(), False),
        T.StructField("volume", T.DoubleType(), False),
        T.StructField("vwap", T.DoubleType(), True),
        T.StructField("tick_count", T.LongType(), False),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)

OHLCV_DAILY = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("window_start", T.TimestampNTZType(), False),
        T.StructField("open", T.DoubleType(), False),
        T.StructField("high", T.DoubleType(), False),
        T.StructField("low", T.DoubleType(), False),
        T.StructField("close", T.DoubleType(), False),
        T.StructField("volume", T.DoubleType(), False),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)

MART_KEYS = ("symbol", "window_start")
