"""Feed frames to trades, and trades to and from keyed topic records.

Everything here is a narrow projection: no shuffle, no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.times import MAX_MS, MIN_MS
from barloom.schemas import FRAME_DDL, TRADE

TRADE_COLUMNS = TRADE.fieldNames()


def _whole_number(text: Column) -> Column:
    """Text to BIGINT; a fraction is cut, as an integer conversion would."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def _plausible(ms: Column) -> Column:
    return F.coalesce(ms.between(MIN_MS, MAX_MS), F.lit(False))


def _event_id(kind: str, columns: list[str]) -> Column:
    if kind == "record" and "record" in columns:
        # The record's place in its source: equal records elsewhere are other trades.
        return F.concat_ws("-", F.md5("_record"), F.col("_pos").cast("string"))
    if kind in ("record", "uuid"):
        return F.expr("uuid()")
    if kind == "payload":
        # Stable under replay: the same element of the same frame keeps its id.
        return F.concat_ws("-", F.md5("_value"), F.col("_pos").cast("string"))
    raise ValueError(f"event_id must be 'record', 'uuid' or 'payload', not {kind!r}")


def mark_trades(frames: DataFrame, event_id: str = "record", now: Column | None = None) -> DataFrame:
    """One row per trade element, with ``reject_reason`` NULL when it is sound.

    ``frames`` has a ``value`` column (text or bytes). With a ``record`` column, the place
    of the record in its source (topic, partition and offset, or file and line), ids stay
    the same when it is delivered again; otherwise each element gets an id of its own.
    Heartbeats and other frame
    types vanish. A frame that is not JSON gives a single rejected row; a malformed
    element is rejected alone, without its neighbours. ``raw`` keeps the rejected
    element, or the whole frame where there is no element to show.
    """
    value = F.col("value").cast("string")
    decoded = frames.select(
        value.alias("_value"),
        *([F.col("record").cast("string").alias("_record")] if "record" in frames.columns else []),
        F.from_json(value, FRAME_DDL, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_f"),
    )
    element = decoded.schema["_f"].dataType["data"].dataType.elementType
    broken = F.col("_f").isNull() | F.col("_f._corrupt").isNotNull()
    # One misshapen element spoils the typed array of its whole frame. Such frames,
    # and only those, are read again with their elements as text.
    reread = F.when(broken, F.from_json("_value", "type STRING, data ARRAY<STRING>"))
    decoded = decoded.withColumn("_texts", reread)
    one_by_one = F.transform(
        "_texts.data", lambda x: F.when(x.startswith("{"), F.from_json(x, element))
    )
    # The type alone can be read where the data has another shape; other types vanish.
    kind = F.coalesce(F.col("_texts.type"), F.get_json_object("_value", "$.type"))
    other = F.coalesce(kind != "trade", F.lit(False))
    unreadable = F.when(broken, F.col("_texts.data").isNull() & ~other | kind.isNull()).otherwise(F.lit(False))
    elements = (
        F.when(unreadable, F.array(F.lit(None).cast(element)))
        .when(broken & other, F.lit(None))
        .when(broken, one_by_one)
        .when(F.col("_f.type") == "trade", F.col("_f.data"))
    )
    exploded = decoded.select(
        "_value",
        *(["_record"] if "record" in frames.columns else []),
        unreadable.alias("_unreadable"),
        F.posexplode(elements).alias("_pos", "_e"),
    )
    typed = exploded.withColumns(
        {
            "price": F.col("_e.p").try_cast("double"),
            "volume": F.col("_e.v").try_cast("double"),
            "source_timestamp": _whole_number(F.col("_e.t")),
        }
    )
    reason = (
        F.when(F.col("_unreadable"), "bad_json")
        .when(F.col("_e").isNull(), "bad_element")
        .when(F.col("_e.s").isNull(), "bad_symbol")
        .when(F.col("price").isNull(), "bad_price")
        .when(F.col("volume").isNull(), "bad_volume")
        .when(~_plausible(F.col("source_timestamp")), "bad_time")
    )
    whole_frame = F.col("_unreadable") | F.col("_e").isNull()
    return typed.withColumn("reject_reason", reason).select(
        _event_id(event_id, frames.columns).alias("event_id"),
        F.col("_e.s").alias("symbol"),
        "price",
        "volume",
        "source_timestamp",
        (F.unix_millis(F.current_timestamp()) if now is None else now).alias("ingestion_timestamp"),
        F.coalesce(F.col("_e.c"), F.array().cast("array<string>")).alias("trade_conditions"),
        "reject_reason",
        F.when(whole_frame, F.col("_value"))
        .when(F.col("reject_reason").isNotNull(), F.to_json("_e"))
        .alias("raw"),
    )


def accepted(marked: DataFrame) -> DataFrame:
    """The sound trades of :func:`mark_trades` or :func:`decode_trades`."""
    return marked.filter("reject_reason IS NULL").select(*TRADE_COLUMNS)


def quarantined(marked: DataFrame) -> DataFrame:
    """The rejected rows, with the reason and the raw text."""
    return marked.filter("reject_reason IS NOT NULL").select(
        "reject_reason", "raw", "symbol", "price", "volume", "source_timestamp"
    )


def parse_trades(
    frames: DataFrame, event_id: str = "record", now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Frames to ``(trades, quarantine)``."""
    marked = mark_trades(frames, event_id, now)
    return accepted(marked), quarantined(marked)


def encode_trades(trades: DataFrame) -> DataFrame:
    """Trades to topic records: the symbol bytes as key, JSON bytes as value.

    Keying by symbol keeps one symbol's trades in one topic partition, in order.
    """
    body = F.to_json(F.struct(*TRADE_COLUMNS), {"ignoreNullFields": "false"})
    return trades.select(
        F.encode("symbol", "UTF-8").alias("key"), F.encode(body, "UTF-8").alias("value")
    )


def mark_records(records: DataFrame) -> DataFrame:
    """Topic records to trades, with ``reject_reason`` for what cannot be decoded."""
    text = F.try_validate_utf8(F.col("value").cast("string"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRADE) + ", _corrupt string"
    decoded = records.select(
        text.alias("_text"),
        F.from_json(text, ddl, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_t"),
    )
    reason = (
        F.when(F.col("_text").isNull(), "bad_utf8")
        .when(F.col("_t").isNull() | F.col("_t._corrupt").isNotNull(), "bad_json")
        .when(~_plausible(F.col("_t.source_timestamp")), "bad_time")
    )
    return decoded.select("_t.*", reason.alias("reject_reason"), F.col("_text").alias("raw")).drop(
        "_corrupt"
    )


def decode_trades(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topic records to ``(trades, quarantine)``."""
    marked = mark_records(records)
    return accepted(marked), quarantined(marked)


def only_watched(trades: DataFrame, watchlist: DataFrame | list[str]) -> DataFrame:
    """Keep the symbols of the watchlist.

    A Python list is bounded by the caller and becomes a pushed-down ``IN``. A
    DataFrame is semi-joined without a hint, so Spark broadcasts it only when its
    size is known to fit.
    """
    if isinstance(watchlist, DataFrame):
        return trades.join(watchlist.select("symbol"), "symbol", "left_semi")
    return trades.filter(F.col("symbol").isin(watchlist))
