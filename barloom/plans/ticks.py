"""Trades, frames and bars derived from the ``events`` table.

These adapters stand in for the live feed and the bar vendor: all rows of the table
become ticks, so the work of every query grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.symbols import asset_class
from barloom.functions.times import date_parts, epoch_ms, ms_to_instant

# The symbol each event type stands for.
SYMBOLS = {
    "click": "AAPL",
    "view": "MSFT",
    "purchase": "BINANCE:BTCUSDT",
    "signup": "BINANCE:ETHUSDT",
    "error": "BINANCE:ETHBTC",
}
EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")


_SYMBOL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SYMBOLS.items()) + " END"


def trades_from(events_df: DataFrame) -> DataFrame:
    """Events to the trade schema. Works on a stream too.

    The volume sits in JSON text. Exploding a one-element array keeps the parse in one
    place: as a plain column it would be repeated in every filter on it.
    """
    volume = "explode(array(CAST(get_json_object(props, '$.k') AS DOUBLE))) AS _volume"
    return events_df.withColumn("_ms", epoch_ms(events_df, "ts")).selectExpr("*", volume).selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        f"{_SYMBOL} AS symbol",
        "value AS price",
        "_volume AS volume",
        "_ms AS source_timestamp",
        "_ms + (event_id % 7) * 250 AS ingestion_timestamp",
        "CASE WHEN event_id % 5 = 0 THEN CAST(array() AS ARRAY<STRING>) "
        "ELSE array(event_type) END AS trade_conditions",
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from(events(spark, sf_dir))


def with_copies(ticks: DataFrame) -> DataFrame:
    """Ticks plus a later redelivery of every tenth, as an at-least-once feed gives."""
    again = ticks.filter(F.col("event_id").cast("bigint") % 10 == 0).withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp") + 60_000
    )
    return ticks.unionByName(again)


def timed(ticks: DataFrame) -> DataFrame:
    """Event time as an instant, asset class and date columns."""
    return ticks.withColumns(
        {
            "trade_time": ms_to_instant(F.col("source_timestamp")),
            "asset_class": asset_class(F.col("symbol")),
            **date_parts(F.col("source_timestamp")),
        }
    )


def frames_from(events_df: DataFrame) -> DataFrame:
    """Events to feed frames with their place (``record``), one shuffle-free frame per event.

    Every fourth frame quotes its numbers, every seventh element has no conditions. Some
    frames carry a second element that is refused: without a price (every third), without a
    symbol (13th), with a volume that is no number (17th), without a time (19th), or that is
    no object (23rd). Each eleventh event also yields a heartbeat, another type of frame and
    a line that is not JSON. Every tenth frame comes once more as a record of its own, and
    each seventh but one is delivered again.
    """
    t = trades_from(events_df).withColumn("_n", F.expr("CAST(event_id AS BIGINT)"))

    def number(col: str) -> str:
        return f"if(_n % 4 = 0, concat('\"', {col}, '\"'), CAST({col} AS STRING))"

    good = (
        f"""concat('{{"p":', {number("price")}, ',"s":"', symbol, '","t":', """
        f"""{number("source_timestamp")}, ',"v":', {number("volume")}, """
        """if(_n % 7 = 0, '', concat(',"c":', to_json(trade_conditions))), '}')"""
    )
    bad = ", ".join(
        f"""if(_n % {every} = 0, concat(',', {element}), '')"""
        for every, element in (
            (3, """'{"s":"', symbol, '","t":1,"v":1}'"""),
            (13, """'{"p":1,"t":1,"v":1}'"""),
            (17, """'{"s":"', symbol, '","p":1,"t":1,"v":"x"}'"""),
            (19, """'{"s":"', symbol, '","p":1,"t":null,"v":1}'"""),
            (23, "'5'"),
        )
    )
    frame = f"""concat('{{"type":"trade","data":[', {good}, {bad}, ']}}')"""
    line = lambda text, place: f"struct({text} AS value, concat('{place}/', event_id) AS record)"
    extra = (
        (11, line("""'{"type":"ping"}'""", "ping")),
        (11, line("""'{"type":"news","data":"x"}'""", "news")),
        (11, line("concat('not json ', event_id)", "junk")),
        (10, line(frame, "again")),
    )
    lines = ", ".join(f"if(_n % {every} = 0, array({x}), array())" for every, x in extra)
    usual = line(frame, "trade")
    return t.selectExpr(
        f"inline(concat(array({usual}), {lines}, if(_n % 7 = 1, array({usual}), array())))"
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream.

    A stream over a literal path wants a directory; as a pattern, the name may stand
    for one file or for a directory of them.
    """
    return spark.readStream.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parque[t]")
