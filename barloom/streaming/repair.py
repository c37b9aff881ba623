"""Candles of ticks that come behind the watermark.

The candle stream drops them, but the clean layer has them. They are noted in a side table, and
the windows they belong to are computed anew, as a batch over the days they lie in, and merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.functions.times import floor_div, ms_to_utc, width_micros
from barloom.operators.candles import candles
from barloom.operators.merge import GROWING
from barloom.operators.silver import split_future
from barloom.schemas import SILVER_PARTITIONS, SILVER_STORED
from barloom.settings import CANDLE_WIDTH, FUTURE_SKEW_MS, WATERMARK
from barloom.sources.mart import Sink
from barloom.sources.paths import create_text, delete, names
from barloom.streaming.jobs import _start

_DAY_MS = 86_400_000


def windows_of(ticks: DataFrame, width: str = CANDLE_WIDTH) -> DataFrame:
    """``ticks`` with ``_window``, the start of the window in epoch milliseconds."""
    step = width_micros(width) // 1000
    return ticks.withColumn("_window", floor_div(F.col("source_timestamp"), step) * step)


def candles_anew(late: DataFrame, path: str, width: str = CANDLE_WIDTH, decimals: int = 6, skew_ms: int | None = FUTURE_SKEW_MS) -> DataFrame:
    """The candles of all windows that ``late`` has a tick in, from the clean layer at ``path``.

    Only the directories of the days those windows cover are read. A window is joined by its
    key, so ticks of other windows go before the shuffle wherever the keys are few.
    """
    step = width_micros(width) // 1000
    keys = windows_of(late, width).select("symbol", "asset_class", "_window").distinct()
    first, last = F.col("_window"), F.col("_window") + (step - 1)
    every_day = F.explode(F.sequence(floor_div(first, _DAY_MS), floor_div(last, _DAY_MS)))
    days = keys.select("asset_class", every_day.alias("_day")).distinct()
    name = F.concat_ws("/", "asset_class", F.date_format(ms_to_utc(F.col("_day") * _DAY_MS), "yyyy/MM/dd"))
    touched = [r[0] for r in days.select(name).collect()]
    stored = late.sparkSession.read.schema(SILVER_STORED).parquet(path)
    stored = stored.filter(F.concat_ws("/", *SILVER_PARTITIONS).isin(touched))
    if skew_ms is not None:
        stored, _ = split_future(stored, skew_ms)
    wanted = windows_of(stored, width).join(keys, ["symbol", "asset_class", "_window"], "left_semi")
    return candles(wanted.drop("_window"), width, decimals=decimals)


class _Newest:
    """The newest trade time of the batches so far, in a folder that readers pass over."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self._folder = spark, f"{path.rstrip('/')}/_newest"

    def upto(self, batch_id: int, newest: int) -> int:
        """Over the earlier batches and this one, which is taken note of."""
        notes = sorted(tuple(int(x) for x in n.split("_")) for n in names(self.spark, self._folder) if "_" in n.strip("_"))
        earlier = [n for n in notes if n[0] < batch_id]
        newest = max([newest, *(ms for _, ms in earlier)])
        create_text(self.spark, f"{self._folder}/{batch_id:012d}_{newest}", "")
        for number, ms in earlier[:-1]:
            delete(self.spark, f"{self._folder}/{number:012d}_{ms}")
        return newest


def start_repair(
    silver: DataFrame,
    path: str,
    mart: Sink,
    late_path: str,
    checkpoint: str,
    every: str | None = None,
    width: str = CANDLE_WIDTH,
    watermark: str = WATERMARK,
    decimals: int = 6,
    skew_ms: int | None = FUTURE_SKEW_MS,
) -> StreamingQuery:
    """Merge the candles of late ticks; ``silver`` streams the clean layer at ``path``.

    Late is what lies more than ``watermark`` behind the newest trade time of its own and all
    earlier batches; that is at least what the candle stream drops. Late ticks are kept in
    ``late_path`` by batch. A replayed batch writes the same again. The candle stream beside
    it needs the ``GROWING`` rule, under which a candle of fewer ticks never replaces one of
    more, so it does not matter which of the two runs ahead.
    """
    spark = silver.sparkSession
    behind = width_micros(watermark) // 1000
    notes = _Newest(spark, late_path)

    def repair(batch: DataFrame, batch_id: int) -> None:
        if skew_ms is not None:
            batch, _ = split_future(batch, skew_ms)
        newest = batch.agg(F.max("source_timestamp")).first()[0]
        if newest is None:
            return
        late = batch.filter(F.col("source_timestamp") < notes.upto(batch_id, newest) - behind)
        number = f"batch_id={batch_id}"
        late.hint("rebalance").write.mode("overwrite").parquet(f"{late_path}/{number}")
        late = spark.read.schema(batch.schema).parquet(f"{late_path}/{number}")
        if not late.isEmpty():
            mart.merge(candles_anew(late, path, width, decimals, skew_ms), GROWING)

    return _start(silver.writeStream.foreachBatch(repair), checkpoint, every)
