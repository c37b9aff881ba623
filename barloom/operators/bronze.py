"""Raw layer: trades with their UTC date as text partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.times import date_parts
from barloom.schemas import BRONZE, DATE_PARTS


def to_bronze(trades: DataFrame) -> DataFrame:
    """Add ``year``, ``month`` and ``day`` of ``source_timestamp``."""
    return trades.withColumns(date_parts(F.col("source_timestamp"))).select(*BRONZE.fieldNames())


def partition_counts(bronze: DataFrame) -> DataFrame:
    """Rows per date partition."""
    return bronze.groupBy(*DATE_PARTS).agg(F.count("*").alias("records"))


def between_dates(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of the days ``first`` to ``last`` (``yyyy-MM-dd``, both included).

    The predicate is on the partition columns themselves, so whole directories are
    skipped; a predicate on the event time alone would read every file.
    """
    return df.filter(_day_range(first, last))


def _day_range(first: str, last: str) -> Column:
    y, m, d = (F.col(p) for p in DATE_PARTS)
    fy, fm, fd = first.split("-")
    ly, lm, ld = last.split("-")
    after = (y > fy) | ((y == fy) & ((m > fm) | ((m == fm) & (d >= fd))))
    before = (y < ly) | ((y == ly) & ((m < lm) | ((m == lm) & (d <= ld))))
    return after & before

