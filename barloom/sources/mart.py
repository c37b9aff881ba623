"""Keyed candle tables on partitioned Parquet.

A merge writes every period it touches to a new directory, and then a small file that names
the current directory of each period. Readers follow the newest such file, so they never see
a half-written merge, and what they hold stays readable until ``keep`` more merges are done.
Two merges at once do not mix: within a process they take turns, and of two processes the one
whose base has been overtaken merges again.
"""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from collections.abc import Sequence
from datetime import datetime
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.bars import as_moment
from barloom.operators.lookup import last_bars
from barloom.operators.merge import UpsertRule, last_per_key, merge_upsert
from barloom.schemas import MART_KEYS
from barloom.session import stored
from barloom.sources.paths import create_text, delete, names, read_text

# Length of 'yyyy-MM-dd HH' that names a period of each grain.
GRAINS = {"year": 4, "month": 7, "day": 10, "hour": 13}
PERIOD = "period"
VERSION = "version"
_TRIES = 10

_locks: dict[str, threading.Lock] = defaultdict(threading.Lock)


class Sink(Protocol):
    """Anything candles can be upserted into."""

    def merge(
        self,
        source: DataFrame,
        rule: UpsertRule,
        order: Sequence[str] = (),
        now: datetime | Column | None = None,
    ) -> None: ...


class Mart:
    """A table unique on ``keys`` and partitioned by the period of ``window_start``.

    Pick the grain so that one period is small against a merge: ``hour`` or ``day``
    for one-minute candles, ``month`` for daily bars.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        grain: str = "day",
        keys: Sequence[str] = MART_KEYS,
        keep: int = 2,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = tuple(keys)
        self._length = GRAINS[grain]
        self._keep = keep
        self._data = f"{self.path}/data"
        self._pointers = f"{self.path}/current"
        self._views: set[str] = set()
        self._stored = T.StructType(
            [T.StructField(f.name, f.dataType) for f in schema]
            + [T.StructField(PERIOD, T.StringType()), T.StructField(VERSION, T.StringType())]
        )

    # -- reading -----------------------------------------------------------

    def read(self, since: Column | None = None, until: Column | None = None) -> DataFrame:
        """The table, or the bars with ``since <= window_start < until``.

        Bounds, which are constants, choose the period directories before any is listed.
        """
        df = self._table(self._between(self._current()[1], since, until))
        if since is not None:
            df = df.filter(F.col(PERIOD) >= self._period(since)).filter(F.col("window_start") >= since)
        if until is not None:
            df = df.filter(F.col(PERIOD) <= self._period(until)).filter(F.col("window_start") < until)
        return df.drop(PERIOD, VERSION)

    def last_bars(self, watchlist: DataFrame) -> DataFrame:
        """Every watchlist symbol with ``last_window``, its last bar; NULL when it has none.

        Periods are searched from the newest back, in rounds of twice as many, until every
        symbol is found. Only a symbol without any bar has all periods searched.
        """
        current = self._current()[1]
        periods = sorted(current, reverse=True)
        missing = stored(watchlist.select("symbol").distinct(), "last-bars")
        found, lo, size = [], 0, 1
        while lo < len(periods) and not missing.isEmpty():
            bars = self._table({p: current[p] for p in periods[lo : lo + size]})
            last = stored(missing.join(last_bars(bars), "symbol", "left"), "last-bars")
            found.append(last.filter("last_window IS NOT NULL"))
            missing = last.filter("last_window IS NULL").select("symbol")
            lo, size = lo + size, 2 * size
        rows = missing.withColumn("last_window", F.lit(None).cast("timestamp_ntz"))
        for part in found:
            rows = rows.unionByName(part)
        return rows

    def ensure(self) -> None:
        """Create the table when it is absent."""
        if not names(self.spark, self._pointers):
            create_text(self.spark, self._pointer(0), "")

    def view(self, name: str) -> None:
        """A temporary view that follows every merge by this object."""
        self._views.add(name)
        self.read().createOrReplaceTempView(name)

    # -- writing -----------------------------------------------------------

    def merge(
        self,
        source: DataFrame,
        rule: UpsertRule,
        order: Sequence[str] = (),
        now: datetime | Column | None = None,
    ) -> None:
        """Upsert ``source``. An empty source changes nothing.

        The source is written out once before it is used: a streaming batch must not
        be evaluated again, and a lost executor then re-reads a file instead of
        recomputing the whole lineage.
        """
        incoming = f"{self.path}/incoming-{uuid.uuid4().hex}"
        arrived = self._incoming_rows(source, order, now)
        arrived.write.parquet(incoming)
        rows = self.spark.read.schema(arrived.schema).parquet(incoming)
        periods = sorted(r[0] for r in rows.select(PERIOD).distinct().collect())
        with _locks[self.path]:
            self.ensure()
            if periods:
                for _ in range(_TRIES):
                    if self._merge_rows(rows, rule, periods):
                        break
                else:
                    raise RuntimeError(f"{self.path}: overtaken by other writers {_TRIES} times")
                for name in self._views:
                    self.read().createOrReplaceTempView(name)
        delete(self.spark, incoming)

    def _merge_rows(self, rows: DataFrame, rule: UpsertRule, periods: list[str]) -> bool:
        """One attempt; False if another process has changed the table meanwhile."""
        number, current = self._current()
        before = self._table({p: current[p] for p in periods if p in current}).drop(VERSION)
        merged = merge_upsert(before, rows, rule, (*self.keys, PERIOD), unique=True)
        version = uuid.uuid4().hex
        (
            merged.withColumn(VERSION, F.lit(version))
            .hint("rebalance", PERIOD)
            .write.mode("append")
            .partitionBy(PERIOD, VERSION)
            .parquet(self._data)
        )
        text = "\n".join(f"{p} {v}" for p, v in sorted((current | dict.fromkeys(periods, version)).items()))
        if not create_text(self.spark, self._pointer(number + 1), text):
            for period in periods:
                delete(self.spark, self._directory(period, version))
            return False
        self._clean(number + 1)
        return True

    def _clean(self, number: int) -> None:
        """Remove what only pointers older than the last ``keep`` name."""
        old = sorted(n for n in self._numbers() if n < number - self._keep)
        if not old:
            return
        kept = [self._named(n) for n in self._numbers() if n >= number - self._keep]
        for n in old:
            for period, version in self._named(n).items():
                if all(k.get(period) != version for k in kept):
                    delete(self.spark, self._directory(period, version))
            delete(self.spark, self._pointer(n))

    def _incoming_rows(
        self, source: DataFrame, order: Sequence[str], now: datetime | Column | None
    ) -> DataFrame:
        names = [f.name for f in self.schema if f.name in source.columns]
        extra = [c for c in order if c not in names]
        rows = last_per_key(source.select(*names, *extra), self.keys, order).select(
            *(self._checked(self.schema[c]) for c in names)
        )
        if "created_at" in self.schema.fieldNames():
            rows = rows.withColumn("created_at", as_moment(now))
        return rows.withColumn(PERIOD, self._period(F.col("window_start")))

    @staticmethod
    def _checked(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            refuse = F.raise_error(F.lit(f"{field.name} must not be NULL"))
            value = F.when(value.isNull(), refuse.cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    def _pointer(self, number: int) -> str:
        return f"{self._pointers}/{number:012d}"

    def _directory(self, period: str, version: str) -> str:
        return f"{self._data}/{PERIOD}={period}/{VERSION}={version}"

    def _numbers(self) -> list[int]:
        return [int(n) for n in names(self.spark, self._pointers) if n.isdigit()]

    def _named(self, number: int) -> dict[str, str]:
        """The directory of each period under one pointer."""
        lines = read_text(self.spark, self._pointer(number)).splitlines()
        return dict(line.split(" ") for line in lines)

    def _current(self) -> tuple[int, dict[str, str]]:
        number = max(self._numbers(), default=-1)
        return number, self._named(number) if number >= 0 else {}

    def _between(self, current: dict[str, str], since: Column | None, until: Column | None) -> dict[str, str]:
        """The periods that hold moments of the range."""
        if since is None and until is None:
            return current
        ends = [F.lit("") if m is None else self._period(m) for m in (since, until)]
        first, last = self.spark.sql("VALUES (1)").select(*ends).first()
        if first is None or last is None:  # nothing is compared with NULL
            return {}
        return {p: v for p, v in current.items() if first <= p and (until is None or p <= last)}

    def _table(self, current: dict[str, str]) -> DataFrame:
        if not current:
            return self._empty()
        reader = self.spark.read.schema(self._stored).option("basePath", self._data)
        return reader.parquet(*(self._directory(p, v) for p, v in current.items()))

    def _empty(self) -> DataFrame:
        none = (F.lit(None).cast(f.dataType).alias(f.name) for f in self._stored)
        return self.spark.range(0).select(*none)

    def _period(self, moment: Column) -> Column:
        text = F.substring(moment.cast("timestamp_ntz").cast("string"), 1, self._length)
        return F.replace(text, F.lit(" "), F.lit("T"))
