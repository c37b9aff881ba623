"""Row counters of running queries, taken while the rows pass by."""

from __future__ import annotations

import weakref
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def observed(df: DataFrame, name: str) -> DataFrame:
    """Count the rows of every batch under ``name``, without another pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


_live: weakref.WeakSet = weakref.WeakSet()


def report(name: str, df: DataFrame) -> None:
    """Count a batch that a ``foreachBatch`` function is about to write, if anyone listens."""
    if _live:
        rows = df.count()
        for counters in _live:
            counters.totals[name] += rows


class RowCounters(StreamingQueryListener):
    """Totals of the observed counts over all batches of all queries.

    ``late`` adds up the rows that stateful operators dropped behind the watermark.
    """

    def __init__(self) -> None:
        self.totals: Counter[str] = Counter()
        self.failures = 0
        _live.add(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            self.totals[name] += row["rows"]
        self.totals["late"] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failures += event.exception is not None


def late_rows(query: StreamingQuery) -> int:
    """Rows the recent batches of ``query`` dropped behind the watermark."""
    return sum(
        s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators
    )


def totals_of(*queries: StreamingQuery) -> Counter[str]:
    """The observed counts of all recent batches of these queries; unlike a listener, at once."""
    totals: Counter[str] = Counter()
    for query in queries:
        for progress in query.recentProgress:
            for name, row in progress.observedMetrics.items():
                totals[name] += row["rows"]
    return totals
