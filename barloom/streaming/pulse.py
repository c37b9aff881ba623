"""Live pulse: how many ticks flow, which watched symbols fall silent, and when they are back.

Two clocks are there. By ``event`` time a symbol is judged by the trade times of the whole feed,
so a replay finds what the live run found, and ticks may come out of order within ``delay``.
By ``arrival`` it is judged by the clock of the cluster, which goes on when the whole feed stops.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from barloom.functions.times import ms_to_instant, ms_to_utc, width_micros
from barloom.operators.frames import only_watched
from barloom.operators.lookup import watchlist_frame
from barloom.plans.monitor import flow_rate
from barloom.session import ship
from barloom.streaming.jobs import _rocksdb, _start

SILENCE, DELAY = "5 minutes", "5 minutes"

_ROWS = "symbol STRING, status STRING, since BIGINT, at BIGINT"
_STATE = "last BIGINT, silent BOOLEAN, ahead ARRAY<BIGINT>"


def stretches(ticks: DataFrame, limit_ms: int) -> DataFrame:
    """Per Arrow batch and symbol, the stretches (first, last) of ticks that are at most
    ``limit_ms`` apart: all that the pulse needs of a hot symbol leaves a task as a few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).drop_null().sort_by([("symbol", "ascending"), ("ms", "ascending")])
            if not len(rows):
                continue
            ms, symbol = rows["ms"].to_numpy(), rows["symbol"].combine_chunks()
            new = pc.not_equal(symbol[1:], symbol[:-1]).to_numpy(zero_copy_only=False) | (ms[1:] - ms[:-1] > limit_ms)
            first = [0, *(new.nonzero()[0] + 1)]
            last = [*(x - 1 for x in first[1:]), len(ms) - 1]
            yield pa.RecordBatch.from_arrays([symbol.take(pa.array(first)), pa.array(ms[first]), pa.array(ms[last])], names=["symbol", "first", "last"])

    columns = ticks.select("symbol", F.col("source_timestamp").alias("ms"))
    return columns.mapInArrow(run, "symbol STRING, first BIGINT, last BIGINT")


def joined(found: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """Stretches in order, those at most ``limit`` apart as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(found):
        if out and first <= out[-1][1] + limit:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def judged(last: int | None, silent: bool, ahead: list[tuple[int, int]], limit: int, now: int) -> tuple[int | None, bool, list, list]:
    """What is certain when no tick up to ``now`` is missing: the new state, and rows (status, since, at)."""
    rows, ahead = [], joined(ahead, limit)
    while True:
        if ahead and last is not None and ahead[0][0] <= last + limit and not silent:
            last = max(last, ahead.pop(0)[1])  # goes on without a break
            continue
        if last is not None and not silent and last + limit <= now:
            rows.append(("silent", last, last + limit))
            silent = True
        if not ahead or ahead[0][0] > now:
            return last, silent, ahead, rows
        first, end = ahead.pop(0)
        if silent and end > last:
            rows.append(("back", last, first))
        silent = silent and end <= last
        last = end if last is None else max(last, end)


class _Silence(StatefulProcessor):
    """State of one symbol: its last tick, whether it is silent, and stretches not yet certain."""

    def __init__(self, limit_ms: int):
        self.limit = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)

    def _held(self) -> tuple[int | None, bool, list[tuple[int, int]]]:
        if not self.state.exists():
            return None, False, []
        last, silent, flat = self.state.get()
        flat = list(flat) if flat is not None else []
        return last, bool(silent), list(zip(flat[::2], flat[1::2], strict=True))

    def _hold(self, last: int | None, silent: bool, ahead: list[tuple[int, int]]) -> None:
        self.state.update((last, silent, [int(x) for pair in ahead for x in pair]))

    @staticmethod
    def _rows(key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            out = pd.DataFrame([(key[0], *r) for r in rows], columns=["symbol", "status", "since", "at"])
            yield out.astype({"since": "Int64", "at": "Int64"})

    def close(self) -> None:
        pass


class _EventSilence(_Silence):
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, silent, ahead = self._held()
        for part in rows:
            ahead += [(int(a), int(b)) for a, b in zip(part["first"], part["last"], strict=True)]
        yield from self._advance(key, (last, silent, ahead), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, self._held(), timerValues)

    def _advance(self, key, held, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        last, silent, ahead, rows = judged(*held, self.limit, now)
        self._hold(last, silent, ahead)
        moments = [ahead[0][0]] if ahead else []
        if last is not None and not silent:
            moments.append(last + self.limit)
        if moments and min(moments) > now:
            self.handle.registerTimer(min(moments))
        yield from self._rows(key, rows)


class _ArrivalSilence(_Silence):
    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A symbol that never ticks is silent as well."""
        self._hold(None, False, [])
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.limit)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, silent, _ = self._held()
        newest = max(int(part["last"].max()) for part in rows)
        now = timerValues.getCurrentProcessingTimeInMs()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self.handle.registerTimer(now + self.limit)
        self._hold(newest if last is None else max(last, newest), False, [])
        yield from self._rows(key, [("back", last, now)] if silent else [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, silent, _ = self._held()
        self._hold(last, True, [])
        yield from self._rows(key, [] if silent else [("silent", last, timerValues.getCurrentProcessingTimeInMs())])


def live_pulse(
    ticks: DataFrame, watchlist: DataFrame | list[str], silence: str = SILENCE, delay: str = DELAY, clock: str = "event"
) -> DataFrame:
    """A stream of rows (symbol, status, since, at), times zone-less in UTC.

    ``silent``: no tick for ``silence`` after the one at ``since``; ``at`` is when the alarm is
    due. ``back``: the first tick after that, at ``at``. By ``event`` time a row comes as soon as
    the feed is ``delay`` past it, and later ticks are not awaited; ``at`` is a trade time. By
    ``arrival`` time ``at`` is the cluster's, and a symbol without any tick is reported with no
    ``since``. Ticks without symbol or time, or of symbols not watched, do not count.
    """
    if clock not in ("event", "arrival"):
        raise ValueError(f"unknown clock {clock!r}")
    spark, limit = ticks.sparkSession, width_micros(silence) // 1000
    ship(spark)
    if not isinstance(watchlist, DataFrame):
        watchlist = watchlist_frame(spark, watchlist)
    found = stretches(only_watched(ticks, watchlist), limit)
    initial, processor, mode = None, _EventSilence(limit), "EventTime"
    if clock == "event":
        found = found.withColumn("_at", ms_to_instant(F.col("last"))).withWatermark("_at", delay)
    else:
        initial, processor, mode = watchlist.select("symbol").distinct().groupBy("symbol"), _ArrivalSilence(limit), "ProcessingTime"
    rows = found.groupBy("symbol").transformWithStateInPandas(processor, _ROWS, "Append", mode, initialState=initial)
    return rows.select("symbol", "status", *(ms_to_utc(F.col(c)).alias(c) for c in ("since", "at")))


def start_pulse(
    ticks: DataFrame,
    watchlist: DataFrame | list[str],
    path: str,
    checkpoint: str,
    every: str | None = None,
    silence: str = SILENCE,
    delay: str = DELAY,
    clock: str = "event",
) -> StreamingQuery:
    """The rows of :func:`live_pulse` as Parquet, each once, also after a restart."""
    writer = live_pulse(ticks, watchlist, silence, delay, clock).writeStream.format("parquet").option("path", path)
    with _rocksdb(ticks.sparkSession):
        return _start(writer.outputMode("append"), checkpoint, every)


def start_flow(
    ticks: DataFrame, path: str, checkpoint: str, every: str | None = None, width: str = "1 minute", delay: str = DELAY
) -> StreamingQuery:
    """Ticks and volume per window, class and symbol as Parquet, each window once.

    ``ticks`` stream the clean layer. A window is written when the feed is ``delay`` past its
    end; ticks that come later do not count.
    """
    rows = flow_rate(ticks.withWatermark("trade_time", delay), width)
    writer = rows.writeStream.format("parquet").option("path", path)
    with _rocksdb(ticks.sparkSession):
        return _start(writer.outputMode("append"), checkpoint, every)
