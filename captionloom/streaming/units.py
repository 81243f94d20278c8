"""Units of a source as its events come in: state for each source, event-time timers for sources that fall silent, and a sink
that a repeated batch does not double."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What is known of a source: units closed so far, and of the open one its first and last event, events, amount and last time.
OPEN = "closed long, first_id long, last_id long, n long, amount long, last_ms long"
UNITS = "unit_no long, first_event long, last_event long, n_events long, amount long, end_ms long, closed_by string"


class UnitProcessor(StatefulProcessor):
    """Rows (event_id, ms, amount, ends) of one source. A unit closes with an event that ends it, or once no event has come for
    `pause` milliseconds: seen from the next event, or by a timer when the watermark has passed."""

    def __init__(self, kind: str, pause: int):
        self.kind, self.pause = kind, pause

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", OPEN)

    def _unit(self, key: tuple, state: list[int], by: str) -> tuple:
        closed, first, last, n, amount, ms = state
        state[:] = [closed + 1, 0, 0, 0, 0, ms]
        return (*key, closed + 1, first, last, n, amount, ms, by)

    def _frame(self, units: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(units, columns=["source", *(c.split(" ")[0] for c in UNITS.split(", "))])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # each call of the state is a message to the JVM: none is asked whether it exists
        state = list(self.state.get() or [0] * 6)
        if state[3]:
            self.handle.deleteTimer(state[5] + self.pause)
        units = []
        # lists, as a source has few rows in a batch and a frame costs more than they do
        events = [x for part in rows for x in zip(*(part[c].tolist() for c in ("ms", "event_id", "amount", "ends")), strict=True)]
        for ms, event, amount, ends in sorted(events):
            if state[3] and ms - state[5] > self.pause:
                units.append(self._unit(key, state, "pause"))
            if not state[3]:
                state[1] = event
            state[2:] = [event, state[3] + 1, state[4] + amount, ms]
            if ends:
                units.append(self._unit(key, state, "end"))
        self.state.update(tuple(state))
        if state[3]:
            self.handle.registerTimer(state[5] + self.pause)
        if units:
            yield self._frame(units)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = list(self.state.get())
        units = [self._unit(key, state, "pause")] if state[3] else []
        self.state.update(tuple(state))
        if units:
            yield self._frame(units)

    def close(self) -> None:
        pass


def streamed_units(events: DataFrame, pause_ms: int, delay: str = "0 seconds") -> DataFrame:
    """events(source, event_id, time, amount, ends), a stream in the order of time but for `delay` -> units as they close: source,
    unit_no (from 1), first_event, last_event, n_events, amount, end_ms, closed_by (end or pause).

    The open unit of each source is all that is kept. It needs the RocksDB state store, see rocks()."""
    rows = events.withWatermark("time", delay).select("source", "event_id", "time", F.unix_millis("time").alias("ms"), "amount", "ends")
    kind = rows.schema["source"].dataType.simpleString()
    return rows.groupBy("source").transformWithStateInPandas(UnitProcessor(kind, pause_ms), f"source {kind}, {UNITS}", "append", "EventTime")


@contextmanager
def rocks(spark: SparkSession):
    """The session's state store while a stream is started, which keeps it for good."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


def write_batch(path: str):
    """A foreachBatch function that writes each batch to a folder of its number. A batch that is repeated after a failure replaces
    what its first try has left, so nothing is lost or there twice."""

    def write(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def run_units(units: DataFrame, path: str, checkpoint: str, write=None) -> StreamingQuery:
    """Works off the stream's input that is there and stops; the checkpoint lets the next run go on from there."""
    with rocks(units.sparkSession):
        stream = units.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        return stream.foreachBatch(write or write_batch(path)).trigger(availableNow=True).start()
