"""Keyed streams in event-time order, on state that is read piece by piece.

Rows wait for the watermark in the key's state as sorted chunks, entries of a
map in the RocksDB store, so neither a task nor a state value ever holds the
whole backlog of a key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.plans.sequential import Step
from millrace.session import new_path
from millrace.streaming.jobs import run_available, with_end

#: rows of a chunk, and rows of a key that one call sorts at a time
CHUNK, SORTED = 4096, 65_536

_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which ``keyed_stream`` needs."""
    before = {name: spark.conf.get(name, None) for name in _STORE}
    for name, value in _STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# tick(memory, until): rows that time alone brings up to ``until``, and the time of the next ones
Tick = Callable[[dict, int], tuple[pd.DataFrame, int | None]]


class OrderedSteps(StatefulProcessor):
    """Steps the rows of a key in order as the watermark passes them.

    State of a key: ``chunks``, a map from number to sorted rows; ``index``,
    the times of the first and last row of each chunk; ``memory`` of the step.
    A chunk is read once, when the watermark has passed its first row, and only
    chunks that overlap in time are in memory together.
    """

    def __init__(self, step: Step, order: Sequence[str], columns: pa.Schema, idle: int | None, grid: int, tick: Tick | None = None):
        self.step, self.order, self.columns, self.idle, self.grid, self.tick = step, list(order), columns, idle, grid, tick

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "number bigint", "rows binary")
        self.index = handle.getValueState("index", "index string")
        self.memory = handle.getValueState("memory", "memory string")

    def close(self) -> None:
        pass

    # -- chunks ----------------------------------------------------------------

    def _index(self) -> dict:
        # chunks come and go, and no number is used twice
        return json.loads(self.index.get()[0]) if self.index.exists() else {"next": 0, "chunks": []}

    def _put(self, index: dict, rows: pd.DataFrame) -> None:
        batch = pa.RecordBatch.from_arrays([pa.Array.from_pandas(rows[f.name], type=f.type) for f in self.columns], schema=self.columns)
        number, index["next"] = index["next"], index["next"] + 1
        self.chunks.updateValue((number,), (batch.serialize().to_pybytes(),))
        index["chunks"].append([int(rows["row_us"].iloc[0]), int(rows["row_us"].iloc[-1]), number])

    def _take(self, number: int) -> pd.DataFrame:
        raw = self.chunks.getValue((number,))[0]
        self.chunks.removeKey((number,))
        return pa.ipc.read_record_batch(pa.py_buffer(raw), self.columns).to_pandas()

    def _store(self, index: dict, rows: pd.DataFrame) -> None:
        """Few rows are one chunk; many are cut on a grid of time, so that chunks of one key that come apart do not all overlap."""
        rows = self._sorted(rows)
        if len(rows) <= CHUNK:
            self._put(index, rows)
            return
        for _, some in rows.groupby(rows["row_us"] // self.grid, sort=True):
            for at in range(0, len(some), CHUNK):
                self._put(index, some.iloc[at : at + CHUNK])

    def _sorted(self, rows: pd.DataFrame) -> pd.DataFrame:
        first = rows[self.order[0]]
        if first.is_monotonic_increasing and first.is_unique:
            return rows.reset_index(drop=True)
        return rows.sort_values(self.order, kind="stable", ignore_index=True)

    # -- calls of Spark ---------------------------------------------------------

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        index, held, n = None, [], 0
        for frame in rows:
            ends = frame["row_end"].fillna(False).astype(bool).to_numpy()
            frame = (frame[~ends] if ends.any() else frame)[self.columns.names]
            if frame.empty:
                continue
            index = index or self._index()
            held, n = [*held, frame], n + len(frame)
            if n >= SORTED:
                self._store(index, pd.concat(held, ignore_index=True))
                held, n = [], 0
        if held:
            self._store(index, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])
        if index:
            self._wait(index)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        index = self._index()
        due = sorted(c for c in index["chunks"] if c[0] <= passed)
        kept = json.loads(self.memory.get()[0]) if self.memory.exists() else None
        if not due and not (self.tick and kept):
            if self.idle is not None and not index["chunks"] and kept and kept["last"] + self.idle <= passed:
                # nothing came and nothing waits: the key has been idle
                self.memory.clear()
                self.index.clear()
            return
        index["chunks"] = [c for c in index["chunks"] if c[0] > passed]
        memory, new, last = (kept["memory"], False, kept["last"]) if kept else ({}, True, 0)
        open_rows = None
        for i, (_, _, number) in enumerate(due):
            rows = self._take(number)
            open_rows = rows if open_rows is None or open_rows.empty else self._sorted(pd.concat([open_rows, rows], ignore_index=True))
            # rows before the next chunk's first one are settled
            edge = min(due[i + 1][0] - 1, passed) if i + 1 < len(due) else passed
            settled = (open_rows["row_us"] <= edge).to_numpy()
            if settled.all():
                ready, open_rows = open_rows, None
            else:
                ready, open_rows = open_rows[settled].reset_index(drop=True), open_rows[~settled].reset_index(drop=True)
            if len(ready):
                last = int(ready["row_us"].iloc[-1])
                out = self.step(memory, ready.drop(columns="row_us"), [(0, len(ready), new)])
                new = False
                if len(out):
                    yield out
        if open_rows is not None and len(open_rows):
            self._store(index, open_rows)
        wake = None if self.idle is None else max(last + self.idle, passed + 1000)
        if self.tick:
            # all rows up to here have been stepped
            out, wake = self.tick(memory, passed)
            if len(out):
                yield out
        self.memory.update((json.dumps({"memory": memory, "last": last}),))
        self._wait(index, wake)

    def _wait(self, index: dict, wake: int | None = None) -> None:
        """A timer for the first row that waits, and for the key's own time."""
        self.index.update((json.dumps(index),))
        first = min((c[0] for c in index["chunks"]), default=None)
        for at in (first, wake if self.tick or first is None else None):
            if at is not None:
                self.handle.registerTimer(-(-at // 1000))


def keyed_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, schema: str, late: str = "1 hour",
    time: Column | None = None, idle: int | None = None, end: str | None = None, grid: int = 3_600_000_000, tick: Tick | None = None,
) -> DataFrame:
    """Apply ``step`` per key to its rows in event-time order, however the batches are cut.

    ``time`` is the event time; without it, the first column of ``order`` in
    microseconds. Rows wait in the state of their key until the watermark,
    ``late`` behind the latest row, has passed them, and are then stepped in
    ``order``. Rows older than the watermark up to which rows have been stepped
    are dropped, and counted in the query's progress; the first watermark is 1970-01-01, so
    event times lie behind that. With ``idle`` (microseconds), a key whose last
    row is that far behind the watermark is forgotten; the step must not need
    its memory any longer by then; ``tick`` is used instead if rows arise from
    time alone: it is called whenever the watermark passes the time it has
    named, after all rows up to there. ``end`` is the folder of ``with_end``.

    A task holds at most ``SORTED`` new rows of a key, or the chunks that
    overlap in time: those of one step of ``grid`` microseconds, and one for
    each batch whose rows of the key are fewer than ``CHUNK``. Start the
    query inside ``rocksdb``; ``run_keyed`` does. The names of the columns of
    ``stream`` begin with a letter, as they become fields of Python rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    moment = F.timestamp_micros(F.col(order[0])) if time is None else time
    timed = stream.withColumn("row_time", moment)
    if end:
        timed = with_end(timed, "row_time", end)
    else:
        timed = timed.withColumn("row_end", F.lit(False))
    timed = timed.withColumn("row_us", F.unix_micros("row_time")).withWatermark("row_time", late)
    columns = StructType([f for f in timed.schema.fields if f.name not in ("row_time", "row_end")])
    work = OrderedSteps(step, order, to_arrow_schema(columns), idle, grid, tick)
    return timed.groupBy(*keys).transformWithStateInPandas(work, schema, "append", "EventTime")


def run_keyed(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, schema: str, late: str = "1 hour",
    time: Column | None = None, idle: int | None = None, grid: int = 3_600_000_000, progress: list | None = None, tick: Tick | None = None,
) -> DataFrame:
    """The table that ``keyed_stream`` gives over all available input, which ends with it."""
    spark = stream.sparkSession
    end = new_path(spark, "end")
    with rocksdb(spark):
        return run_available(keyed_stream(stream, keys, order, step, schema, late, time, idle, end, grid, tick), end=end, progress=progress)
