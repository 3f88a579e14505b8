"""Keyed state in Spark's state store (STR-05, 07, 09, 10, 12; PIPE-25).

Each operator is a ``StatefulProcessor`` over ``transformWithState`` with
RocksDB: only keys that a batch touches (by rows or by a timer) are read and
written, whatever the size of the state, and a query restarted from its
checkpoint goes on where it stopped.

* ``running_counts``: a count per key, carried over batches, with an optional
  time to live;
* ``alarm_rows``: the error alarm.  A presence key ``(url, err_code)`` owns its
  full keys in a map; a timer set in every batch that holds the presence key
  fires in the next one that does not, and recovers what it owns;
* ``windowed_counts_with_late``: event-time windows closed by a timer; rows of
  a closed window are not dropped but returned as late.

Rows are counted per key inside each task before the shuffle
(``partial_counts``, ``partial_errors``), so a hot key sends a few rows a task
and a key's state task never sees its raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import constants as K
from ..functions.columns import epoch_seconds_to_text

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_settings(spark: SparkSession, replay: bool = False):
    """Settings a stateful query takes over when it starts.  ``replay`` adds
    no empty batch after the data, so a replay's batches are its files."""
    want = {"spark.sql.streaming.stateStore.providerClass": ROCKS}
    if replay:
        want["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_rows(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """One state variable of a stopped query, read back from its checkpoint."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def _aggregated(df: DataFrame, keys: Sequence[str], aggs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Every Arrow batch grouped by ``keys``; ``aggs``: (column, Arrow
    aggregate, result column of type long)."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b]).group_by(list(keys)).aggregate([(c, how) for c, how, _ in aggs])
                t = t.select([*keys, *[f"{c}_{how}" for c, how, _ in aggs]]).rename_columns([*keys, *[n for *_, n in aggs]])
                yield from t.combine_chunks().to_batches()

    schema = [f"`{k}` {fields[k]}" for k in keys] + [f"`{n}` long" for *_, n in aggs]
    return df.mapInArrow(run, ", ".join(schema))


# --- STR-09: running counts ---------------------------------------------------------------

def partial_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, pv): rows of each key, counted batch by batch inside a task."""
    return _aggregated(df.select(*keys, F.lit(1).cast("long").alias("pv")), keys, [("pv", "sum", "pv")])


class RunningCount(StatefulProcessor):
    """One long a key; emits (key, this batch's count, count so far)."""

    def __init__(self, keys: Sequence[str], ttl_ms: int | None):
        self.keys, self.ttl_ms = tuple(keys), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        pv = sum(int(r["pv"].sum()) for r in rows)
        running = pv + (self.count.get()[0] if self.count.exists() else 0)
        self.count.update((running,))
        yield pd.DataFrame([(*key, pv, running)], columns=[*self.keys, "pv", "running"])

    def close(self) -> None:
        pass


def running_counts(stream: DataFrame, keys: Sequence[str], ttl_ms: int | None = None) -> DataFrame:
    """(keys, pv, running), one row for every key of a batch.  A key without
    rows for ``ttl_ms`` starts again at zero."""
    parts = partial_counts(stream, keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields if f.name != "pv")
    return parts.groupBy(*keys).transformWithStateInPandas(
        RunningCount(keys, ttl_ms), f"{kinds}, pv long, running long", "Update", "ProcessingTime" if ttl_ms else "None")


# --- STR-05 / STR-07 / PIPE-25: alarm --------------------------------------------------------

_PRESENCE = ("url", "err_code")
_OWNED = ("sv", "bn", "err_msg")
_ALARM = "t0 long, num long, status int, t1 long, total long"


def partial_errors(parsed: DataFrame) -> DataFrame:
    """(full key, t0, num, t1): first time, errors and last time of each key,
    taken batch by batch inside a task."""
    rows = parsed.select(*_PRESENCE, *_OWNED, F.col("time_stamp").cast("long").alias("t0"),
                         F.col("time_stamp").cast("long").alias("t1"),
                         F.col("ip_addr").isNotNull().cast("long").alias("num"))
    return _aggregated(rows, [*_PRESENCE, *_OWNED], [("t0", "min", "t0"), ("num", "sum", "num"), ("t1", "max", "t1")])


class AlarmKeys(StatefulProcessor):
    """The alarms of one presence key; emits all of them in every batch that
    touches it.  Rules as in ``alarm``: at or over the threshold 0 (new) or 1
    (ongoing), under it 2 (recovered) or nothing, absent but with the presence
    key here: unchanged, presence key absent: 2; a recovered one is told once
    and forgotten."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alarms = handle.getMapState("alarms", "sv string, bn string, err_msg string", _ALARM)

    def _drop_told(self) -> dict:
        """The alarms that go on; recovered ones leave the state."""
        if not self.alarms.exists():
            return {}
        held = {tuple(k): tuple(v) for k, v in self.alarms.iterator()}
        for k in [k for k, v in held.items() if v[2] == 2]:
            self.alarms.removeKey(k)
            del held[k]
        return held

    def _emit(self, key, held: dict) -> Iterator[pd.DataFrame]:
        if held:
            yield pd.DataFrame([(*key, *k, *v) for k, v in held.items()],
                               columns=[*_PRESENCE, *_OWNED, "t0", "num", "status", "t1", "total"])

    def handleInputRows(self, key, rows, timerValues):
        held = self._drop_told()
        seen: dict[tuple, tuple] = {}
        for part in rows:
            for r in part.astype(object).where(part.notna(), None).itertuples(index=False):
                k = (r.sv, r.bn, r.err_msg)
                t0, num, t1 = seen.get(k, (None, 0, None))
                first, last = [int(x) for x in (t0, r.t0) if x is not None], [int(x) for x in (t1, r.t1) if x is not None]
                seen[k] = (min(first, default=None), num + int(r.num), max(last, default=None))
        for k, (t0, num, t1) in seen.items():
            old, hot = held.get(k), num >= self.threshold
            if old is None and not hot:
                continue
            new = (t0, num, 0, t1, num) if old is None else (old[0], num, 1 if hot else 2, t1, old[4] + num)
            self.alarms.updateValue(k, new)
            held[k] = new
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if held:                       # due in the next batch, unless that batch holds the key
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1)
        yield from self._emit(key, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = {k: (v[0], 0, 2, v[3], v[4]) for k, v in self._drop_told().items()}
        self.alarms.clear()
        yield from self._emit(key, held)

    def close(self) -> None:
        pass


def alarm_rows(parsed: DataFrame, threshold: int = K.ALARM_THRESHOLD) -> DataFrame:
    """Alarm rows (columns of ``alarm.STATE_SCHEMA``) of every key a batch
    touches.  Equal null parts of a key are one key."""
    rows = partial_errors(parsed).groupBy(*_PRESENCE).transformWithStateInPandas(
        AlarmKeys(threshold), "url string, err_code string, sv string, bn string, err_msg string, " + _ALARM,
        "Update", "ProcessingTime")
    return rows.select("sv", "bn", "url", "err_code", "err_msg", epoch_seconds_to_text(F.col("t0")).alias("time_stamp"), "num",
                       "status", epoch_seconds_to_text(F.col("t1")).alias("final_time"), F.col("total").alias("total_num"))


# --- STR-10 / STR-12: windows that keep their late rows ------------------------------------------

class WindowCount(StatefulProcessor):
    """The count of one window and key.  Open: counted; closed by the
    watermark: emitted once; rows that come afterwards: emitted as late."""

    def __init__(self, keys: Sequence[str]):
        self.keys = tuple(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long")

    def _row(self, key, n: int, late: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, n, late)], columns=["window_start", "window_end", *self.keys, "n", "late"])

    def handleInputRows(self, key, rows, timerValues):
        n = sum(int(r["n"].sum()) for r in rows)
        end = key[1] * 1000
        if end <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, n, True)
            return
        if not self.count.exists():
            self.handle.registerTimer(end)
        self.count.update((n + (self.count.get()[0] if self.count.exists() else 0),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n = self.count.get()[0]
        self.count.clear()
        yield self._row(key, n, False)

    def close(self) -> None:
        pass


def windowed_counts_with_late(stream: DataFrame, seconds: str, length: int, watermark: str,
                              keys: Sequence[str] = ()) -> DataFrame:
    """(window_start, window_end, keys, n, late) of tumbling windows of
    ``length`` seconds over the epoch-second column ``seconds``: final counts
    (late = false) and the counts of rows that came after their window's end
    (late = true).  Rows without a time belong to no window."""
    at = F.col(seconds).cast("long")
    rows = stream.where(at.isNotNull()).select(
        (at - F.pmod(at, F.lit(length))).alias("window_start"), (at - F.pmod(at, F.lit(length)) + length).alias("window_end"),
        *keys, at.alias("last"), F.lit(1).cast("long").alias("n"))
    group = ["window_start", "window_end", *keys]
    parts = _aggregated(rows, group, [("last", "max", "last"), ("n", "sum", "n")])
    # the watermark follows the rows' times; without the time column no row is dropped before its processor
    marked = parts.withColumn("last", F.timestamp_seconds("last")).withWatermark("last", watermark)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields if f.name in group)
    return marked.select(*group, "n").groupBy(*group).transformWithStateInPandas(
        WindowCount(keys), f"{kinds}, n long, late boolean", "Update", "EventTime")


# --- running them -------------------------------------------------------------------------

def run_keyed(rows: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
              on_rows: Callable[[DataFrame, int], None] | None = None, replay: bool = False):
    """Start a keyed query: every batch's rows go to ``<out>/batch=<id>``
    (a replayed batch rewrites its own folder) and then to ``on_rows``."""
    def write(df: DataFrame, batch_id: int) -> None:
        path = f"{out.rstrip('/')}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        if on_rows is not None:
            on_rows(df.sparkSession.read.schema(df.schema).parquet(path), batch_id)

    with state_settings(rows.sparkSession, replay):
        return (rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def replay(arrivals: Iterable[Callable[[], None]], rows: Callable[[], DataFrame], out: str, checkpoint: str,
           empty_batches: bool = False) -> None:
    """Run a keyed query once after every arrival (a function that writes the
    arriving files), each time from the checkpoint of the run before: one
    micro-batch an arrival, however many files it has."""
    for arrive in arrivals:
        arrive()
        run_keyed(rows(), out, checkpoint, {"availableNow": True}, replay=not empty_batches).awaitTermination()
