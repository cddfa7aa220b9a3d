"""The online breaker over events that arrive out of order (ST4).

``transformWithStateInPandas`` with event-time timers: an event is held in its
key's state until the watermark has passed the slot of time it lies in, then
the slots are folded in order by the walk of W6. So whatever order the events
within the watermark's delay arrive in, the trips are those of the batch form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.events import FAILURE_TYPE, FAIL_THRESHOLD, RESET_TIMEOUT_SECONDS, _Breaker

HEARTBEAT = "heartbeat"
FEW = 4096                 # events of a key that are held in one value
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORE = {_PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
          # a batch writes what it changed, not the whole store
          "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
          "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
_EVENT = np.dtype([("t", "<i8"), ("id", "<i8"), ("f", "?")])
_OUT = "user_id long, trip_at timestamp, open_until timestamp, late boolean"


def _rows(key, at, until, late: bool) -> pd.DataFrame:
    """Output rows of a key (known, user); times are microseconds (``until``
    may be None)."""
    user = int(key[1]) if key[0] else None
    when = lambda x: pd.Series(pd.to_datetime(pd.Series(x, dtype="Int64"), unit="us"), dtype="datetime64[us]")
    return pd.DataFrame({"user_id": pd.Series([user] * len(at), dtype="Int64"), "trip_at": when(at),
                         "open_until": when([None] * len(at) if until is None else until),
                         "late": pd.Series([late] * len(at), dtype="bool")})


class _HeldBreaker(StatefulProcessor):
    """State of a key: the walk's count, open window and the time up to which
    it is folded, with the events that are not folded yet, so that a batch
    reads and writes one value a key. A key with more than ``FEW`` of them
    keeps them in entries by slot of time and batch, counted by ``parts``.
    ``due`` is the first slot held, the only one with a timer."""

    def __init__(self, threshold: int, timeout_us: int, slot_us: int, few: int):
        self.walk, self.slot, self.few = _Breaker(threshold, timeout_us), slot_us, few

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "slot long, part long", "events binary")
        self.upto: dict = {}                 # what this task has folded of its keys in this batch
        self.state = handle.getValueState(
            "walk", "count long, until long, folded long, parts long, due long, events binary")

    def _timer(self, slot: int) -> None:
        self.handle.registerTimer(-(-(slot + 1) * self.slot // 1000))            # the same timer again changes nothing

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        count, until, folded, parts, due, raw = self.state.get() or (0, None, None, 0, None, b"")
        come = []
        for pdf in rows:
            real = ~pdf["beat"].to_numpy(dtype=bool)
            x = np.empty(np.count_nonzero(real), dtype=_EVENT)
            for to, name in (("t", "t_us"), ("id", "event_id"), ("f", "f")):
                x[to] = pdf[name].to_numpy()[real]
            if folded is not None and (late := x["t"] < folded).any():
                yield _rows(key, x["t"][late].tolist(), None, True)
                x = x[~late]
            come.append(x)
        x = np.concatenate(come) if come else np.empty(0, dtype=_EVENT)
        if not len(x):
            return
        first = int(x["t"].min() // self.slot)
        if due is None or first < due:
            due = first
            self._timer(due)
        x = np.concatenate([np.frombuffer(bytes(raw), dtype=_EVENT), x])
        if len(x) > self.few:
            x = x[np.argsort(x["t"], kind="stable")]
            for part in np.split(x, np.flatnonzero(np.diff(x["t"] // self.slot)) + 1):
                self.held.updateValue((int(part["t"][0] // self.slot), parts), (part.tobytes(),))
                parts += 1
            x = x[:0]
        self.state.update((count, until, folded, parts, due, x.tobytes()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Every slot that ends by the watermark is folded at the first timer
        of a batch; another finds nothing left."""
        upto = timerValues.getCurrentWatermarkInMs() * 1000 // self.slot
        if self.upto.get(key) == upto:
            return
        self.upto[key] = upto
        count, until, _, parts, _, raw = self.state.get()
        x = np.frombuffer(bytes(raw), dtype=_EVENT)
        slot = x["t"] // self.slot
        kept, ready, slot = x[slot >= upto], x[slot < upto], slot[slot < upto]
        entries = [(at[0], at[1]) for at in self.held.keys()] if parts else []
        later = [at[0] for at in entries if at[0] >= upto] + (kept["t"] // self.slot).tolist()
        entries = sorted(at for at in entries if at[0] < upto)
        for now in sorted({*slot.tolist(), *(at[0] for at in entries)}) if entries else [None] * bool(len(ready)):
            mine = [at for at in entries if at[0] == now]
            x = np.concatenate([ready if now is None else ready[slot == now],
                                *(np.frombuffer(bytes(self.held.getValue(at)[0]), dtype=_EVENT) for at in mine)])
            x = x[np.lexsort((x["id"], x["t"]))]
            table = pa.table([pa.nulls(len(x)), pa.array(x["t"]), pa.array(x["id"]), pa.array(x["f"])],
                             names=["key", "t", "tb", "failed"])
            _, found, (count, until) = self.walk.fold(table, np.zeros(1, np.int64), (count, until))
            for at in mine:
                self.held.removeKey(at)
            trips = np.asarray(found["trip_us"], dtype=np.int64)
            if len(trips):
                yield _rows(key, trips.tolist(), (trips + self.walk.timeout).tolist(), False)
        due = min(later, default=None)
        if due is not None:
            self._timer(due)
        self.state.update((int(count), None if until is None else int(until), int(upto * self.slot),
                           parts if len(later) > len(kept) else 0, due, kept.tobytes()))

    def close(self) -> None:
        pass


def stream_breaker_ordered(events: DataFrame, delay_s: int, threshold: int = FAIL_THRESHOLD,
                           reset_timeout_s: float = RESET_TIMEOUT_SECONDS, slot_s: int | None = None) -> DataFrame:
    """ST4: the breaker of W6 kept online per user over events that come up to
    ``delay_s`` seconds out of order: ``user_id, trip_at, open_until, late``.

    Events are held until the watermark (the latest time seen less the delay)
    has passed their slot of ``slot_s`` seconds (the delay's own length, if not
    given), and are folded in (time, event_id) order. An event in a slot of
    its key that is folded already is not folded but comes out with ``late``
    and its time in ``trip_at``. Events without a time take no part. Events of
    type ``heartbeat`` only move the watermark: one that lies the delay and a
    slot behind the last event brings out all that is held.

    A key's state holds its events of the last delay and slot; a task folds
    ``FEW`` events or one slot at a time. Needs the RocksDB state store (``run_with_timers`` sets it
    for the query)."""
    slot_us = int((slot_s or delay_s) * 1e6)
    beat = F.coalesce(F.col("event_type") == HEARTBEAT, F.lit(False))
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", f"{int(delay_s)} seconds")
    x = timed.where(F.col("ts").isNotNull()).select(
        F.col("user_id").isNotNull().alias("known"), F.coalesce(F.col("user_id").cast("long"), F.lit(0)).alias("user_id"),
        F.unix_micros("ts").alias("t_us"),
        F.coalesce(F.col("event_id").cast("long"), F.lit(-1 << 63)).alias("event_id"),
        F.coalesce(F.col("event_type") == FAILURE_TYPE, F.lit(False)).alias("f"), beat.alias("beat"))
    # a null in a key column would turn the other keys of its batch into floats, so the key has none
    return x.groupBy("known", "user_id").transformWithStateInPandas(
        _HeldBreaker(threshold, int(reset_timeout_s * 1e6), slot_us, FEW), _OUT, "Append", "EventTime")


def run_with_timers(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Append-mode stream with timers → parquet files, over everything
    available. The query gets the state store that timers need; the session's
    own settings are put back once it has started."""
    conf = stream.sparkSession.conf
    before = {k: conf.get(k, None) for k in _STORE}
    for k, v in _STORE.items():
        conf.set(k, v)
    try:
        q = (stream.writeStream.outputMode("append").format("parquet").option("path", out_path)
                   .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    q.awaitTermination()
