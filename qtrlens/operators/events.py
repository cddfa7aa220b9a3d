"""Run metrics over event tables (A12, A13, A15, A16) and failure tracking
(W5 ``failure_streaks``, W6 ``breaker_trips``).

Counters and gauges are plain hash aggregates (``max_by`` for "latest"), so
hot keys are combined map-side. Streaks use gaps-and-islands over segmented
scans (``ordered.py``), the breaker folds in pieces (``pieces.py``); both split
any key over tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import estimate_tokens
from ..session import cut_lineage
from .pieces import fold_pieces

# ---------------------------------------------------------------- fixed values
FAILURE_TYPE = "error"
FAIL_THRESHOLD = 3
RESET_TIMEOUT_SECONDS = 30
# -----------------------------------------------------------------------------


def _latest(value: str, ts: str = "ts", tiebreak: str = "event_id"):
    return F.max_by(F.col(value), F.struct(F.col(ts), F.col(tiebreak)))


def step_counters(events: DataFrame, name_col: str = "event_type") -> DataFrame:
    """A counter per name (events counted, values summed)."""
    return events.groupBy(name_col).agg(F.count(F.lit(1)).alias("count"),
                                        F.sum("value").alias("total_value"))


def step_timings(events: DataFrame, name_col: str = "event_type") -> DataFrame:
    """Per name, the latest value (gauge) and the count, mean, min and
    max of all values (the timing list, summarised without collecting it)."""
    return events.groupBy(name_col).agg(
        _latest("value").alias("latest_value"),
        F.count("value").alias("n"),
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"))


def step_percentiles(events: DataFrame, name_col: str = "event_type", value_col: str = "value",
                     percents: tuple[int, ...] = (50, 95, 99)) -> DataFrame:
    """Exact percentiles (linear between neighbours) per name. The
    values are ranked by a segmented scan, so no name's values are gathered;
    only the rows beside the asked positions go on."""
    from .ordered import segmented_running_sum

    x = events.where(F.col(value_col).isNotNull()).select(
        F.col(name_col).alias("_name"), F.col(value_col).cast("double").alias("_v"), F.lit(1).cast("long").alias("_one"))
    ranked = segmented_running_sum(x, "_name", ["_v"], "_one", "_rank")
    n = x.groupBy(F.col("_name").alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
    at = [F.lit(p / 100) * (F.col("_n") - 1) for p in percents]
    place = F.col("_rank") - 1
    near = F.lit(False)
    for a in at:
        near = near | (place == F.floor(a)) | (place == F.ceil(a))
    rows = ranked.join(n, F.col("_name").eqNullSafe(F.col("_m"))).where(near)
    out = []
    for p, a in zip(percents, at):
        lo = F.max(F.when(place == F.floor(a), F.col("_v")))
        hi = F.max(F.when(place == F.ceil(a), F.col("_v")))
        part = F.max(a - F.floor(a))
        out.append((lo + (hi - lo) * part).alias(f"p{p}"))
    return rows.groupBy("_name").agg(*out).withColumnRenamed("_name", name_col)


def token_usage(texts: DataFrame, type_col: str = "role", text_col: str = "text") -> DataFrame:
    """Estimated tokens summed by type, with the entry count."""
    return texts.groupBy(type_col).agg(F.sum(estimate_tokens(text_col)).alias("tokens"),
                                       F.count(F.lit(1)).alias("entries"))


def run_log_summary(events: DataFrame, key: str = "user_id", status_col: str = "event_type") -> DataFrame:
    """Per key — last status, attempts, and error count."""
    return events.groupBy(key).agg(
        _latest(status_col).alias("last_status"),
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col(status_col) == FAILURE_TYPE).alias("errors"))


def _islands(events: DataFrame, key: str, ts: str, tb: str, status_col: str) -> DataFrame:
    """Events with ``_f`` (is a failure) and ``island``: the running count of
    successes per key, which numbers the runs of failures between them."""
    from .ordered import segmented_running_sum

    fail = F.coalesce(F.col(status_col) == FAILURE_TYPE, F.lit(False))
    x = events.select(key, ts, tb, fail.alias("_f"), F.when(fail, 0).otherwise(1).cast("long").alias("_s"))
    return segmented_running_sum(x, key, [ts, tb], "_s", "island")


def failure_streaks(events: DataFrame, key: str = "user_id", ts: str = "ts", order_tiebreak: str = "event_id",
                    threshold: int = FAIL_THRESHOLD, status_col: str = "event_type") -> DataFrame:
    """Runs of consecutive failures per key, reset by any success.

    Gaps-and-islands: the running count of successes numbers the islands;
    failures inside one island form one streak. One row per streak with
    ``failures`` and ``tripped`` (``failures >= threshold``). The running
    count is a segmented scan (``ordered.py``), so any key, a null one too,
    is split over tasks by time; the streak aggregate collapses map-side."""
    x = _islands(events, key, ts, order_tiebreak, status_col)
    s = x.where("_f").groupBy(key, "island").agg(
        F.min(ts).alias("streak_start"), F.max(ts).alias("streak_end"), F.count(F.lit(1)).alias("failures"))
    return s.withColumn("tripped", F.col("failures") >= threshold)


def failure_streaks_window(events: DataFrame, key: str = "user_id", ts: str = "ts",
                           order_tiebreak: str = "event_id", threshold: int = FAIL_THRESHOLD,
                           status_col: str = "event_type") -> DataFrame:
    """W5 with one window per key: the cross-check of the tests (a very large
    key is one task's work here)."""
    fail = (F.col(status_col) == FAILURE_TYPE)
    w = Window.partitionBy(key).orderBy(ts, order_tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    x = events.select(key, ts, fail.alias("_f"), F.sum(F.when(fail, 0).otherwise(1).cast("long")).over(w).alias("island"))
    s = x.where("_f").groupBy(key, "island").agg(
        F.min(ts).alias("streak_start"), F.max(ts).alias("streak_end"), F.count(F.lit(1)).alias("failures"))
    return s.withColumn("tripped", F.col("failures") >= threshold)


class _Breaker:
    """The breaker's walk over one key's events (columns: key, time, tiebreak,
    failed). State: the failures counted and, while open, the window's end."""

    fresh = (0, None)
    NONE = -(1 << 63)

    def __init__(self, threshold: int, timeout_us: int):
        self.threshold, self.timeout = threshold, timeout_us

    def _since(self, failed, starts):
        """For each event, where the unbroken failures up to it begin (behind
        the event where it is a success)."""
        at = np.arange(len(failed))
        first = np.zeros(len(failed), dtype=np.int64)
        first[starts] = starts
        return np.maximum.accumulate(np.where(failed, first, at + 1))

    def fold(self, table, starts, state):
        t = table.column(1).to_numpy()
        failed = table.column(3).to_numpy(zero_copy_only=False)
        n, need = len(t), self.threshold
        ends = np.append(starts[1:], n)
        since = self._since(failed, starts)
        carried, until = state
        low = int(np.searchsorted(t[:ends[0]], until, side="right")) if until is not None else 0
        quiet = int(np.argmin(failed[:ends[0]])) if not failed[:ends[0]].all() else int(ends[0])
        streak = np.arange(n) - since + 1
        if until is None and carried:
            streak[:quiet] += carried                 # the first failures go on from the piece before
        able = np.flatnonzero(streak >= need)
        trips, stop, blocked = [], [], []
        k, piece, untouched = 0, 0, until is None
        if until is not None:
            k = int(np.searchsorted(able, low + need - 1))
        while k < len(able):
            j = int(able[k])
            at = int(np.searchsorted(starts, j, side="right")) - 1
            if at != piece:
                piece, low, untouched = at, int(starts[at]), False
            end, close = int(ends[at]), int(t[j]) + self.timeout
            after = j + int(np.searchsorted(t[j:end], t[j], side="right"))
            low = j + int(np.searchsorted(t[j:end], close, side="right"))
            trips.append(j)
            stop.append(close)
            blocked.append(low - after)
            untouched = False
            k = int(np.searchsorted(able, low + need - 1))
        last = len(starts) - 1
        spill = [u if j >= starts[last] and u >= t[-1] else None for j, u in zip(trips, stop)]
        if spill and spill[-1] is not None:
            end_state = (0, spill[-1])
        elif until is not None and last == 0 and until >= t[-1]:
            end_state = (0, until)
        else:
            begin = max(int(since[-1]), low if piece == last else int(starts[last]))
            whole = last == 0 and untouched and quiet == n
            end_state = (n - begin + (carried if whole else 0), None)
        return np.array(trips, np.int64), {"trip_us": t[trips], "blocked": blocked, "spill_us": spill}, end_state

    def transition(self, table):
        """End states for each count a closed key may come with, and for each
        event that may be the first behind an open window."""
        t = table.column(1).to_numpy()
        failed = table.column(3).to_numpy(zero_copy_only=False)
        n, need = len(t), self.threshold
        since = self._since(failed, np.zeros(1, np.int64))
        able = np.append(np.flatnonzero(np.arange(n) - since + 1 >= need), n)
        trip = able[np.searchsorted(able[:-1], np.arange(n) + need - 1)]
        none = trip == n
        close = np.where(none, self.NONE, t[np.minimum(trip, n - 1)] + self.timeout)
        after = np.where(none, n, np.searchsorted(t, close, side="right"))
        root = np.where(after == n, np.arange(n), after)         # start again from there, until the end
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
        count = np.where(none, n - np.maximum(since[-1], np.arange(n)), 0)[root]
        opened = close[root]
        quiet = int(np.argmin(failed)) if not failed.all() else n
        closed = []
        for c in range(need):
            if need - c <= quiet:
                u = int(t[need - c - 1]) + self.timeout
                x = int(np.searchsorted(t, u, side="right"))
                closed.append((0, u) if x == n else (count[x], opened[x]))
            else:
                closed.append((c + n, self.NONE) if quiet == n else (count[quiet], opened[quiet]))
        most = min(n - 1, int(np.searchsorted(t, t[0] + self.timeout, side="right")))
        count, opened = count[:most + 1], opened[:most + 1]
        new = np.flatnonzero((np.diff(count) != 0) | (np.diff(opened) != 0)) + 1
        pick = np.append(0, new)
        head = np.array([len(pick), t[-1]], dtype=np.int64)
        return np.concatenate([head, np.array(closed, dtype=np.int64).reshape(-1), t[new - 1], count[pick],
                               opened[pick]]).astype(np.int64).tobytes()

    def step(self, note, state):
        a = np.frombuffer(note, dtype=np.int64)
        size, last = int(a[0]), int(a[1])
        closed, rest = a[2:2 + 2 * self.threshold], a[2 + 2 * self.threshold:]
        count, until = state
        if until is None:
            count, until = closed[2 * count], closed[2 * count + 1]
        elif until >= last:
            return (0, until)
        else:
            at = int(np.searchsorted(rest[:size - 1], until, side="right"))
            count, until = rest[size - 1 + at], rest[2 * size - 1 + at]
        return int(count), None if until == self.NONE else int(until)


def breaker_trips(events: DataFrame, key: str = "user_id", ts: str = "ts", order_tiebreak: str = "event_id",
                  threshold: int = FAIL_THRESHOLD, reset_timeout_s: float = RESET_TIMEOUT_SECONDS,
                  status_col: str = "event_type") -> DataFrame:
    """Circuit-breaker trips per key. Failures count up; at ``threshold``
    the key opens until ``ts + reset_timeout``; events while open are ignored
    (counted as ``blocked_events``: those after the trip's time and up to the
    window's end); after the timeout the count restarts at zero; any success
    resets it. Events without a time cannot be ordered and take no part.

    The walk is folded in pieces (``pieces.py``): the events are sorted once
    over range partitions, and a key that fails on and on is spread over as
    many tasks as hold it. A window that reaches past its piece counts the
    events of the pieces it reaches into."""
    timeout_us = int(reset_timeout_s * 1e6)
    failed = F.coalesce(F.col(status_col) == FAILURE_TYPE, F.lit(False))
    walk = events.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(order_tiebreak).alias("tb"),
        failed.alias("failed"))
    new = [T.StructField(c, T.LongType()) for c in ("trip_us", "blocked", "spill_us")]
    found, passed = fold_pieces(walk, ["t", "tb"], _Breaker(threshold, timeout_us), new, "breaker")
    trips = cut_lineage(found.select("_p", "key", "trip_us", "blocked", "spill_us"), events.sparkSession, "trips")
    spills = trips.where("spill_us is not null").select(F.col("_p").alias("from"), F.col("key").alias("k"), "trip_us", "spill_us")
    later = spills.join(passed.select(F.col("_p").alias("at"), "key", "t"), F.col("key").eqNullSafe(F.col("k"))
                        & (F.col("at") > F.col("from")) & (F.col("t") > F.col("trip_us")) & (F.col("t") <= F.col("spill_us"))) \
        .groupBy("from", F.col("trip_us").alias("u")).agg(F.count(F.lit(1)).alias("more"))
    until = F.col("trip_us") + F.lit(timeout_us)
    return (trips.join(later, F.col("spill_us").isNotNull() & (F.col("_p") == F.col("from")) & (F.col("trip_us") == F.col("u")), "left")
            .select(F.col("key").alias(key), F.timestamp_micros("trip_us").alias("trip_at"),
                    F.timestamp_micros(until).alias("open_until"),
                    (F.col("blocked") + F.coalesce("more", F.lit(0).cast("long"))).alias("blocked_events")))


def open_keys(trips: DataFrame, as_of, key: str = "user_id") -> DataFrame:
    """Keys whose latest trip is still open at ``as_of``."""
    last = trips.groupBy(key).agg(F.max("open_until").alias("open_until"))
    return last.where(F.col("open_until") >= F.lit(as_of).cast("timestamp"))
