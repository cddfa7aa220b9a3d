"""The online breaker with timers: any order within the delay gives the batch answer."""

import datetime as dt
import random

from qtrlens.operators import events as EV
from qtrlens.session import scratch_path
from qtrlens.streaming import breaker as BR
from qtrlens.streaming import revenue_stream as ST

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"
T0 = dt.datetime(2024, 1, 31, 23, 50)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def run(spark, loads, delay, slot=None):
    src, out, ck = (scratch_path(spark, f"t-held-{x}") for x in ("src", "out", "ck"))
    for rows in loads:
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(src)
        stream = ST.stream_revenue_files(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=None)
        BR.run_with_timers(BR.stream_breaker_ordered(stream, delay, slot_s=slot), out, ck)
    return sorted(((r.user_id, r.trip_at, r.open_until, r.late) for r in spark.read.parquet(out).collect()), key=str)


def test_any_order_within_the_delay(spark):
    rng = random.Random(5)
    events = [(i, at(rng.randrange(900)), rng.choice([1, 2**60 + 1, None]), rng.choice(["error", "error", "view"])) for i in range(500)]
    events += [(900 + i, at(100), 1, "error") for i in range(4)]            # ties by time
    arrival = sorted(events, key=lambda e: (e[1] + dt.timedelta(seconds=rng.randrange(120)), e[0]))
    beat = (0, at(1200), None, BR.HEARTBEAT)
    loads = [arrival[:100], [*arrival[100:300], (999, None, 1, "error")], [*arrival[300:], beat]]
    want = sorted(((r.user_id, r.trip_at, r.open_until, False)
                   for r in EV.breaker_trips(spark.createDataFrame(events, SCHEMA)).collect()), key=str)
    assert len(want) > 10
    assert run(spark, loads, 120, slot=30) == want
    assert run(spark, [[*arrival, beat]], 120) == want                      # all at once, other slots


def test_few_state_calls_and_large_keys(spark, monkeypatch):
    """A batch writes one value a key, however many slots its events lie in;
    a key with many events keeps them by slot, with the same trips."""
    class Store(dict):
        calls = 0

        def updateValue(self, k, v):
            Store.calls += 1
            self[k] = v

    class Handle:
        def __init__(self):
            self.map, self.value, self.timers = Store(), None, []

        def registerTimer(self, ms):
            Store.calls += 1
            self.timers.append(ms)

        def getMapState(self, *_):
            return self.map

        def getValueState(self, *_):
            return self

        def get(self):
            return self.value

        def update(self, v):
            Store.calls += 1
            self.value = v

    import pandas as pd
    handle, held = Handle(), BR._HeldBreaker(3, 30_000_000, 60_000_000, 100)
    held.init(handle)
    rows = pd.DataFrame({"t_us": [i * 60_000_000 for i in range(90)], "event_id": range(90), "f": [True] * 90, "beat": [False] * 90})
    assert list(held.handleInputRows((True, 1), iter([rows]), None)) == [] and Store.calls == 2 and not handle.map
    list(held.handleInputRows((True, 1), iter([rows]), None))
    assert len(handle.map) == 90 and handle.timers == [60_000]

    rng = random.Random(6)
    events = [(i, at(rng.randrange(900)), rng.choice([1, 2, None]), rng.choice(["error", "error", "view"])) for i in range(300)]
    want = sorted(((r.user_id, r.trip_at, r.open_until, False)
                   for r in EV.breaker_trips(spark.createDataFrame(events, SCHEMA)).collect()), key=str)
    arrival = sorted(events, key=lambda e: (e[1] + dt.timedelta(seconds=rng.randrange(120)), e[0]))
    loads = [arrival[:100], arrival[100:200], [*arrival[200:], (0, at(1200), None, BR.HEARTBEAT)]]
    monkeypatch.setattr(BR, "FEW", 8)
    assert len(want) > 5 and run(spark, loads, 120, slot=30) == want


def test_behind_the_watermark_is_reported(spark):
    loads = [[(1, at(0), 1, "error"), (2, at(1), 1, "error"), (3, at(500), 2, "view")],     # watermark at 440 s
             [(4, at(2), 1, "error"), (5, at(470), 1, "error"), (6, at(450), 2, "view")],
             [(7, at(460), 1, "error"), (0, at(2000), None, BR.HEARTBEAT)]]
    # the key is folded past 2 s by then; 460 s comes after 470 s but within the delay
    assert run(spark, loads, 60) == sorted([(1, at(2), None, True), (1, at(460), at(490), False)], key=str)


def test_provider_setting_is_put_back(spark):
    before = spark.conf.get(BR._PROVIDER)
    assert run(spark, [[(1, at(0), 1, "view"), (0, at(900), None, BR.HEARTBEAT)]], 60) == []
    assert spark.conf.get(BR._PROVIDER) == before
