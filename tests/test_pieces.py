"""Folds in pieces against the plain walk over all rows."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qtrlens.operators import events as EV
from qtrlens.operators import text as TX
from qtrlens.operators.pieces import key_starts


def walk_breaker(rows, threshold, timeout):
    """Trips ``(time, blocked)`` of one key's sorted ``(t, failed)``."""
    trips, count, until = [], 0, None
    for t, failed in rows:
        if until is not None:
            if t <= until:
                continue
            until, count = None, 0
        count = count + 1 if failed else 0
        if count >= threshold:
            until = t + timeout
            trips.append(t)
    return [(t, sum(1 for x, _ in rows if t < x <= t + timeout)) for t in trips]


def walk_packing(tokens, room):
    chunk, cur, out = -1, 1 << 60, []
    for t in tokens:
        if cur + t > room:
            chunk, cur = chunk + 1, t
        else:
            cur += t
        out.append(chunk)
    return out


def table(*cols):
    return pa.table({f"c{i}": c for i, c in enumerate(cols)})


def pieces_of(n, rnd):
    cuts = sorted(rnd.sample(range(1, n), min(n - 1, rnd.randint(0, 6)))) if n > 1 else []
    return list(zip([0, *cuts], [*cuts, n]))


@pytest.mark.parametrize("threshold", [1, 2, 3, 5])
def test_breaker_pieces(threshold):
    rnd = random.Random(threshold)
    for _ in range(400):
        n, timeout, likely = rnd.randint(1, 60), rnd.choice([0, 1, 3, 10, 40]), rnd.choice([0.3, 0.7, 0.95, 1])
        t = np.cumsum([rnd.choice([0, 1, 1, 2, 7]) for _ in range(n)])
        failed = [rnd.random() < likely for _ in range(n)]
        m = EV._Breaker(threshold, timeout)
        state, got = m.fresh, []
        for a, b in pieces_of(n, rnd):
            piece = table(["k"] * (b - a), t[a:b], list(range(a, b)), failed[a:b])
            rows, new, end = m.fold(piece, np.zeros(1, np.int64), state)
            got += [int(x) for x in new["trip_us"]]
            assert m.step(m.transition(piece), state) == end
            state = end
        assert got == [x for x, _ in walk_breaker(list(zip(t.tolist(), failed)), threshold, timeout)]


def test_breaker_keys_in_one_table():
    rnd = random.Random(8)
    for _ in range(100):
        keys = [[(t, rnd.random() < 0.8) for t in sorted(rnd.randint(0, 60) for _ in range(rnd.randint(1, 30)))] for _ in range(4)]
        flat = table([k for k, r in enumerate(keys) for _ in r], [t for r in keys for t, _ in r],
                     [0] * sum(map(len, keys)), [f for r in keys for _, f in r])
        _, new, _ = EV._Breaker(3, 10).fold(flat, key_starts(flat.column(0)), (0, None))
        assert list(zip(new["trip_us"], new["blocked"])) == [x for r in keys for x in walk_breaker(r, 3, 10)]


def test_packing_pieces():
    rnd = random.Random(5)
    for _ in range(600):
        n, room = rnd.randint(1, 50), rnd.choice([1, 5, 20, 1000])
        tokens = [rnd.randint(0 if rnd.random() < 0.1 else 1, rnd.choice([3, 30])) for _ in range(n)]
        m = TX._Packing(room, 0)
        state, got = m.fresh, []
        for a, b in pieces_of(n, rnd):
            piece = table(["k"] * (b - a), tokens[a:b])
            _, new, end = m.fold(piece, np.zeros(1, np.int64), state)
            got += new["chunk_no"].tolist()
            assert m.step(m.transition(piece), state) == end
            state = end
        assert got == walk_packing(tokens, room)


@pytest.fixture
def many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", before)


def parts_of(df, key):
    """Tasks that hold rows of ``key`` in the sorted range partitions."""
    return df.where(F.col("key").eqNullSafe(F.lit(key))).select("_p").distinct().count()


def test_one_unbroken_key_over_many_tasks(many_parts):
    """A key that fails every second without a gap, beside small keys."""
    spark = many_parts
    rnd = random.Random(6)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [("hot", s, rnd.random() < 0.97) for s in range(6000)]
    rows += [(k, rnd.randint(0, 6000), rnd.random() < 0.8) for k in ("a", "z", None) for _ in range(300)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(k, start + timedelta(seconds=s), i, "error" if f else "ok") for i, (k, s, f) in enumerate(rows)],
                               "user_id string, ts timestamp, event_id long, event_type string")
    got = {}
    for r in EV.breaker_trips(df).collect():
        got.setdefault(r.user_id, []).append((r.trip_at.timestamp(), r.blocked_events))
    for k in ("hot", "a", "z", None):
        mine = sorted((start.timestamp() + s, i, f) for i, (key, s, f) in enumerate(rows) if key == k)
        assert sorted(got.get(k, [])) == walk_breaker([(t, f) for t, _, f in mine], 3, 30)
    walk = df.select(F.col("user_id").alias("key"), F.unix_micros("ts").alias("t"), F.col("event_id").alias("tb"),
                     (F.col("event_type") == "error").alias("failed"))
    _, passed = EV.fold_pieces(walk, ["t", "tb"], EV._Breaker(3, 30_000_000),
                               [EV.T.StructField(c, EV.T.LongType()) for c in ("trip_us", "blocked", "spill_us")])
    assert parts_of(passed, "hot") >= 8


def test_one_long_conversation_over_many_tasks(many_parts):
    spark = many_parts
    rnd = random.Random(7)
    rows = [(1, i, "x" * rnd.randint(0, 400)) for i in range(5000)] + [(2, 0, None), (None, 3, "y"), (None, None, "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(4)
    out = TX.pack_by_token_budget(df, "tttt", 300).collect()
    tokens = [max(1, len(t) // 4) for k, _, t in rows if k == 1]
    want = walk_packing(tokens, 299)
    per = {}
    for c, t in zip(want, tokens):
        per[c] = per.get(c, 0) + t
    assert {r.chunk_no: r.text_tokens for r in out if r.conv_id == 1} == per
    assert sorted((str(r.conv_id), r.chunk_no, r.n_texts) for r in out if r.conv_id != 1) == [("2", 0, 1), ("None", 0, 2)]
    narrow = df.select(F.col("conv_id").alias("key"), F.lit(1).alias("tok"), "turn")
    _, passed = TX.fold_pieces(narrow, ["turn"], TX._Packing(10, 0), [TX.T.StructField("chunk_no", TX.T.IntegerType())])
    assert parts_of(passed, 1) >= 8
