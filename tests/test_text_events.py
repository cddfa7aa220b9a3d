"""Text index, budgets, packing and event metrics (fixtures F-F, F-G)."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qtrlens.functions.columns import hash_bucket, normalize_vector
from qtrlens.operators import events as EV
from qtrlens.operators import text as TX
from qtrlens.session import scratch_path
from qtrlens.sources import sinks as SK


def _docs(spark, rows):
    return spark.createDataFrame(rows, "id string, text string")


def test_index_ranking_dim16(spark):
    idx = TX.embed_text(_docs(spark, [("a", "top selling product region east"),
                                      ("b", "low selling product region west")]), "id", "text", 16)
    q = _docs(spark, [("q", "selling product east")])
    top = TX.query_index(idx, q, k=1, dim=16).collect()
    assert [r.id for r in top] == ["a"] and 0 < top[0].score <= 1


def test_index_persist_dim8(spark):
    idx = TX.embed_text(_docs(spark, [("k1", "important note about client churn")]), "id", "text", 8)
    p = scratch_path(spark, "t-idx8")
    SK.save_index(idx, p)
    back = spark.read.parquet(p)
    for i in (idx, back):
        assert TX.query_index(i, _docs(spark, [("q", "client churn")]), k=1, dim=8).first().id == "k1"


def test_upsert_replace_and_append(spark):
    old = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [1.0, 0.0])], "id string, vec array<double>")
    new = spark.createDataFrame([("a", [1.0, 0.0], 1), ("a", [0.6, 0.8], 2)], "id string, vec array<double>, seq int")
    got = {r.id: (r.vec, r.seq) for r in TX.upsert_index(old, new, order="seq").collect()}
    assert got == {"a": ([0.6, 0.8], 2), "b": ([1.0, 0.0], None)}      # the later row of one id replaces
    assert TX.upsert_index(old, new, replace=False).count() == 4


def test_topk_when_few_overlap(spark):
    idx = TX.embed_text(_docs(spark, [("a", "alpha"), ("b", "beta"), ("c", "gamma"), ("d", "?!")]), "id", "text", 64)
    top = TX.query_index(idx, _docs(spark, [("q", "gamma"), ("none", "...")]), k=3).collect()
    by = {}
    for r in sorted(top, key=lambda r: r.rank):
        by.setdefault(r.qid, []).append((r.id, r.score))
    assert [i for i, _ in by["q"]] == ["c", "a", "b"] and [x for _, x in by["q"]][1:] == [0.0, 0.0]
    assert by["none"] == [("a", 0.0), ("b", 0.0), ("c", 0.0)]           # a query without a token ranks by id


def test_topk_negative_scores(spark):
    idx = spark.createDataFrame([(1, [1.0, 0.0], "east"), (2, [-1.0, 0.0], "west"), (3, [-0.5, 0.8660254], None), (4, None, "?")],
                                "id long, vec array<double>, text string")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "id string, vec array<double>")
    got = [(r.id, r.score, r.text) for r in TX.topk_similar(idx, q, k=3).orderBy("rank").collect()]
    assert got == [(1, 1.0, "east"), (3, -0.5, None), (2, -1.0, "west")]
    assert TX.topk_similar(idx, q.limit(0), k=3).collect() == []
    pairs = {r.id: r.score for r in TX.similarity_pairs(idx, q, min_score=-0.6).collect()}
    assert pairs == {1: 1.0, 3: -0.5}


def test_topk_over_blocks_and_batches(spark, monkeypatch):
    """Many queries in small blocks over many small score cells, with ties."""
    import numpy as np
    from qtrlens.operators import shares as SH
    monkeypatch.setattr(SH, "QUERY_BLOCK", 7)
    monkeypatch.setattr(SH, "SHARE_ROWS", 50)
    rng = np.random.default_rng(1)
    e = rng.integers(-2, 3, (300, 4)).astype(float)
    q = rng.integers(-2, 3, (20, 4)).astype(float)
    idx = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "id long, vec array<double>").repartition(5)
    qs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, vec array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {(r.qid, r["rank"]): (r.id, r.score) for r in TX.topk_similar(idx, qs, k=4).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in range(20):
        s = e @ q[k]
        want = sorted(range(300), key=lambda i: (-s[i], i))[:4]
        assert [got[k, r + 1] for r in range(4)] == [(i, s[i]) for i in want]


def test_search_is_one_scan_off_the_driver(spark, monkeypatch, tmp_path):
    """Three blocks of queries, entries scanned once; query rows that share an
    id are answered one by one."""
    from qtrlens.operators import shares as SH
    monkeypatch.setattr(SH, "QUERY_BLOCK", 2)
    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", lambda *a, **k: pytest.fail("through the driver"))
    spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "id long, vec array<double>") \
        .write.parquet(f"{tmp_path}/e")
    index = spark.read.parquet(f"{tmp_path}/e")
    qs = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [-1.0, 0.0]), ("b", [0.0, 1.0]), (None, [1.0, 0.0]),
                                ("n", None)], "id string, vec array<double>")
    df = TX.topk_similar(index, qs, k=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Final Plan")[0].count("entries-") == 1
    got = sorted((str(r.qid), r["rank"], r.id) for r in df.collect())
    assert got == sorted([("a", 1, 29), ("a", 2, 28), ("a", 1, 0), ("a", 2, 1), ("b", 1, 0), ("b", 2, 1),
                          ("None", 1, 29), ("None", 2, 28)])


def test_cells_equal_the_full_search(spark, monkeypatch, tmp_path):
    """Clustered and scattered entries, zero vectors, ties, split cells; far
    clusters are not visited."""
    import numpy as np
    from qtrlens.operators import cells as CE
    from qtrlens.operators import shares as SH
    monkeypatch.setattr(SH, "SHARE_ROWS", 60)
    rng = np.random.default_rng(3)
    near = np.repeat(np.eye(8), 100, axis=0) + rng.normal(0, 0.05, (800, 8))
    rows = np.vstack([near, rng.normal(0, 1, (20, 8)), np.repeat(near[:1], 7, axis=0)])
    rows = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    rows = [(i, v.tolist(), f"t{i}") for i, v in enumerate(rows)] + [(900, [0.0] * 8, "zero"), (901, None, "none")]
    index = spark.createDataFrame(rows, "id long, vec array<double>, text string").repartition(3)
    q = spark.createDataFrame([(i, v) for i, v, _ in rows[::37]] + [(5, [0.0] * 8), (5, rows[5][1]), (None, [-2.0] + [0.0] * 7), (7, None)],
                              "id long, vec array<double>")
    path, log = CE.save_cells(index, str(tmp_path / "cells"), cells=8), []
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    got = CE.topk_cells(spark, path, q, 5, log)
    want = TX.topk_similar(index, q, 5)
    assert got.columns == want.columns and key(got) == key(want)
    assert sum(log) < 0.5 * (len(rows) - 1) * (q.count() - 1)
    empty = CE.save_cells(index.limit(0), str(tmp_path / "none"))
    assert CE.topk_cells(spark, empty, q).collect() == []


def test_token_budget(spark):
    df = _docs(spark, [("x", "x" * 100)])
    r = TX.token_budget_gate(df, "text", max_response_tokens=20, budget=10).first()
    assert r.tokens == 25 and not r.within_budget


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcxyzé_0123456789", min_size=1, max_size=12), min_size=1, max_size=20),
       st.sampled_from([8, 16, 64, 10, 100]))
def test_hash_bucket_matches_md5(spark, toks, dim):
    got = [r[0] for r in spark.createDataFrame([(t,) for t in toks], "t string")
           .select(hash_bucket("t", dim)).collect()]
    assert got == [int(hashlib.md5(t.encode()).hexdigest(), 16) % dim for t in toks]


def test_tokenize_unicode(spark):
    from qtrlens.functions.columns import tokenize
    text = "Étion dans, ÇA_va 42!"
    got = spark.createDataFrame([(text,)], "t string").select(tokenize("t")).first()[0]
    assert got == re.findall(r"\w+", text.lower())


def test_normalize_vector(spark):
    df = spark.createDataFrame([([3.0, float("nan"), 4.0],), ([0.0, 0.0],)], "v array<double>")
    out = [r[0] for r in df.select(normalize_vector("v")).collect()]
    assert out[0] == [0.6, 0.0, 0.8] and out[1] == [0.0, 0.0]


def _py_summary(texts, max_chars):
    s = " | ".join(texts[-50:])
    if len(s) > max_chars:
        s = s[:max_chars].rsplit(" ", 1)[0]
    return s


def test_recent_notes_summary(spark):
    notes = [(1, i, f"note number {i} " + "w" * (i % 7)) for i in range(80)] + [(2, 0, "x" * 300)]
    df = spark.createDataFrame(notes, "conv_id long, turn long, text string")
    got = {r.conv_id: r.summary for r in TX.recent_notes_summary(df, max_chars=200).collect()}
    assert got[1] == _py_summary([t for _, _, t in notes[:80]], 200)
    assert got[2] == "x" * 200


def _py_pack(texts, template, limit):
    est = lambda t: max(1, len(t) // 4)
    chunks, cur, cur_t = [], [], 0
    for t in texts:
        if cur and cur_t + est(t) + est(template) > limit:
            chunks.append(cur)
            cur, cur_t = [t], est(t)
        else:
            cur.append(t)
            cur_t += est(t)
    if cur:
        chunks.append(cur)
    return [template + "\n\n" + "\n".join(c) for c in chunks]


def test_pack_matches_loop(spark):
    texts = ["a" * n for n in (40, 400, 10, 10, 2000, 30, 60, 60, 60)]
    df = spark.createDataFrame([(7, i, t) for i, t in enumerate(texts)], "conv_id long, turn long, text string")
    got = [r.prompt for r in TX.pack_by_token_budget(df, "Pack these:", 120).orderBy("chunk_no").collect()]
    assert got == _py_pack(texts, "Pack these:", 120)


def test_pack_repeated_and_null_turns(spark):
    rows = [("g", 1, "b" * 40), ("g", 1, "a" * 40), ("g", None, "c" * 400), (None, 2, "d"), (None, None, None), ("h", 1, "e")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, text string")
    got = {(r.conv_id, r.chunk_no): r.prompt for r in TX.pack_by_token_budget(df, "T", 60).collect()}
    assert got == {("g", 0): "T\n\n" + "c" * 400, ("g", 1): "T\n\n" + "a" * 40 + "\n" + "b" * 40,
                   (None, 0): "T\n\n\nd", ("h", 0): "T\n\ne"}


def test_event_metrics_and_breaker(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    seq = ["error", "error", "error", "error", "view", "error", "error", "view", "error", "error", "error"]
    ev = spark.createDataFrame(
        [(i, t0 + dt.timedelta(seconds=10 * i), 1, e, float(i), "{}") for i, e in enumerate(seq)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    streaks = sorted((r.failures, r.tripped) for r in EV.failure_streaks(ev).collect())
    assert streaks == [(2, False), (3, True), (4, True)]
    trips = EV.breaker_trips(ev, reset_timeout_s=15).orderBy("trip_at").collect()
    # trips at the 3rd error (t=20s) and, after the timeout, the 3rd error of the last run (t=100s)
    assert [r.trip_at for r in trips] == [t0 + dt.timedelta(seconds=20), t0 + dt.timedelta(seconds=100)]
    s = EV.run_log_summary(ev).first()
    assert (s.last_status, s.attempts, s.errors) == ("error", 11, 9)
    c = {r.event_type: r["count"] for r in EV.step_counters(ev).collect()}
    assert c == {"error": 9, "view": 2}


def test_streaks_hot_key_matches_window_and_loop(spark):
    import datetime as dt
    import random
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows, eid = [], 0
    # user 1 holds about half of all events; it is split over many partitions
    for user, n in ((1, 3000), (2, 400), (3, 700), (4, 900)):
        for i in range(n):
            rows.append((eid, t0 + dt.timedelta(seconds=i), user,
                         "error" if rnd.random() < 0.6 else "view", 1.0, "{}"))
            eid += 1
    rnd.shuffle(rows)
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                     "value double, props string")
    from qtrlens.operators.ordered import segmented_running_sum
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = sorted((r.user_id, r.failures, r.streak_start)
                     for r in EV.failure_streaks(ev).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = sorted((r.user_id, r.failures, r.streak_start) for r in EV.failure_streaks_window(ev).collect())
    assert got == want
    # brute force over the rows
    by_user = {}
    for e in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        by_user.setdefault(e[2], []).append(e[3] == "error")
    n_streaks = sum(sum(1 for i, f in enumerate(fs) if f and (i == 0 or not fs[i - 1])) for fs in by_user.values())
    assert len(got) == n_streaks
    x = ev.select("user_id", "ts", "event_id", F.lit(1).cast("long").alias("one"))
    rn = segmented_running_sum(x, "user_id", ["ts", "event_id"], "one", "rn")
    per = {}
    for r in rn.collect():
        per.setdefault(r.user_id, []).append((r.ts, r.rn))
    for u, v in per.items():
        assert [b for _, b in sorted(v)] == list(range(1, len(v) + 1))


def _loop_trips(rows, threshold=3, timeout=30):
    import datetime as dt
    out, state = [], {}
    for eid, t, user, kind, _, _ in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[2]), r[1], r[0])):
        count, opened = state.get(user, (0, None))
        if opened is not None:
            if t <= opened:
                continue
            count, opened = 0, None
        if kind == "error":
            count += 1
            if count >= threshold:
                opened = t + dt.timedelta(seconds=timeout)
                out.append((user, t, opened))
        else:
            count = 0
        state[user] = (count, opened)
    return [(u, t, o, sum(1 for r in rows if r[2] == u and r[1] is not None and t < r[1] <= o)) for u, t, o in out]


def test_breaker_matches_loop(spark):
    """A key with most events, a null key, dense alternation, an unbroken
    stretch of failures, events without a time, ties in time."""
    import datetime as dt
    import random
    rnd = random.Random(3)
    rows, eid = [], 0
    t0 = dt.datetime(2024, 1, 30)
    for user, n, share in ((1, 2500, 0.7), (2, 300, 0.5), (None, 400, 0.7), (4, 600, None), (5, 300, 1.0)):
        t = t0
        for i in range(n):
            t += dt.timedelta(seconds=rnd.choice([0, 1, 2, 5, 20, 40]))
            bad = i % 2 == 0 if share is None else rnd.random() < share
            rows.append((eid, t if rnd.random() > 0.01 else None, user, "error" if bad else "view", 1.0, "{}"))
            eid += 1
    rnd.shuffle(rows)
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                     "value double, props string")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        got = sorted((tuple(r) for r in EV.breaker_trips(ev).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == sorted(_loop_trips(rows), key=str) and len(got) > 50


def test_percentiles(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    data = {"a": rng.normal(size=501), "b": rng.integers(0, 5, 40).astype(float), "c": np.array([7.0])}
    df = spark.createDataFrame([(k, float(x)) for k, v in data.items() for x in v] + [("a", None)],
                               "event_type string, value double")
    for r in EV.step_percentiles(df).collect():
        want = np.percentile(data[r.event_type], [50, 95, 99])
        assert np.allclose([r.p50, r.p95, r.p99], want)


def test_open_keys(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    trips = spark.createDataFrame([(1, t0, t0 + dt.timedelta(seconds=30), 0),
                                   (2, t0, t0 + dt.timedelta(seconds=5), 0)],
                                  "user_id long, trip_at timestamp, open_until timestamp, blocked_events long")
    got = [r.user_id for r in EV.open_keys(trips, t0 + dt.timedelta(seconds=10)).collect()]
    assert got == [1]


def test_searches_over_the_fixed_queries(spark):
    """The rows whose id is divisible by 50 against all rows, by brute force."""
    import numpy as np

    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    m = np.array([r.embedding for r in rows], dtype="float64")
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    got = {}
    for r in E.queries()["topk_similar_rows"](spark, sf).orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.id)
    want = {}
    for k in np.flatnonzero(ids % 50 == 0):
        score = np.round(m @ m[k], 6)
        want[int(ids[k])] = [int(ids[x]) for x in np.lexsort((ids, -score))[:5]]
    assert got == want
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id") % 50 == 0)
    asked = {r.qid for r in E.queries()["query_index_rows"](spark, sf).select("qid").collect()}
    assert asked == {r.doc_id for r in docs.select("doc_id").collect()}
