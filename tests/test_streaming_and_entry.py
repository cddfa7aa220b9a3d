"""Streaming equals batch; idempotent replay; every registered query runs."""

import os
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from qtrlens.operators import churn as CH
from qtrlens.operators import revenue as RV
from qtrlens.session import scratch_path
from qtrlens.streaming import revenue_stream as ST

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from oracle_check import TABLES, digest  # noqa: E402


def _split_files(spark, df, n):
    path = scratch_path(spark, "t-files")
    for i in range(n):
        df.where(F.abs(F.xxhash64("ClientID", "Date")) % n == i).write.mode("append").parquet(path)
    return path


def test_stream_equals_batch(spark, sample):
    path = _split_files(spark, sample, 4)
    schema = spark.read.parquet(path).schema
    out = scratch_path(spark, "t-st1")
    ST.run_to_table(ST.stream_quarter_region(ST.stream_revenue_files(spark, path, schema)), out,
                    scratch_path(spark, "t-ck1"))
    got = ST.read_latest(spark, out, RV.GEO_KEYS)
    want = RV.aggregate_by_quarter_region(sample)
    norm = lambda d: sorted((r.Quarter, r.Region, r.Country, float(r.TotalRevenue), r.NumRows)
                            for r in d.collect())
    assert norm(got) == norm(want)
    out2 = scratch_path(spark, "t-st3")
    ST.run_to_table(ST.stream_client_quarterly(ST.stream_revenue_files(spark, path, schema)), out2,
                    scratch_path(spark, "t-ck3"))
    c = CH.churn_counts(ST.read_latest(spark, out2, ["ClientID", "Quarter"])).first()
    assert (c.lost_customers, c.new_customers, c.revenue_loss, c.revenue_gain) == (1, 2, 6000.0, 4500.0)


def test_idempotent_replay(spark, sample):
    path = _split_files(spark, sample, 3)
    schema = spark.read.parquet(path).schema
    out, copy = scratch_path(spark, "t-out"), scratch_path(spark, "t-copy")
    for f in sorted(r.path for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path")).distinct().collect()):
        spark.read.schema(schema).parquet(f).coalesce(1).write.mode("append").parquet(copy)
    for p, n in ((path, 1), (path, 2), (copy, 3)):      # replays, other batches, the same content elsewhere
        ST.idempotent_apply(spark, ST.stream_revenue_files(spark, p, schema, max_files_per_trigger=n), out,
                            scratch_path(spark, "t-ck"))
        assert ST.read_applied(spark, out).count() == 23
    more = scratch_path(spark, "t-more")                # a file with other content is new
    sample.limit(1).coalesce(1).write.parquet(more)
    ST.idempotent_apply(spark, ST.stream_revenue_files(spark, more, schema), out, scratch_path(spark, "t-ck"))
    assert ST.read_applied(spark, out).count() == 24


def test_compaction_keeps_the_answer(spark, sample):
    path = _split_files(spark, sample, 4)
    schema = spark.read.parquet(path).schema
    out, ck, base = (scratch_path(spark, f"t-{x}") for x in ("comp", "compck", "base"))
    run = lambda p: ST.run_to_table(ST.stream_quarter_region(ST.stream_revenue_files(spark, p, schema)), out, ck)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    run(path)
    ST.compact(spark, out, RV.GEO_KEYS, base)
    assert rows(ST.read_latest(spark, out, RV.GEO_KEYS, base)) == rows(ST.read_latest(spark, out, RV.GEO_KEYS))
    sample.coalesce(1).write.mode("append").parquet(path)
    run(path)
    after = ST.read_latest(spark, out, RV.GEO_KEYS, base)
    assert rows(after) == rows(ST.read_latest(spark, out, RV.GEO_KEYS))
    assert sum(r.NumRows for r in after.collect()) == 46


def test_online_breaker_order_and_late_events(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 31, 23, 59)
    step = lambda k: t0 + dt.timedelta(seconds=10 * k)
    schema = "event_id long, ts timestamp, user_id long, event_type string"
    src = scratch_path(spark, "t-brk")
    batches = [[(2, step(1), 1, "error"), (1, step(0), 1, "error")], [(3, step(20), 1, "error"), (9, None, 1, "error")],
               [(4, step(5), 1, "view"), (5, step(30), 1, "error")]]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
    out = scratch_path(spark, "t-brk-out")
    ST.run_append_to_parquet(ST.stream_breaker_trips(ST.stream_revenue_files(
        spark, src, spark.read.parquet(src).schema)), out, scratch_path(spark, "t-brk-ck"))
    got = sorted((r.trip_at, r.late) for r in spark.read.parquet(out).collect())
    assert got == [(step(5), True), (step(20), False)]   # over the month's end; the late success is reported


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "lost_customers" in df.columns


OWN = sorted(k for k in E.queries() if E.LLM is None or k not in {*E.LLM.QUERIES, "pipeline"})


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", OWN)
def test_every_query_matches_its_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])[1]
    cur = duck.execute(E.oracle_sql()[key])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == digest(cols, cur.fetchall())[1]


def test_pruned_queries_push_their_dates(spark):
    for key in ("quarter_slice", "align_periods", "top_lost_clients"):
        plan = E.queries()[key](spark, SF)._jdf.queryExecution().toString()
        scans = [x for x in plan.split("Scan parquet") if "o_orderdate" in x[:400]]
        assert "GreaterThanOrEqual(o_orderdate" in plan and scans


def test_permutation_and_partition_invariance(spark):
    rev = E.revenue_view(spark, SF)
    base = sorted(tuple(r) for r in CH.churn_counts(rev).collect())
    shuffled = rev.repartition(7, F.rand(3)).orderBy(F.rand(5))
    assert sorted(tuple(r) for r in CH.churn_counts(shuffled).collect()) == base


def test_reversed_time_swaps_lost_and_new(spark):
    rev = E.revenue_view(spark, SF)
    fwd = {(r.prev_quarter, r.curr_quarter): (r.lost_customers, r.new_customers)
           for r in CH.churn_counts(rev).collect()}
    # mirror the quarter labels: same pairs, opposite order
    mirrored = rev.withColumn("Quarter", F.concat((5000 - F.year("Date")).cast("string"), F.lit("Q"),
                                                  (5 - F.quarter("Date")).cast("string")))
    back = CH.churn_counts(mirrored).collect()
    assert len(back) == len(fwd)
    assert sorted((r.new_customers, r.lost_customers) for r in back) == sorted(fwd.values())
