"""Bitmap sets against plain sets of ids."""

import random

from pyspark.sql import functions as F

from qtrlens.operators import bitmaps as BM
from qtrlens.operators import churn as CH
from qtrlens.operators import revenue as RV
from qtrlens.session import scratch_path
from qtrlens.streaming import revenue_stream as ST

EDGES = [0, 1, -1, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, -32767, -32768, -32769, 2**40, -2**40, 2**62 + 5]


def test_ids_come_back(spark):
    rows = [(g, i) for g in ("a", "b") for i in EDGES + list(range(100, 140))] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows + rows[:20], "g string, id long").withColumn("load", F.pmod(F.hash("id"), F.lit(3)))
    sets = BM.merge_bitmaps(BM.id_bitmaps(df, ["load", "g"], "id"), ["g"])
    got = sorted((r.g, r.id) for r in BM.ids_of(sets, "id").collect())
    assert got == sorted((g, i) for g, i in rows if i is not None)
    n = {r.g: r.ids for r in BM.count_ids(sets, ["g"]).collect()}
    assert n == {"a": len(EDGES) + 40, "b": len(EDGES) + 40, "c": 0}
    assert BM.ids_of(BM.merge_bitmaps(BM.id_bitmaps(df.limit(0), ["g"], "id"), ["g"]), "id").count() == 0


def test_overlaps_are_those_of_sets(spark):
    rng = random.Random(3)
    sets = {f"q{k}": {rng.randrange(-40000, 90000) for _ in range(300)} for k in range(4)}
    sets["q2"] |= set(list(sets["q1"])[:150])
    pairs = [("q0", "q1"), ("q1", "q2"), ("q2", "q3"), ("q3", "q9"), ("q8", "q9")]
    maps = BM.id_bitmaps(spark.createDataFrame([(q, i) for q, ids in sets.items() for i in ids], "Quarter string, id long"),
                         ["Quarter"], "id")
    got = BM.overlap_counts(maps, spark.createDataFrame(pairs, "prev_quarter string, curr_quarter string"))
    want = {(a, b): (len(x - y), len(y - x), len(x & y)) for a, b in pairs
            for x, y in [(sets.get(a, set()), sets.get(b, set()))]}
    assert {(r.prev_quarter, r.curr_quarter): (r.lost, r.new, r.retained) for r in got.collect()} == want


def test_dictionary_grows(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "ClientID string")
    first = BM.id_numbers(ids("b", "a", None, "b"), "ClientID")
    assert sorted(tuple(r) for r in first.collect()) == [("a", 1), ("b", 2)]
    more = sorted(tuple(r) for r in BM.id_numbers(ids("c", "a", "A", None), "ClientID", first).collect())
    assert more == [("A", 3), ("a", 1), ("b", 2), ("c", 4)]
    assert BM.id_numbers(ids("x"), "ClientID", first.limit(0)).first().no == 1


def test_partials_merge_as_with_client_rows(spark, sample):
    numbers = BM.id_numbers(sample, "ClientID")
    rows = sample.join(numbers, "ClientID").withColumn("load", F.month("Date"))
    rows = rows.unionByName(rows.limit(2).withColumn("no", F.lit(None).cast("long")))       # revenue without a client
    got = BM.merge_partial_bitmaps(BM.partial_bitmaps(rows, "no", "load"))
    want = RV.merge_partials(RV.partial_aggregate(rows, "no", load_col="load"), "no")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_stream_state_equals_batch(spark, sample):
    rows = sample.join(BM.id_numbers(sample, "ClientID"), "ClientID")
    path, out = scratch_path(spark, "t-bits"), scratch_path(spark, "t-bits-out")
    rows.repartition(4).write.parquet(path)
    stream = ST.stream_revenue_files(spark, path, spark.read.parquet(path).schema)
    ST.run_to_table(BM.stream_client_bitmaps(stream, "no"), out, scratch_path(spark, "t-bits-ck"))
    got = BM.count_ids(ST.read_latest(spark, out, [*RV.GEO_KEYS, "bucket"]), RV.GEO_KEYS, "NumClients")
    want = RV.with_quarter(rows).groupBy(*RV.GEO_KEYS).agg(F.count_distinct("no"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_churn_by_bitmaps(spark, sample):
    rows = sample.join(BM.id_numbers(sample, "ClientID"), "ClientID")
    cq = RV.active_clients(RV.client_quarterly_long(rows, "no"))
    got = BM.overlap_counts(BM.id_bitmaps(cq, ["Quarter"], "no"), CH.quarter_pairs(rows)).first()
    assert (got.lost, got.new, got.retained) == (1, 2, 3)
