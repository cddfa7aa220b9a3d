"""Wide layout, header repair, chunking and sinks (fixtures F-B, S1–S13)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qtrlens.schemas import INDEX_ENTRY
from qtrlens.session import scratch_path
from qtrlens.sources import chunks as CK
from qtrlens.sources import readers as RD
from qtrlens.sources import sinks as SK


def test_wide_to_long(spark):
    df = spark.createDataFrame([("C1", "USA", "AMER", 100, 0, "7"), ("C2", "IND", "APAC", 0, 200, None)],
                               "`Customer Name` string, Country string, Region string, "
                               "`2024-01-01` int, `2024-02-01` int, `2024/03/01` string")
    long = RD.normalize_wide(df)
    assert long.columns == ["Client ID", "Country", "Region", "Date", "Revenue"]
    got = {(r["Client ID"], r.Date): r.Revenue for r in long.collect()}
    assert len(got) == 6
    assert got[("C1", dt.date(2024, 1, 1))] == 100.0
    assert got[("C1", dt.date(2024, 3, 1))] == 7.0 and got[("C2", dt.date(2024, 3, 1))] == 0.0


def test_header_repair(spark):
    df = spark.createDataFrame([(1, "x")], "` Client Id ` int, `Re-gion` string")
    out = RD.resolve_client_column(RD.normalize_columns(df))
    assert out.columns == ["ClientID", "Region"]
    with pytest.raises(ValueError):
        RD.normalize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `ab` int"))
    assert RD.resolve_client_column(spark.createDataFrame([(1,)], "client_code int")).columns == ["ClientID"]
    assert RD.detect_date_columns(["a", "2024-01-01", "2024/02/01", "2024-1-1"]) == ["2024-01-01", "2024/02/01"]


def test_missing_quarter_and_date_raises(spark):
    from qtrlens.operators.revenue import client_quarterly_long
    with pytest.raises(ValueError):
        client_quarterly_long(spark.createDataFrame([("a", 1.0)], "ClientID string, Revenue double"))


def test_chunk_rows_matches_positions(spark):
    df = spark.range(0, 2345).select((F.col("id") * 11 % 2345).alias("k"), F.lit(1.5).alias("Revenue"))
    ch = CK.chunk_rows(df, ["k"], chunk_size=100)
    got = sorted((r.k, r.row_idx, r.chunk_id) for r in ch.collect())
    assert got == [(i, i, i // 100) for i in range(2345)]
    s = CK.chunk_summaries(df, ["k"], chunk_size=1000).orderBy("chunk_id").collect()
    assert [r.rows for r in s] == [1000, 1000, 345]
    assert CK.num_chunks(CK.chunk_summaries(df, ["k"], 1000)).first().num_chunks == 3


def test_csv_json_round_trip(spark, sample):
    p = scratch_path(spark, "t-csv")
    SK.write_csv(sample, p)
    back, rej = RD.read_revenue_csv(spark, p)
    assert back.count() == 23 and rej.count() == 0
    pj = scratch_path(spark, "t-json")
    arr = spark.createDataFrame([("p", ["a", "b"])], "pair string, ids array<string>")
    SK.write_json(arr, pj)
    assert SK.read_json(spark, pj, arr.schema).first().ids == ["a", "b"]


def test_index_save_load_and_missing(spark):
    p = scratch_path(spark, "t-index")
    idx = spark.createDataFrame([("k1", "t", [1.0, 0.0], {"step": "x"})], INDEX_ENTRY)
    SK.save_index(idx, p)
    assert SK.load_index(spark, p).first().id == "k1"
    assert SK.load_index(spark, scratch_path(spark, "nothing-here")).count() == 0


def test_latest_per_key_and_versions(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "key string, ts int, v string")
    got = {r.key: r.v for r in SK.latest_per_key(df, ["key"], "ts").collect()}
    assert got == {"a": "new", "b": "only"}
    base = scratch_path(spark, "t-summ")
    p1 = SK.save_summaries(df, base, "1")
    assert spark.read.parquet(p1).count() == 2
    with pytest.raises(Exception):
        SK.save_summaries(df, base, "1")


def test_export_bundle(spark, sample):
    from qtrlens.operators import churn as CH
    from qtrlens.operators import revenue as RV
    from qtrlens.operators import validate as VA
    from qtrlens.schemas import BUNDLE_REQUIRED
    agg = RV.group_by_quarter(sample)
    checks = VA.check_result("quarterly", VA.validate_quarterly(sample, agg))
    b = SK.export_bundle(["load", "churn"], agg, RV.client_quarterly_revenue(sample), CH.churn_counts(sample), checks)
    assert sorted({r.section for r in b.collect()}) == sorted(BUNDLE_REQUIRED)
    assert SK.missing_sections(b) == [] and SK.missing_sections(b.where("section <> 'plan'")) == ["plan"]


def test_csv_by_header_name_and_bad_rows(spark, tmp_path):
    d = tmp_path / "feed"
    d.mkdir()
    (d / "a.csv").write_text('ClientID,Region,Country,Date,Revenue\nA,"North\nWest, old",US,2024-01-02,10.5\n'
                             'B,"say ""hi""",US,2024-01-03,1\nC,EMEA,UK,2024-01-04,2,surplus\nD,EMEA\n')
    (d / "b.csv").write_text('Revenue,Date,Client Id,Country,Region,Note\n7,2024-02-01,E,IN,APAC,x\n')
    (d / "empty.csv").write_text("ClientID,Region,Country,Date,Revenue\n")
    good, rej = RD.read_revenue_csv(spark, str(d))
    got = sorted((r.ClientID, r.Region, r.Country, float(r.Revenue)) for r in good.collect())
    assert got == [("A", "North\nWest, old", "US", 10.5), ("B", 'say "hi"', "US", 1.0), ("E", "APAC", "IN", 7.0)]
    bad = sorted((r._corrupt, r.reason) for r in rej.collect())
    assert bad == [("C,EMEA,UK,2024-01-04,2,surplus", "malformed row"), ("D,EMEA", "malformed row")]


def test_wide_timestamp_headers(spark):
    df = spark.createDataFrame([("C1", "USA", "AMER", 100, 5)], "`Customer Name` string, Country string, Region string, "
                                                                "`2024-01-01 00:00:00` int, `2024-02-01T00:00` int")
    got = sorted((r.Date, r.Revenue) for r in RD.normalize_wide(df).collect())
    assert got == [(dt.date(2024, 1, 1), 100.0), (dt.date(2024, 2, 1), 5.0)]


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark):
    from types import SimpleNamespace
    from qtrlens.session import checkpoint_dir
    for master, fails in (("spark://host:7077", True), ("local-cluster[2,1,1024]", True), ("yarn", True)):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
        with pytest.raises(ValueError):
            checkpoint_dir(fake)


def test_wide_client_name_alias(spark):
    df = spark.createDataFrame([("K1", "DE", "EMEA", "5")], "`Client Name` string, Country string, "
                                                           "Region string, `2024-05-01` string")
    r = RD.normalize_wide(df).first()
    assert (r["Client ID"], r.Date, r.Revenue) == ("K1", dt.date(2024, 5, 1), 5.0)
    # no date headers: returned unchanged
    plain = spark.createDataFrame([("a", 1)], "x string, y int")
    assert RD.normalize_wide(plain).columns == ["x", "y"]
