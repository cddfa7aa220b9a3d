"""Dirty-value rules N1–N6 and the two lost/new rules (fixtures F-J, F-K)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qtrlens.functions.columns import coerce_revenue
from qtrlens.operators import churn as CH
from qtrlens.operators import revenue as RV
from qtrlens.operators import validate as VA
from qtrlens.sources.readers import coerce_feed, money, prepare_feed


def test_revenue_coercion_rule(spark):
    vals = ["1", "  2 ", "x", None, "nan", "inf", "1e3", "1d", "1,000", "0x10", "", "true"]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    keep = [r[0] for r in df.select(coerce_revenue("r", keep_inf=True)).collect()]
    assert keep == [1.0, 2.0, 0.0, 0.0, 0.0, float("inf"), 1000.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    plain = [r[0] for r in df.select(coerce_revenue("r")).collect()]
    assert plain[5] == 0.0
    m = [r[0] for r in df.select(money("r")).collect()]
    assert float(m[6]) == 1000.0 and m[5] is None  # inf cannot be money: rejected later


def test_money_is_never_rounded(spark):
    vals = ["0.004", "1.239", "12345678901234567890", "-99999999999999999.99", "1e-3", "1.2500000000000", "1e-11",
            "0.00000000001", "1" * 29, "1e30", "2.5e3"]
    df = spark.createDataFrame([("A", "R", "C", "2024-01-02", v) for v in vals],
                               "ClientID string, Region string, Country string, Date string, Revenue string")
    good, rej = coerce_feed(df)
    from decimal import Decimal
    assert sorted(r.Revenue for r in good.collect()) == sorted(Decimal(v) for v in vals[:6] + vals[10:])
    assert sorted((r.Revenue, r.reason) for r in rej.collect()) == sorted((v, "revenue out of range") for v in vals[6:10])
    # the row contract flags exactly these
    flagged = {r.Revenue for r in VA.check_row_contract(df).collect() if r.violations}
    assert flagged == set(vals[6:10])


def test_one_cent_on_large_totals(spark):
    big = spark.sql("SELECT CAST(1000000000000000.00 AS DECIMAL(18,2)) AS Revenue, DATE '2024-01-02' AS Date, "
                    "'R' AS Region, 'C' AS Country, 1 AS ClientID")
    agg = RV.aggregate_by_quarter_region(big, exact=True)
    assert VA.totals_match(big, agg).first().ok
    off = agg.withColumn("TotalRevenue", (F.col("TotalRevenue") + F.lit("0.01").cast("decimal(18,2)")).cast("decimal(28,2)"))
    r = VA.totals_match(big, off).first()
    assert not r.ok and r.message == "Total mismatch: input=1000000000000000.00 agg=1000000000000000.01"
    assert not VA.validate_quarterly(big, off).first().ok


def test_contract_violation_rows(spark, sample):
    from qtrlens.schemas import CHURN_COUNTS, REVENUE
    counts = CH.churn_counts(sample)
    got = VA.contract_violations({"churn": (counts, CHURN_COUNTS), "feed": (sample.drop("Region"), REVENUE),
                                  "cut": (counts.drop("revenue_gain"), CHURN_COUNTS)})
    assert sorted(tuple(r) for r in got.collect()) == [("cut", "revenue_gain", "missing"), ("feed", "Region", "missing")]


def test_bad_dates_quarantined_or_fatal(spark):
    df = spark.createDataFrame([("A", "R", "C", "2024-01-02", "5"), ("B", "R", "C", "2024/02/03", "6"),
                                ("C", "R", "C", None, "7"), ("D", "R", "C", "2024-13-01", "8")],
                               "ClientID string, Region string, Country string, Date string, Revenue string")
    good, rej = coerce_feed(df)
    assert sorted(r.ClientID for r in good.collect()) == ["A", "B"]
    assert good.where("ClientID = 'B'").first().Date == dt.date(2024, 2, 3)
    assert sorted((r.ClientID, r.reason) for r in rej.collect()) == [("C", "bad date"), ("D", "bad date")]
    strict, _ = coerce_feed(df, on_bad_date="strict")
    with pytest.raises(Exception):
        strict.collect()


def test_null_region_dropped_and_reported(spark):
    df = spark.createDataFrame([("A", "R", "C", "2024-01-02", "5"), ("B", None, "C", "2024-01-03", "7")],
                               "ClientID string, Region string, Country string, Date string, Revenue string")
    good, _ = prepare_feed(df)
    agg = RV.aggregate_by_quarter_region(good)
    assert agg.count() == 1
    v = VA.validate_quarterly(good, agg).first()
    assert not v.ok and v.difference == 7.0
    t = VA.totals_match(good, agg).first()
    assert not t.ok and t.message.startswith("Total mismatch")


def test_two_years_two_labelings(spark):
    df = spark.createDataFrame([("A", "R", "C", "2023-02-01", "1"), ("A", "R", "C", "2024-02-01", "2")],
                               "ClientID string, Region string, Country string, Date string, Revenue string")
    good, _ = prepare_feed(df)
    assert RV.distinct_quarters(good).count() == 2
    assert RV.group_by_quarter(good).count() == 1


def _neg(spark):
    df = spark.createDataFrame([("X", "R", "C", "2024-01-02", "100"), ("X", "R", "C", "2024-04-02", "-20"),
                                ("Y", "R", "C", "2024-01-05", "-5"), ("Y", "R", "C", "2024-04-05", "50")],
                               "ClientID string, Region string, Country string, Date string, Revenue string")
    return prepare_feed(df)[0]


def test_negative_revenue_rules(spark):
    df = _neg(spark)
    core = CH.churn_counts(df, mode=CH.CORE).first()
    assert (core.lost_customers, core.new_customers) == (0, 0)
    tools = CH.churn_counts(df, mode=CH.TOOLS).first()
    assert (tools.lost_customers, tools.new_customers, tools.revenue_loss, tools.revenue_gain) == (1, 1, 100.0, 50.0)
    assert not VA.churn_reconciles(df).first().reconciles


def test_row_contract_split(spark):
    df = spark.createDataFrame([("A", "R", "C", "2024-01-02", "5"), (" ", "R", "C", "bad", "x")],
                               "ClientID string, Region string, Country string, Date string, Revenue string")
    valid, bad = VA.split_valid(df)
    assert valid.count() == 1
    assert bad.first().violations == ["ClientID:required", "Date:invalid", "Revenue:not_a_number"]


def test_output_contract_violations(spark, sample):
    from qtrlens.schemas import CHURN_COUNTS
    ok = VA.check_output_contract(CH.churn_counts(sample), CHURN_COUNTS)
    assert ok == []
    bad = VA.check_output_contract(CH.churn_counts(sample).drop("revenue_gain")
                                   .withColumn("lost_customers", F.lit("x")), CHURN_COUNTS)
    assert ("revenue_gain", "missing") in bad and any(f == "lost_customers" for f, _ in bad)


def test_one_pass_churn_equals_alignment(spark):
    import random
    rnd = random.Random(11)
    rows = []
    quarters = ["2023-01-15", "2023-04-15", "2023-07-15", "2023-10-15", "2024-04-15", "2024-07-15"]
    for c in range(60):
        for d in quarters:
            if rnd.random() < 0.55:
                v = rnd.choice(["100", "0", "-30", "250.5", "40"])
                rows.append((f"C{c:03d}", "R", "X", d, v))
    df = prepare_feed(spark.createDataFrame(
        rows, "ClientID string, Region string, Country string, Date string, Revenue string"))[0]
    for mode in (CH.CORE, CH.TOOLS):
        a = sorted(tuple(r) for r in CH.churn_counts(df, mode).collect())
        b = sorted(tuple(r) for r in CH.churn_counts_aligned(df, mode).select(
            *CH.churn_counts(df, mode).columns).collect())
        assert a == b and len(a) == 5


def test_validation_action_combinations(spark):
    def acts(rows):
        checks = spark.createDataFrame(rows, "check string, ok boolean")
        return [(a.action, a.reason) for a in VA.validation_actions(checks).collect()]
    assert acts([("quarterly", False), ("churn", False)]) == [
        ("retry_aggregation", "sum mismatch"), ("recompute_churn", "reconciliation failed")]
    assert acts([("quarterly", True), ("churn", False)]) == [("recompute_churn", "reconciliation failed")]
    assert acts([("churn", True)]) == [("accept", "all checks passed")]   # missing check counts as ok


def test_sample_is_deterministic_and_exact(spark, sample):
    from qtrlens.operators.revenue import head_rows, sample_rows
    a = [tuple(r) for r in sample_rows(sample, 3, ["ClientID", "Date"]).collect()]
    b = [tuple(r) for r in sample_rows(sample.repartition(5), 3, ["ClientID", "Date"]).collect()]
    assert len(a) == 3 and sorted(a) == sorted(b)
    assert [r.ClientID for r in head_rows(sample, 2, ["Date", "ClientID"]).collect()] == ["C005", "C004"]


def test_content_key_spells_out_nulls(spark):
    import hashlib
    from qtrlens.functions.columns import content_key
    df = spark.createDataFrame([("step", None), ("step", "x")], "a string, b string")
    got = [r[0] for r in df.select(content_key("a", "b")).collect()]
    assert got == [hashlib.sha256(b"step|<null>").hexdigest(), hashlib.sha256(b"step|x").hexdigest()]
