"""The end-to-end report plan on the sample (both paths)."""

from qtrlens.plans.report import revenue_churn_report
from qtrlens.session import scratch_path


def test_report_tools_path(spark, sample):
    out_dir = scratch_path(spark, "t-report")
    r = revenue_churn_report(sample, out_dir=out_dir)
    c = r["churn_report"].first()
    assert (c.lost_customers, c.new_customers, c.revenue_loss, c.revenue_gain) == (1, 2, 6000.0, 4500.0)
    assert [(a.action) for a in r["actions"].collect()] == ["accept"]
    assert r["pivot"].columns == ["ClientID", "2024Q1", "2024Q2"]
    assert r["suggestions"].count() == 0
    assert spark.read.option("header", True).csv(f"{out_dir}/quarterly_by_region").count() == 8


def test_report_core_path(spark, sample):
    r = revenue_churn_report(sample, mode="core", year_blind=True)
    assert sorted(q.Quarter for q in r["quarterly"].select("Quarter").distinct().collect()) == ["Q1", "Q2"]
    c = r["churn_report"].first()
    assert (c.prev_quarter, c.curr_quarter, c.lost_customers, c.new_customers) == ("Q1", "Q2", 1, 2)
    assert all(v.ok for v in r["validations"].collect())


def test_run_metrics_are_observed(spark, sample, tmp_path):
    """The report's own writes count their rows; nothing is read again."""
    from qtrlens.plans.report import revenue_churn_report
    from qtrlens.sources import sinks as SK
    out = revenue_churn_report(sample, out_dir=str(tmp_path / "r"))
    got = {r.step: r["rows"] for r in SK.read_json(spark, str(tmp_path / "r/run_metrics"), "step string, rows long, amount double").collect()}
    assert got == {"quarterly": out["quarterly"].count(), "pivot": out["pivot"].count(), "churn_counts": out["churn_report"].count(),
                   "churn_report": out["churn_lists"].count(), "validations": out["validations"].count()}


def test_bundle_violations(spark):
    from qtrlens.operators import validate as VA
    good = '{"revenue_loss": 1, "revenue_gain": 2.5, "lost_customers": 3, "new_customers": 0}'
    rows = [("plan", "0", '{"step": "load"}'), ("quarterly", "Q1", "[]"), ("pivot", "c", "[1]"), ("churn_report", "a", good),
            ("churn_report", "b", good.replace("3", "3.5")), ("churn_report", "c", good.replace("2.5", '"2.5"')),
            ("churn_report", "d", "{}"), ("churn_report", "e", "oops"), ("churn_report", None, None), ("other", "x", "1")]
    got = [tuple(r) for r in VA.bundle_violations(spark.createDataFrame(rows, "section string, key string, json string")).collect()]
    assert sorted(got, key=str) == sorted(
        [("pivot", "c", None, "not an object"), ("churn_report", "b", "lost_customers", "not an integer"),
         ("churn_report", "c", "revenue_gain", "not a number"), ("churn_report", "e", None, "not JSON"),
         ("churn_report", None, None, "not JSON"), ("validations", None, None, "section is missing")]
        + [("churn_report", "d", f, "missing") for f in VA.CHURN_FIELDS], key=str)


def test_load_index_raises_on_other_trouble(spark, tmp_path):
    from qtrlens.sources import sinks as SK
    spark.range(3).write.parquet(str(tmp_path / "i"))
    import pytest
    with pytest.raises(Exception):
        SK.load_index(spark, str(tmp_path / "i"), "id struct<x:int>").collect()
    assert SK.load_index(spark, str(tmp_path / "none")).count() == 0
