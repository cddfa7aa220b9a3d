"""Golden values on the 23-row sample (end-to-end, as the reference tests)."""

import pytest
from pyspark.sql import functions as F

from qtrlens.operators import churn as CH
from qtrlens.operators import revenue as RV
from qtrlens.operators import validate as VA


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_aggregate_total_equals_input(sample):
    agg = RV.aggregate_by_quarter_region(sample)
    total = agg.agg(F.sum("TotalRevenue")).first()[0]
    assert total == 25750
    assert RV.total_revenue(sample).first()["total_revenue"] == 25750


def test_quarter_region_golden(sample):
    agg = RV.aggregate_by_quarter_region(sample)
    assert rows(agg, "Quarter", "Region", "Country", "TotalRevenue", "NumRows") == [
        ("2024Q1", "APAC", "AU", 600.0, 2), ("2024Q1", "Americas", "US", 3300.0, 3),
        ("2024Q1", "EMEA", "DE", 4200.0, 3), ("2024Q1", "EMEA", "UK", 6000.0, 3),
        ("2024Q2", "APAC", "AU", 1000.0, 2), ("2024Q2", "APAC", "IN", 2000.0, 3),
        ("2024Q2", "Americas", "US", 5350.0, 4), ("2024Q2", "EMEA", "DE", 3300.0, 3)]
    g = RV.group_by_quarter(sample, year_blind=False)
    assert dict(((r.Quarter, r.Country), r.NumClients) for r in g.collect())[("2024Q2", "US")] == 2


def test_client_pivot_golden(sample):
    p = RV.client_quarterly_revenue(sample)
    assert p.columns == ["ClientID", "2024Q1", "2024Q2"]
    assert rows(p, "ClientID", "2024Q1", "2024Q2") == [
        ("C001", 3300, 2850), ("C002", 6000, 0), ("C003", 0, 2000),
        ("C004", 4200, 3300), ("C005", 600, 1000), ("C006", 0, 2500)]


def test_churn_counts_golden(sample):
    c = CH.churn_counts(sample).first()
    assert (c.prev_quarter, c.curr_quarter) == ("2024Q1", "2024Q2")
    assert (c.lost_customers, c.new_customers) == (1, 2)
    assert (c.revenue_loss, c.revenue_gain) == (6000.0, 4500.0)
    assert (c.total_prev_revenue, c.total_curr_revenue) == (14100.0, 11650.0)


def test_churn_lists_and_rows(sample):
    lists = CH.churn_lists(sample).collect()
    lost = sorted(x for r in lists for x in r.lost_customers)
    new = sorted(x for r in lists for x in r.new_customers)
    assert lost == ["C002"] and new == ["C003", "C006"]
    assert sum(r.revenue_loss for r in lists) == 6000 and sum(r.revenue_gain for r in lists) == 4500
    cr = CH.churn_rows(sample)
    assert rows(cr, "ClientID", "status", "amount") == [
        ("C002", "lost", 6000.0), ("C003", "new", 2000.0), ("C006", "new", 2500.0)]


def test_flags_and_suggestions(sample):
    f = CH.churn_flags(CH.churn_counts(sample, mode=CH.TOOLS)).first()
    assert (f.pair, f.net_change, f.note) == ("2024Q1->2024Q2", -1500.0, "stable")
    assert CH.retention_suggestions(CH.churn_flags(CH.churn_counts(sample))).count() == 0


def test_year_blind_quarters(sample):
    q = RV.group_by_quarter(sample)  # Qn labels
    assert sorted({r.Quarter for r in q.collect()}) == ["Q1", "Q2"]


def test_validations_pass(sample):
    assert VA.totals_match(sample, RV.aggregate_by_quarter_region(sample)).first().ok
    assert all(r.reconciles for r in VA.churn_reconciles(sample).collect())
    assert VA.churn_sane(CH.churn_counts(sample)).first().ok
    checks = VA.check_result("quarterly", VA.validate_quarterly(sample, RV.group_by_quarter(sample)))
    acts = VA.validation_actions(checks).collect()
    assert [(a.action, a.reason) for a in acts] == [("accept", "all checks passed")]


def test_top_lost_and_pairs(sample):
    t = CH.top_lost_clients(sample, "2024Q1", "2024Q2", n=10).collect()
    assert [(r.ClientID, r.prev_revenue) for r in t] == [("C002", 6000.0)]
    import pytest
    with pytest.raises(ValueError):
        CH.top_lost_clients(sample, "2024Q1", "2030Q1")
    assert rows(CH.quarter_pairs(sample), "prev_quarter", "curr_quarter") == [("2024Q1", "2024Q2")]


def test_set_forms_agree(sample):
    assert rows(CH.lost_clients(sample), "ClientID") == [("C002",)]
    assert rows(CH.new_clients(sample), "ClientID") == [("C003",), ("C006",)]
    assert rows(CH.retained_clients(sample), "ClientID") == [("C001",), ("C004",), ("C005",)]
    assert rows(CH.lost_by_except(sample), "ClientID") == [("C002",)]
    a = CH.churn_amounts(sample).first()
    assert (a.revenue_loss, a.revenue_gain) == (6000.0, 4500.0)
    assert CH.active_in_either(sample).count() == 6


def test_top_regions_and_trend(sample):
    t = RV.top_regions_per_quarter(RV.aggregate_by_quarter_region(sample), n=2)
    assert rows(t, "Quarter", "Country", "rank") == [
        ("2024Q1", "DE", 2), ("2024Q1", "UK", 1), ("2024Q2", "DE", 2), ("2024Q2", "US", 1)]
    tr = CH.churn_trend_data(CH.churn_counts(sample))
    assert rows(tr, "type", "amount") == [("revenue_gain", 4500.0), ("revenue_loss", 6000.0)]


def test_pivot_raises_on_a_quarter_outside_its_labels(sample):
    """No revenue falls out of the pivot without a word."""
    full = RV.client_quarterly_revenue(sample, ["2024Q1", "2024Q2", "2024Q3"]).collect()
    assert sum(r["2024Q1"] + r["2024Q2"] + r["2024Q3"] for r in full) == 25750
    with pytest.raises(Exception, match="outside the pivot's labels: 2024Q2"):
        RV.client_quarterly_revenue(sample, ["2024Q1"]).collect()
