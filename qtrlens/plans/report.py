"""End-to-end revenue and churn report: the whole reference run as one Spark
plan over a revenue feed.

The client × quarter table (A3) is the input of every churn output, the pivot
and the reconciliation check, so it is written once to the shared checkpoint
folder and read back: all of those read a table of one row per client-quarter
instead of re-running the scan and join of the raw feed, and a lost executor
does not send them back to the raw data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import churn as CH
from ..operators import revenue as RV
from ..operators import validate as VA
from ..session import cut_lineage
from ..sources import sinks as SK


def revenue_churn_report(feed: DataFrame, mode: str = CH.TOOLS, year_blind: bool = False,
                         out_dir: str | None = None, client_col: str = "ClientID") -> dict[str, DataFrame]:
    """Quarterly aggregate, client pivot, churn (counts and id lists),
    validations, actions, flags and suggestions for a long revenue feed.

    ``mode`` picks the lost/new rule and ``year_blind`` the quarter labels
    (``Qn`` for the core path's seasonal view, ``YYYYQn`` otherwise). With
    ``out_dir`` the tables are also written: quarterly and pivot as CSV,
    churn counts, churn report and validations as JSON, and beside them
    ``run_metrics``: each output's rows and amount, observed as it was written.
    """
    spark = feed.sparkSession
    rq = RV.with_quarter(feed, year_blind=year_blind)
    cq = CH.stored_client_quarters(rq, client_col)
    quarterly = (RV.group_by_quarter(rq, year_blind=year_blind, client_col=client_col, exact=True) if year_blind
                 else RV.aggregate_by_quarter_region(rq, exact=True))
    quarterly = cut_lineage(quarterly, spark, "quarterly")   # small; read by the checks and the outputs
    labels = RV.quarter_labels(cq)                      # bounded by the calendar
    pivot = RV.client_quarterly_revenue(cq, labels, client_col)
    counts = CH.churn_counts(cq, mode, client_col)
    lists = CH.churn_lists(cq, mode, client_col)
    checks = (VA.check_result("quarterly", VA.validate_quarterly(feed, quarterly))
              .unionByName(VA.check_result("churn", VA.churn_reconciles(cq, client_col), "reconciles")))
    flags = CH.churn_flags(counts)
    quarterly = quarterly.withColumn("TotalRevenue", F.col("TotalRevenue").cast("double"))
    out = {
        "quarterly": quarterly, "pivot": pivot, "churn_report": counts, "churn_lists": lists,
        "validations": checks, "actions": VA.validation_actions(checks), "reflections": flags,
        "suggestions": CH.retention_suggestions(flags),
    }
    if out_dir:
        base, run = out_dir.rstrip("/"), SK.RunMetrics(spark)
        SK.write_csv(run.watch(quarterly, "quarterly", F.col("TotalRevenue")), f"{base}/quarterly_by_region")
        SK.write_csv(run.watch(pivot, "pivot"), f"{base}/client_quarterly_revenue")
        SK.write_json(run.watch(counts, "churn_counts", F.col("lost_customers") + F.col("new_customers")), f"{base}/churn_counts")
        SK.write_json(run.watch(lists, "churn_report"), f"{base}/churn_report")
        SK.write_json(run.watch(checks, "validations", F.col("ok").cast("int")), f"{base}/validations")
        run.write(f"{base}/run_metrics")
    return out
