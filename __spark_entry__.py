"""

Every query reads the given parquet tables (or data Spark derives from them)
in full. Money columns are summed exactly as decimals and returned as double
on both sides so the two engines' decimal precisions do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrlens.functions import columns as FN
from qtrlens.operators import bitmaps as BM
from qtrlens.operators import cells as CE
from qtrlens.operators import churn as CH
from qtrlens.operators import events as EV
from qtrlens.operators import revenue as RV
from qtrlens.operators import text as TX
from qtrlens.operators import validate as VA
from qtrlens.session import apply_conf, cut_lineage, scratch_path
from qtrlens.sources import chunks as CK
from qtrlens.sources import readers as RD
from qtrlens.sources import sinks as SK
from qtrlens.sources import versioned_index as VI
from qtrlens.sources.tables import REVENUE_VIEW_SQL, client_quarter_view, load, revenue_view

try:                                     # the corpus operators are optional
    import corpus_pipeline
    from qtrlens.llm import queries as LLM
except ImportError:
    LLM = None

SMOKE_DIR = "/root/testdata/sf0.001"

# quarter used by the single-pair / single-quarter operators (a parameter of
# those operators, not a row filter for cost)
PAIR = ("1995Q1", "1995Q2")
SLICE_Q = "1997Q2"
# the columns of the registered pivot: all quarters of the order dates' range
PIVOT_QUARTERS = [f"{y}Q{q}" for y in range(1992, 2003) for q in range(1, 5)]


def _rev(spark: SparkSession, d: str) -> DataFrame:
    apply_conf(spark)
    return revenue_view(spark, d)


def _cq(spark: SparkSession, d: str) -> DataFrame:
    """Client × quarter revenue aggregated before the customer join; the
    input of every churn operator (they only read client, quarter, revenue)."""
    apply_conf(spark)
    return client_quarter_view(spark, d)


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _dirty_rev(spark: SparkSession, d: str) -> DataFrame:
    """Revenue view with a null Region wherever the order priority is 5-LOW
    (a data-derived way to exercise the null-key rules on every row)."""
    rev = revenue_view(spark, d, keep=("o_orderpriority",))
    region = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("Region"))
    return rev.withColumn("Region", region).drop("o_orderpriority")


def _refunds(spark: SparkSession, d: str) -> DataFrame:
    """The revenue view with urgent orders counted as refunds."""
    rev = revenue_view(spark, d, keep=("o_orderpriority",))
    sign = F.when(F.col("o_orderpriority") == "1-URGENT", -F.col("Revenue")).otherwise(F.col("Revenue"))
    return rev.withColumn("Revenue", sign.cast("decimal(18,2)")).drop("o_orderpriority")


def _rules_differ(feed: DataFrame) -> DataFrame:
    """Pairs where the core and the tools rule count different clients."""
    al = CH.period_compare(feed)
    (cl, cn), (tl, tn) = CH.churn_predicates(CH.CORE), CH.churn_predicates(CH.TOOLS)
    g = al.groupBy("prev_quarter", "curr_quarter").agg(
        F.count_if(cl).alias("core_lost"), F.count_if(tl).alias("tools_lost"),
        F.count_if(cn).alias("core_new"), F.count_if(tn).alias("tools_new"))
    return g.where("core_lost <> tools_lost OR core_new <> tools_new")


# ----------------------------------------------------------------- oracle SQL
_REV = "WITH" + REVENUE_VIEW_SQL
_REVQ = _REV + """,
revq AS (SELECT *, concat(CAST(year(Date) AS VARCHAR), 'Q', CAST(quarter(Date) AS VARCHAR)) AS Quarter FROM rev)"""
_CQ = _REVQ + """,
cq AS (SELECT ClientID, Quarter, SUM(Revenue) AS Revenue FROM revq GROUP BY ClientID, Quarter),
qs AS (SELECT Quarter, row_number() OVER (ORDER BY Quarter) AS qi FROM (SELECT DISTINCT Quarter FROM cq) t),
pairs AS (SELECT a.Quarter AS prev_quarter, b.Quarter AS curr_quarter, a.qi - 1 AS pair_index
          FROM qs a JOIN qs b ON b.qi = a.qi + 1),
al AS (SELECT p.prev_quarter, p.curr_quarter, c.ClientID,
              COALESCE(SUM(CASE WHEN c.Quarter = p.prev_quarter THEN c.Revenue END), 0) AS prev_revenue,
              COALESCE(SUM(CASE WHEN c.Quarter = p.curr_quarter THEN c.Revenue END), 0) AS curr_revenue
       FROM pairs p JOIN cq c ON c.Quarter = p.prev_quarter OR c.Quarter = p.curr_quarter
       GROUP BY p.prev_quarter, p.curr_quarter, c.ClientID),
act AS (SELECT ClientID, Quarter FROM cq WHERE Revenue > 0),
as_prev AS (SELECT a.ClientID, p.prev_quarter, p.curr_quarter FROM act a JOIN pairs p ON a.Quarter = p.prev_quarter),
as_curr AS (SELECT a.ClientID, p.prev_quarter, p.curr_quarter FROM act a JOIN pairs p ON a.Quarter = p.curr_quarter)"""

_COUNTS_SELECT = """
SELECT prev_quarter, curr_quarter,
       count_if(prev_revenue > 0 AND curr_revenue = 0) AS lost_customers,
       count_if(prev_revenue = 0 AND curr_revenue > 0) AS new_customers,
       CAST(COALESCE(SUM(CASE WHEN prev_revenue > 0 AND curr_revenue = 0 THEN prev_revenue END), 0) AS DOUBLE) AS revenue_loss,
       CAST(COALESCE(SUM(CASE WHEN prev_revenue = 0 AND curr_revenue > 0 THEN curr_revenue END), 0) AS DOUBLE) AS revenue_gain,
       CAST(SUM(prev_revenue) AS DOUBLE) AS total_prev_revenue,
       CAST(SUM(curr_revenue) AS DOUBLE) AS total_curr_revenue
FROM al GROUP BY prev_quarter, curr_quarter"""

_TOOLS_LOST = "prev_revenue > 0 AND NOT (curr_revenue > 0)"
_TOOLS_NEW = "curr_revenue > 0 AND NOT (prev_revenue > 0)"


def _churn_counts(s, d):
    return CH.churn_counts(_cq(s, d))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: customers and revenue lost and gained between consecutive
    quarters, over the revenue view of the smallest test tables."""
    return _churn_counts(spark, SMOKE_DIR)


def _batch_registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    q: dict[str, tuple[Callable, str | None]] = {}

    # ---- J6 / S3: the revenue view itself
    q["star_join"] = (
        lambda s, d: _dbl(_rev(s, d), "Revenue"),
        _REV + "\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue FROM rev")

    # ---- A9 flagship and its tools-rule twin
    q["churn_counts"] = (_churn_counts, _CQ + _COUNTS_SELECT)
    q["churn_counts_tools"] = (
        lambda s, d: CH.churn_counts(_cq(s, d), mode=CH.TOOLS),
        _CQ + _COUNTS_SELECT.replace("prev_revenue > 0 AND curr_revenue = 0", _TOOLS_LOST)
                            .replace("prev_revenue = 0 AND curr_revenue > 0", _TOOLS_NEW))

    # ---- A1–A8, F1–F3
    q["aggregate_by_quarter_region"] = (
        lambda s, d: RV.aggregate_by_quarter_region(_cq(s, d), rows_col="NumRows"),
        _REVQ + """
SELECT Quarter, Region, Country, CAST(COALESCE(SUM(Revenue), 0) AS DOUBLE) AS TotalRevenue,
       COUNT(Revenue) AS NumRows
FROM revq WHERE Quarter IS NOT NULL AND Region IS NOT NULL AND Country IS NOT NULL
GROUP BY Quarter, Region, Country""")
    q["group_by_quarter"] = (
        lambda s, d: RV.group_by_quarter(client_quarter_view(s, d, year_blind=True)),
        _REV + """
SELECT 'Q' || CAST(quarter(Date) AS VARCHAR) AS Quarter, Region, Country,
       CAST(COALESCE(SUM(Revenue), 0) AS DOUBLE) AS TotalRevenue, COUNT(DISTINCT ClientID) AS NumClients
FROM rev WHERE Date IS NOT NULL AND Region IS NOT NULL AND Country IS NOT NULL
GROUP BY 1, Region, Country""")
    q["client_quarterly_long"] = (
        lambda s, d: _dbl(RV.client_quarterly_long(_cq(s, d)), "Revenue"),
        _CQ + "\nSELECT ClientID, Quarter, CAST(Revenue AS DOUBLE) AS Revenue FROM cq")
    q["client_quarterly_revenue"] = (
        lambda s, d: RV.client_quarterly_revenue(_cq(s, d), PIVOT_QUARTERS),
        _CQ + "\nSELECT ClientID, " + ", ".join(
            f"CAST(COALESCE(SUM(CASE WHEN Quarter = '{q}' THEN Revenue END), 0) AS DOUBLE) AS \"{q}\""
            for q in PIVOT_QUARTERS) + " FROM cq GROUP BY ClientID")
    q["total_revenue"] = (
        lambda s, d: RV.total_revenue(_rev(s, d)),
        _REV + "\nSELECT CAST(COALESCE(SUM(Revenue), 0) AS DOUBLE) AS total_revenue, COUNT(*) AS num_rows FROM rev")
    q["quarterly_totals"] = (
        lambda s, d: RV.quarterly_totals(RV.aggregate_by_quarter_region(_cq(s, d), rows_col="NumRows")),
        _REVQ + "\nSELECT Quarter, CAST(SUM(Revenue) AS DOUBLE) AS TotalRevenue FROM revq GROUP BY Quarter")
    q["merge_partials"] = (
        # partials are stored per load (here: per order year) in one pass, then merged
        lambda s, d: RV.merge_partials(cut_lineage(
            RV.partial_aggregate(_loads(s, d), load_col="load"), s, "partials")),
        _REVQ + """
SELECT Quarter, Region, Country, CAST(SUM(Revenue) AS DOUBLE) AS TotalRevenue,
       COUNT(DISTINCT ClientID) AS NumClients
FROM revq GROUP BY Quarter, Region, Country""")
    q["distinct_quarters"] = (
        lambda s, d: RV.distinct_quarters(_rev(s, d)),
        _REVQ + "\nSELECT DISTINCT Quarter FROM revq")
    q["drop_null_keys"] = (
        lambda s, d: RV.aggregate_by_quarter_region(_dirty_rev(s, d)),
        _REV.replace("r.r_name AS Region", "CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE r.r_name END AS Region")
        + """
SELECT concat(CAST(year(Date) AS VARCHAR), 'Q', CAST(quarter(Date) AS VARCHAR)) AS Quarter, Region, Country,
       CAST(SUM(Revenue) AS DOUBLE) AS TotalRevenue, COUNT(Revenue) AS NumRows
FROM rev WHERE Region IS NOT NULL GROUP BY 1, Region, Country""")
    q["active_clients"] = (
        lambda s, d: _dbl(RV.active_clients(RV.client_quarterly_long(_cq(s, d))), "Revenue"),
        _CQ + "\nSELECT ClientID, Quarter, CAST(Revenue AS DOUBLE) AS Revenue FROM cq WHERE Revenue > 0")
    q["quarter_slice"] = (
        lambda s, d: _dbl(RV.quarter_slice(revenue_view(s, d, quarters=[SLICE_Q]), SLICE_Q), "Revenue"),
        _REVQ + f"\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue, Quarter "
                f"FROM revq WHERE Quarter = '{SLICE_Q}'")

    # ---- W2, T3
    q["top_regions_per_quarter"] = (
        lambda s, d: RV.top_regions_per_quarter(RV.aggregate_by_quarter_region(_cq(s, d), rows_col="NumRows")),
        _REVQ + """,
agg AS (SELECT Quarter, Region, Country, CAST(SUM(Revenue) AS DOUBLE) AS TotalRevenue, COUNT(Revenue) AS NumRows
        FROM revq GROUP BY Quarter, Region, Country)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Quarter ORDER BY TotalRevenue DESC, Region, Country) AS rank
               FROM agg) t WHERE rank <= 5""")
    q["head_rows"] = (
        lambda s, d: _dbl(RV.head_rows(_rev(s, d), 20, ["Date", "ClientID", "Revenue"]), "Revenue"),
        _REV + "\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue FROM rev "
               "ORDER BY Date, ClientID, Revenue LIMIT 20")
    q["sample_rows"] = (
        lambda s, d: _dbl(RV.sample_rows(_rev(s, d), 3, ["ClientID", "Date", "Revenue"]), "Revenue"),
        _REV + "\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue FROM rev "
               "ORDER BY md5(concat_ws('|', ClientID, Date, Revenue, '42')), ClientID, Date, Revenue LIMIT 3")

    # ---- J1–J5, W1, A10, A11, T1, U1–U3
    q["quarter_pairs"] = (
        lambda s, d: CH.quarter_pairs(_cq(s, d)),
        _CQ + "\nSELECT pair_index, prev_quarter, curr_quarter FROM pairs")
    q["period_compare"] = (
        lambda s, d: _dbl(CH.period_compare(_cq(s, d)), "prev_revenue", "curr_revenue"),
        _CQ + "\nSELECT ClientID, prev_quarter, curr_quarter, CAST(prev_revenue AS DOUBLE) AS prev_revenue, "
              "CAST(curr_revenue AS DOUBLE) AS curr_revenue FROM al")
    q["align_periods"] = (
        lambda s, d: _dbl(CH.align_periods(revenue_view(s, d, quarters=PAIR), *PAIR), "prev_revenue", "curr_revenue"),
        _CQ + f"""
SELECT COALESCE(a.ClientID, b.ClientID) AS ClientID, CAST(COALESCE(a.Revenue, 0) AS DOUBLE) AS prev_revenue,
       CAST(COALESCE(b.Revenue, 0) AS DOUBLE) AS curr_revenue
FROM (SELECT * FROM cq WHERE Quarter = '{PAIR[0]}') a FULL JOIN (SELECT * FROM cq WHERE Quarter = '{PAIR[1]}') b
  ON a.ClientID = b.ClientID""")
    q["churn_rows"] = (
        lambda s, d: CH.churn_rows(_cq(s, d)),
        _CQ + f"""
SELECT prev_quarter, curr_quarter, ClientID,
       CASE WHEN {_TOOLS_LOST} THEN 'lost' ELSE 'new' END AS status,
       CAST(CASE WHEN {_TOOLS_LOST} THEN prev_revenue ELSE curr_revenue END AS DOUBLE) AS amount
FROM al WHERE ({_TOOLS_LOST}) OR ({_TOOLS_NEW})""")
    q["churn_lists"] = (
        lambda s, d: CH.churn_lists(_cq(s, d)),
        _CQ + f""",
hits AS (SELECT *, (row_number() OVER (PARTITION BY prev_quarter, curr_quarter ORDER BY ClientID) - 1) // {CH.PAGE_ROWS} AS page
         FROM al WHERE ({_TOOLS_LOST}) OR ({_TOOLS_NEW})),
pg AS (SELECT prev_quarter, curr_quarter, page,
              COALESCE(list_sort(list(ClientID) FILTER (WHERE {_TOOLS_LOST})), []) AS lost_customers,
              COALESCE(list_sort(list(ClientID) FILTER (WHERE {_TOOLS_NEW})), []) AS new_customers,
              count_if({_TOOLS_LOST}) AS num_lost, count_if({_TOOLS_NEW}) AS num_new,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS DOUBLE) AS revenue_loss,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) AS DOUBLE) AS revenue_gain
       FROM hits GROUP BY 1, 2, 3)
SELECT p.prev_quarter AS q_prev, p.curr_quarter AS q_curr, pg.page,
       COALESCE(pg.lost_customers, []) AS lost_customers, COALESCE(pg.new_customers, []) AS new_customers,
       COALESCE(pg.num_lost, 0) AS num_lost, COALESCE(pg.num_new, 0) AS num_new,
       COALESCE(pg.revenue_loss, 0.0) AS revenue_loss, COALESCE(pg.revenue_gain, 0.0) AS revenue_gain
FROM pairs p LEFT JOIN pg ON p.prev_quarter = pg.prev_quarter AND p.curr_quarter = pg.curr_quarter""")
    q["top_lost_clients"] = (
        lambda s, d: CH.top_lost_clients(revenue_view(s, d, quarters=PAIR), *PAIR, n=10),
        _CQ + f"""
SELECT a.ClientID, CAST(a.Revenue AS DOUBLE) AS prev_revenue
FROM (SELECT * FROM cq WHERE Quarter = '{PAIR[0]}') a
LEFT JOIN (SELECT * FROM cq WHERE Quarter = '{PAIR[1]}') b ON a.ClientID = b.ClientID
WHERE a.Revenue > 0 AND COALESCE(b.Revenue, 0) = 0
ORDER BY a.Revenue DESC, a.ClientID LIMIT 10""")
    q["top_lost_clients_all_pairs"] = (
        lambda s, d: CH.top_lost_clients_all_pairs(_cq(s, d), n=10),
        _CQ + """
SELECT prev_quarter, curr_quarter, rank, ClientID, CAST(prev_revenue AS DOUBLE) AS prev_revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY prev_quarter, curr_quarter ORDER BY prev_revenue DESC, ClientID) AS rank
  FROM al WHERE prev_revenue > 0 AND curr_revenue = 0) t WHERE rank <= 10""")
    q["lost_clients"] = (
        lambda s, d: CH.lost_clients(_cq(s, d)),
        _CQ + "\nSELECT * FROM as_prev EXCEPT ALL SELECT * FROM as_curr")
    q["new_clients"] = (
        lambda s, d: CH.new_clients(_cq(s, d)),
        _CQ + "\nSELECT * FROM as_curr EXCEPT ALL SELECT * FROM as_prev")
    q["retained_clients"] = (
        lambda s, d: CH.retained_clients(_cq(s, d)),
        _CQ + "\nSELECT * FROM as_prev INTERSECT ALL SELECT * FROM as_curr")
    q["churn_amounts"] = (
        lambda s, d: CH.churn_amounts(_cq(s, d)),
        _CQ + f"""
SELECT prev_quarter, curr_quarter,
       CAST(COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS DOUBLE) AS revenue_loss,
       CAST(COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) AS DOUBLE) AS revenue_gain
FROM al GROUP BY prev_quarter, curr_quarter""")
    q["lost_by_except"] = (
        lambda s, d: CH.lost_by_except(_cq(s, d)),
        _CQ + f"\nSELECT ClientID, prev_quarter, curr_quarter FROM al WHERE {_TOOLS_LOST}")
    q["active_in_either"] = (
        lambda s, d: CH.active_in_either(_cq(s, d)),
        _CQ + "\nSELECT ClientID, prev_quarter, curr_quarter FROM al WHERE prev_revenue > 0 OR curr_revenue > 0")
    q["union_client_sets"] = (
        lambda s, d: CH.union_client_sets(cut_lineage(CH.client_sets(_loads(s, d), "load"), s, "client-sets")),
        _REV + "\nSELECT DISTINCT ClientID FROM rev")

    # the same sets as bitmaps: merged per load, and compared without id rows
    q["merge_bitmap_partials"] = (
        lambda s, d: BM.merge_partial_bitmaps(cut_lineage(BM.partial_bitmaps(_loads(s, d), load_col="load"), s, "partial-bits")),
        "@merge_partials")
    q["union_client_bitmaps"] = (
        lambda s, d: BM.ids_of(BM.merge_bitmaps(cut_lineage(
            BM.id_bitmaps(_loads(s, d), ["load"], "ClientID"), s, "client-bits"), []), "ClientID"),
        "@union_client_sets")
    q["bitmap_churn"] = (_bitmap_churn, _CQ + """
SELECT p.prev_quarter, p.curr_quarter,
       count_if(a.prev_revenue > 0 AND NOT a.curr_revenue > 0) AS lost,
       count_if(a.curr_revenue > 0 AND NOT a.prev_revenue > 0) AS new,
       count_if(a.prev_revenue > 0 AND a.curr_revenue > 0) AS retained
FROM pairs p JOIN al a ON a.prev_quarter = p.prev_quarter AND a.curr_quarter = p.curr_quarter GROUP BY 1, 2""")

    # ---- V8, V9, R1
    q["churn_flags"] = (
        lambda s, d: CH.churn_flags(CH.churn_counts(_cq(s, d), mode=CH.TOOLS)),
        _CQ + f""",
cc AS (SELECT prev_quarter, curr_quarter,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS DOUBLE) AS loss,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) AS DOUBLE) AS gain
       FROM al GROUP BY 1, 2)
SELECT prev_quarter || '->' || curr_quarter AS pair, gain - loss AS net_change,
       CASE WHEN loss > gain * 2 AND loss > 0 THEN 'significant_loss' ELSE 'stable' END AS note FROM cc""")
    q["retention_suggestions"] = (
        lambda s, d: CH.retention_suggestions(CH.churn_flags(CH.churn_counts(_cq(s, d), mode=CH.TOOLS))),
        _CQ + f""",
cc AS (SELECT prev_quarter, curr_quarter,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS DOUBLE) AS loss,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) AS DOUBLE) AS gain
       FROM al GROUP BY 1, 2)
SELECT prev_quarter || '->' || curr_quarter AS pair,
       'Investigate top lost clients and run retention offers.' AS suggestion
FROM cc WHERE loss > gain * 2 AND loss > 0""")
    q["churn_trend_data"] = (
        lambda s, d: CH.churn_trend_data(CH.churn_counts(_cq(s, d), mode=CH.TOOLS)),
        _CQ + f""",
cc AS (SELECT prev_quarter || '->' || curr_quarter AS period,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS DOUBLE) AS revenue_loss,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) AS DOUBLE) AS revenue_gain
       FROM al GROUP BY 1)
SELECT period, 'revenue_loss' AS type, revenue_loss AS amount FROM cc
UNION ALL SELECT period, 'revenue_gain', revenue_gain FROM cc""")
    _more(q)
    return q


def _loads(spark: SparkSession, d: str) -> DataFrame:
    """The revenue view as loads: one per order year."""
    return _rev(spark, d).withColumn("load", F.year("Date"))


def _bitmap_churn(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps of neighbouring quarters' active clients by bitmaps, the
    clients being named by text and numbered by a dictionary."""
    cq = cut_lineage(RV.client_quarterly_long(_cq(spark, d)).withColumn(
        "name", F.concat(F.lit("C"), F.col("ClientID").cast("string"))), spark, "named-quarters")
    numbers = cut_lineage(BM.id_numbers(cq, "name"), spark, "client-numbers")
    sets = BM.id_bitmaps(RV.active_clients(cq).join(numbers, "name"), ["Quarter"], "no")
    return BM.overlap_counts(sets, CH.quarter_pairs(cq))


def _versioned_upserts(spark: SparkSession, d: str) -> DataFrame:
    """M2: the benchmark's entries upserted into a stored index of the
    documents in two loads."""
    path = scratch_path(spark, "versioned-index")
    VI.save_versioned(TX.embed_text(load(spark, d, "documents"), "doc_id", "text"), path)
    bench = load(spark, d, "benchmark")
    for k in (0, 1):
        VI.upsert_versioned(spark, path, TX.embed_text(bench.where(F.pmod(F.xxhash64("item_id"), F.lit(2)) == k), "item_id", "text"))
    return TX.sparse_rows(VI.load_versioned(spark, path)).withColumn("weight", F.round("weight", 9))


def _pinned(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run a query with the session settings results depend on (UTC, ANSI)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _pinned(v[0]) for k, v in _registry().items()}


def oracle_sql() -> dict[str, str]:
    reg = _registry()
    out = {}
    for k, v in reg.items():
        if v[1] is None:
            continue
        sql = v[1](lambda name: f"({reg[name][1]})") if callable(v[1]) else v[1]     # a text over other keys' texts
        out[k] = reg[sql[1:]][1] if sql.startswith("@") else sql
    return out


# ------------------------------------------------------------------ more keys
PACK_TEMPLATE = "Summarize the following conversation turns:"
PACK_LIMIT = 400
CHUNK = 1000
_TOK_RE = r"[\p{L}\p{N}_]+"
_BUCKET_SQL = "CAST(('0x' || right(md5(tok), 4)) AS INTEGER) % 64"
_DIRTY_REV = _REV.replace("r.r_name AS Region",
                          "CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE r.r_name END AS Region")
_EXACT_TOTALS = """
SELECT a = b AS ok, CAST(a AS DOUBLE) AS {a}, CAST(b AS DOUBLE) AS {b}{extra} FROM t"""
_EMBED_TPL = """
@n_tok AS (SELECT @id AS id, unnest(regexp_extract_all(lower(text), '""" + _TOK_RE + """')) AS tok FROM @t),
@n_cnt AS (SELECT id, """ + _BUCKET_SQL + """ AS bucket, CAST(count(*) AS DOUBLE) AS c FROM @n_tok GROUP BY ALL),
@n AS (SELECT id, bucket, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS weight FROM @n_cnt)"""


def _embed_sql(name: str, id_col: str, table: str) -> str:
    """DuckDB CTEs for the hashed bag-of-words of ``table`` (as M1)."""
    return _EMBED_TPL.replace("@n", name).replace("@id", id_col).replace("@t", table)


# the breaker as a recursive query: state (count, open_until) per user,
# carried event by event in (ts, event_id) order
_BREAKER_SQL = """WITH RECURSIVE t AS (
  SELECT user_id, ts, event_type = 'error' AS f,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (
  SELECT user_id, rn, ts, CASE WHEN f THEN 1 ELSE 0 END AS cnt,
         CASE WHEN f AND 1 >= 3 THEN ts + INTERVAL 30 SECOND END AS open_until,
         f AND 1 >= 3 AS trip
  FROM t WHERE rn = 1
  UNION ALL
  SELECT t.user_id, t.rn, t.ts,
         CASE WHEN r.open_until IS NOT NULL AND t.ts <= r.open_until THEN r.cnt
              WHEN t.f THEN (CASE WHEN r.open_until IS NOT NULL THEN 0 ELSE r.cnt END) + 1
              ELSE 0 END,
         CASE WHEN r.open_until IS NOT NULL AND t.ts <= r.open_until THEN r.open_until
              WHEN t.f AND (CASE WHEN r.open_until IS NOT NULL THEN 0 ELSE r.cnt END) + 1 >= 3
                THEN t.ts + INTERVAL 30 SECOND
              ELSE NULL END,
         NOT (r.open_until IS NOT NULL AND t.ts <= r.open_until)
           AND t.f AND (CASE WHEN r.open_until IS NOT NULL THEN 0 ELSE r.cnt END) + 1 >= 3
  FROM r JOIN t ON t.user_id = r.user_id AND t.rn = r.rn + 1),
trips AS (SELECT user_id, ts AS trip_at, open_until FROM r WHERE trip)"""


def _raw_rev(spark, d):
    """The revenue view as text, with data-derived defects: an impossible
    date on partially filled orders and unreadable revenue on low-priority
    ones (every row is kept)."""
    rev = revenue_view(spark, d, keep=("o_orderstatus", "o_orderpriority"))
    return rev.select(
        F.col("ClientID").cast("string").alias("ClientID"), "Region", "Country",
        F.when(F.col("o_orderstatus") == "P", F.lit("2024-13-01"))
         .otherwise(F.date_format("Date", "yyyy-MM-dd")).alias("Date"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
         .otherwise(F.col("Revenue").cast("string")).alias("Revenue"))


_RAW_REV_SQL = _REV.replace("o.o_custkey AS ClientID,", "o.o_custkey AS ClientID, o.o_orderstatus, o.o_orderpriority,") + """,
raw AS (SELECT CAST(ClientID AS VARCHAR) AS ClientID, Region, Country,
               CASE WHEN o_orderstatus = 'P' THEN '2024-13-01' ELSE strftime(Date, '%Y-%m-%d') END AS Date,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(Revenue AS VARCHAR) END AS Revenue
        FROM rev)"""


def _csv_roundtrip(spark, d):
    """The revenue view written as a CSV file set whose files order their
    columns differently, read back as text and typed again. The file set lives
    under the shared checkpoint folder."""
    path = scratch_path(spark, "rev-csv")
    rev = revenue_view(spark, d, keep=("o_orderstatus",)).select(
        "ClientID", "Region", "Country", F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        F.col("Revenue").cast("string").alias("Revenue"), "o_orderstatus")
    done = F.col("o_orderstatus") == "F"
    SK.write_csv(rev.where(done).drop("o_orderstatus"), path + "/a")
    SK.write_csv(rev.where(~done | done.isNull()).select("Revenue", "Date", "Country", "ClientID", "Region"), path + "/b")
    good, _rej = RD.read_revenue_csv(spark, path + "/*")
    return good.select(F.col("ClientID").cast("long").alias("ClientID"), "Region", "Country", "Date",
                       F.col("Revenue").cast("double").alias("Revenue"))


def _pivot_csv(spark, d):
    """The client pivot written as CSV and read back."""
    path = SK.write_csv(RV.client_quarterly_revenue(_cq(spark, d), PIVOT_QUARTERS), scratch_path(spark, "pivot-csv"))
    schema = "ClientID long, " + ", ".join(f"`{q}` double" for q in PIVOT_QUARTERS)
    return spark.read.schema(schema).option("header", True).csv(path)


def _wide_stamps(spark, d):
    """The wide sheet with timestamp headers, as spreadsheets write them."""
    w = _wide(spark, d)
    return w.select(*[F.col(f"`{c}`").alias(f"{c} 00:00:00" if c[:4].isdigit() else c) for c in w.columns])


def _wide(spark, d):
    """S5 input: the revenue view pivoted to one column per month start."""
    rev = revenue_view(spark, d).withColumn("m", F.date_format(F.trunc("Date", "month"), "yyyy-MM-dd"))
    months = RV.quarter_labels(rev, "m")      # bounded by the calendar
    wide = rev.groupBy("ClientID", "Country", "Region").pivot("m", months).agg(F.sum("Revenue"))
    return wide.withColumnRenamed("ClientID", "Customer Name")


def _more(q):
    # ---- V1–V5, V7
    q["totals_match"] = (
        lambda s, d: VA.totals_match(_rev(s, d), RV.aggregate_by_quarter_region(_cq(s, d), rows_col="NumRows", exact=True)),
        _REVQ + """,
agg AS (SELECT Quarter, Region, Country, SUM(Revenue) AS TotalRevenue FROM revq GROUP BY ALL),
t AS (SELECT (SELECT SUM(Revenue) FROM rev) AS a, (SELECT SUM(TotalRevenue) FROM agg) AS b)""" +
        _EXACT_TOTALS.format(a="input_total", b="agg_total",
                             extra=", CASE WHEN a = b THEN 'Totals match' ELSE 'mismatch' END AS message"))
    q["validate_quarterly"] = (
        lambda s, d: VA.validate_quarterly(_dirty_rev(s, d), RV.group_by_quarter(_dirty_rev(s, d), exact=True)),
        _DIRTY_REV + """,
agg AS (SELECT 'Q' || CAST(quarter(Date) AS VARCHAR) AS Quarter, Region, Country,
               SUM(Revenue) AS TotalRevenue FROM rev WHERE Region IS NOT NULL GROUP BY ALL),
t AS (SELECT (SELECT SUM(Revenue) FROM rev) AS a, (SELECT SUM(TotalRevenue) FROM agg) AS b)""" +
        _EXACT_TOTALS.format(a="total_original", b="total_aggregated", extra=", CAST(a - b AS DOUBLE) AS difference"))
    q["churn_sane"] = (
        lambda s, d: VA.churn_sane(CH.churn_counts(_cq(s, d), mode=CH.TOOLS)),
        _CQ + f""",
cc AS (SELECT SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END) AS loss,
              SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END) AS gain FROM al GROUP BY prev_quarter, curr_quarter)
SELECT COALESCE(bool_and(COALESCE(loss, 0) >= 0 AND COALESCE(gain, 0) >= 0), true) AS ok,
       CASE WHEN COALESCE(bool_and(COALESCE(loss, 0) >= 0 AND COALESCE(gain, 0) >= 0), true)
            THEN 'Churn report sane' ELSE 'Negative revenue in churn report' END AS message FROM cc""")
    q["churn_reconciles"] = (
        lambda s, d: VA.churn_reconciles(_cq(s, d)),
        _CQ + """
SELECT prev_quarter, curr_quarter, count_if(prev_revenue > 0 OR curr_revenue > 0) AS total_clients,
       count_if(prev_revenue > 0 OR curr_revenue > 0) =
       count_if(prev_revenue > 0 AND curr_revenue = 0) + count_if(prev_revenue = 0 AND curr_revenue > 0)
       + count_if(prev_revenue > 0 AND curr_revenue > 0) AS reconciles
FROM al GROUP BY prev_quarter, curr_quarter""")

    # a feed with data-derived refunds (urgent orders count negative), where
    # the core and tools rules differ and the checks can fail
    ref = _CQ.replace("CAST(o.o_totalprice AS DECIMAL(18,2)) AS Revenue",
                      "CAST(CASE WHEN o.o_orderpriority = '1-URGENT' THEN -o.o_totalprice ELSE o.o_totalprice END "
                      "AS DECIMAL(18,2)) AS Revenue")
    assert ref != _CQ
    q["refund_churn_counts"] = (lambda s, d: CH.churn_counts(_refunds(s, d)), ref + _COUNTS_SELECT)
    q["refund_churn_counts_tools"] = (
        lambda s, d: CH.churn_counts(_refunds(s, d), mode=CH.TOOLS),
        ref + _COUNTS_SELECT.replace("prev_revenue > 0 AND curr_revenue = 0", _TOOLS_LOST)
                            .replace("prev_revenue = 0 AND curr_revenue > 0", _TOOLS_NEW))
    q["refund_rules_differ"] = (
        lambda s, d: _rules_differ(_refunds(s, d)),
        ref + f"""
SELECT * FROM (SELECT prev_quarter, curr_quarter,
         count_if(prev_revenue > 0 AND curr_revenue = 0) AS core_lost, count_if({_TOOLS_LOST}) AS tools_lost,
         count_if(prev_revenue = 0 AND curr_revenue > 0) AS core_new, count_if({_TOOLS_NEW}) AS tools_new
  FROM al GROUP BY 1, 2) t WHERE core_lost <> tools_lost OR core_new <> tools_new""")
    q["refund_churn_sane"] = (
        lambda s, d: VA.churn_sane(CH.churn_counts(_refunds(s, d), mode=CH.TOOLS)
                                   .withColumn("revenue_gain", F.col("total_curr_revenue") - F.col("revenue_gain") * 9)),
        ref + f"""
, cc AS (SELECT COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS loss,
                SUM(curr_revenue) - COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) * 9 AS gain
         FROM al GROUP BY prev_quarter, curr_quarter),
ok AS (SELECT COALESCE(bool_and(loss >= 0 AND gain >= 0), true) AS ok FROM cc)
SELECT ok, CASE WHEN ok THEN 'Churn report sane' ELSE 'Negative revenue in churn report' END AS message FROM ok""")
    q["refund_churn_reconciles"] = (
        lambda s, d: VA.churn_reconciles(_refunds(s, d)),
        ref + """
SELECT prev_quarter, curr_quarter, count_if(prev_revenue > 0 OR curr_revenue > 0) AS total_clients,
       count_if(prev_revenue > 0 OR curr_revenue > 0) =
       count_if(prev_revenue > 0 AND curr_revenue = 0) + count_if(prev_revenue = 0 AND curr_revenue > 0)
       + count_if(prev_revenue > 0 AND curr_revenue > 0) AS reconciles
FROM al GROUP BY prev_quarter, curr_quarter""")

    def _actions(s, d):
        checks = (VA.check_result("quarterly", VA.validate_quarterly(
                      _dirty_rev(s, d), RV.group_by_quarter(_dirty_rev(s, d), exact=True)))
                  .unionByName(VA.check_result("churn", VA.churn_reconciles(_refunds(s, d)), "reconciles")))
        return VA.validation_actions(checks)
    q["validation_actions"] = (
        _actions,
        ref + """,
dirty AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS kept,
                 CAST(o_totalprice AS DECIMAL(18,2)) AS r
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
          JOIN region g ON n.n_regionkey = g.r_regionkey),
qk AS (SELECT SUM(r) = SUM(r * kept) AS ok FROM dirty),
ck AS (SELECT bool_and(total = parts) AS ok FROM (
         SELECT count_if(prev_revenue > 0 OR curr_revenue > 0) AS total,
                count_if(prev_revenue > 0 AND curr_revenue = 0) + count_if(prev_revenue = 0 AND curr_revenue > 0)
                + count_if(prev_revenue > 0 AND curr_revenue > 0) AS parts FROM al GROUP BY prev_quarter, curr_quarter) t)
SELECT 'retry_aggregation' AS action, 'sum mismatch' AS reason FROM qk WHERE NOT ok
UNION ALL SELECT 'recompute_churn', 'reconciliation failed' FROM ck WHERE NOT ok
UNION ALL SELECT 'accept', 'all checks passed' FROM qk, ck WHERE qk.ok AND ck.ok""")
    q["check_row_contract"] = (
        lambda s, d: VA.check_row_contract(_raw_rev(s, d)),
        _RAW_REV_SQL + r"""
SELECT *, list_filter([
  CASE WHEN ClientID IS NULL OR trim(ClientID) = '' THEN 'ClientID:required' END,
  CASE WHEN Region IS NULL OR trim(Region) = '' THEN 'Region:required' END,
  CASE WHEN Country IS NULL OR trim(Country) = '' THEN 'Country:required' END,
  CASE WHEN COALESCE(try_strptime(trim(Date), '%Y-%m-%d'), try_strptime(trim(Date), '%Y/%m/%d')) IS NULL
       THEN 'Date:invalid' END,
  CASE WHEN Revenue IS NULL OR NOT regexp_matches(trim(Revenue), '""" + FN.NUMBER_TEXT + r"""')
       THEN 'Revenue:not_a_number' END], lambda x: x IS NOT NULL) AS violations
FROM raw""")
    q["quarantine_split"] = (
        lambda s, d: _dbl(RD.coerce_feed(_raw_rev(s, d))[0], "Revenue"),
        _RAW_REV_SQL + """
SELECT ClientID, Region, Country, CAST(Date AS DATE) AS Date,
       CAST(CASE WHEN Revenue = 'n/a' THEN 0 ELSE CAST(Revenue AS DECIMAL(18,2)) END AS DOUBLE) AS Revenue
FROM raw WHERE Date <> '2024-13-01'""")

    q["quarantine_rejects"] = (
        lambda s, d: RD.prepare_feed(_raw_rev(s, d).withColumnRenamed("ClientID", "Client Id"))[1],
        _RAW_REV_SQL + "\nSELECT *, 'bad date' AS reason FROM raw WHERE Date = '2024-13-01'")
    q["prepare_feed"] = (
        lambda s, d: _dbl(RD.prepare_feed(_raw_rev(s, d).withColumnRenamed("ClientID", "client-name"))[0]
                          .withColumnRenamed("clientname", "ClientID"), "Revenue"),
        "@quarantine_split")

    # ---- S1, S3, S5, S6, A14, P1, P2, P8
    q["read_revenue_csv"] = (
        _csv_roundtrip,
        _REV + "\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue FROM rev")
    q["normalize_wide"] = (
        lambda s, d: RD.normalize_wide(_wide(s, d)),
        _REV + """,
m AS (SELECT DISTINCT CAST(date_trunc('month', Date) AS DATE) AS Date FROM rev),
g AS (SELECT DISTINCT ClientID, Country, Region FROM rev),
x AS (SELECT ClientID, CAST(date_trunc('month', Date) AS DATE) AS Date, SUM(Revenue) AS r FROM rev GROUP BY ALL)
SELECT g.ClientID AS "Client ID", g.Country, g.Region, m.Date,
       CAST(COALESCE(x.r, 0) AS DOUBLE) AS Revenue
FROM g CROSS JOIN m LEFT JOIN x ON x.ClientID = g.ClientID AND x.Date = m.Date""")
    q["normalize_wide_timestamps"] = (lambda s, d: RD.normalize_wide(_wide_stamps(s, d)), "@normalize_wide")
    q["client_pivot_csv"] = (_pivot_csv, "@client_quarterly_revenue")
    q["normalize_columns"] = (
        lambda s, d: RD.resolve_client_column(RD.normalize_columns(
            load(s, d, "customer").toDF(" Client Id ", "c-name", "c nationkey", "c_acctbal", "c mktsegment"))),
        "SELECT c_custkey AS ClientID, c_name AS cname, c_nationkey AS cnationkey, c_acctbal, "
        "c_mktsegment AS cmktsegment FROM customer")
    q["resolve_client_column"] = (
        lambda s, d: RD.resolve_client_column(load(s, d, "customer").withColumnRenamed("c_custkey", "client_key")),
        "SELECT c_custkey AS ClientID, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
    q["select_known"] = (
        lambda s, d: _dbl(RD.select_known(revenue_view(s, d, keep=("o_orderpriority",))), "Revenue"),
        _REV + "\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue FROM rev")
    q["chunk_rows"] = (
        lambda s, d: CK.chunk_rows(revenue_view(s, d, keep=("o_orderkey",)), ["o_orderkey"], CHUNK)
                       .select("o_orderkey", "row_idx", "chunk_id"),
        _REV.replace("o.o_custkey AS ClientID,", "o.o_orderkey, o.o_custkey AS ClientID,") + f"""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx,
       (row_number() OVER (ORDER BY o_orderkey) - 1) // {CHUNK} AS chunk_id FROM rev""")
    q["chunk_summaries"] = (
        lambda s, d: CK.chunk_summaries(revenue_view(s, d, keep=("o_orderkey",)), ["o_orderkey"], CHUNK),
        _REV.replace("o.o_custkey AS ClientID,", "o.o_orderkey, o.o_custkey AS ClientID,") + f""",
n AS (SELECT Revenue, (row_number() OVER (ORDER BY o_orderkey) - 1) // {CHUNK} AS chunk_id FROM rev)
SELECT chunk_id, count(*) AS rows, CAST(SUM(Revenue) AS DOUBLE) AS revenue_sum FROM n GROUP BY chunk_id""")

    # ---- text: P10–P14, F4, W3, W4, A15, M1–M3, J7, T2
    q["estimate_tokens"] = (
        lambda s, d: load(s, d, "documents").select(
            "doc_id", FN.estimate_tokens("text").alias("tokens"), FN.truncate_text("text").alias("preview")),
        "SELECT doc_id, greatest(1, length(text) // 4) AS tokens, CASE WHEN length(text) > 120 "
        "THEN substring(text, 1, 120) || '...' ELSE text END AS preview FROM documents")
    q["token_buckets"] = (
        lambda s, d: load(s, d, "documents").select("doc_id", F.explode(FN.tokenize("text")).alias("tok"))
                       .groupBy("doc_id", FN.hash_bucket("tok", 64).alias("bucket")).agg(
                           F.count(F.lit(1)).alias("n")),
        "WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '" + _TOK_RE + "')) AS tok "
        "FROM documents)\nSELECT doc_id, " + _BUCKET_SQL + " AS bucket, count(*) AS n FROM t GROUP BY ALL")
    q["content_key"] = (
        lambda s, d: load(s, d, "documents").select("doc_id", FN.content_key(F.lit("embed"), "text").alias("key")),
        "SELECT doc_id, sha256(concat_ws('|', 'embed', COALESCE(text, '<null>'))) AS key FROM documents")
    q["token_budget_gate"] = (
        lambda s, d: TX.token_budget_gate(load(s, d, "documents").select("doc_id", "text"), "text", 512, 2048)
                       .drop("text"),
        "SELECT doc_id, greatest(1, length(text) // 4) AS tokens, "
        "greatest(1, length(text) // 4) + 512 <= 2048 AS within_budget FROM documents")
    q["recent_notes_summary"] = (
        lambda s, d: TX.recent_notes_summary(load(s, d, "conversations")),
        r"""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn
                          FROM conversations) t WHERE rn <= 50),
j AS (SELECT conv_id, string_agg(text, ' | ' ORDER BY turn) AS s FROM l GROUP BY conv_id),
c AS (SELECT conv_id, CASE WHEN length(s) > 1500
                           THEN regexp_replace(substring(s, 1, 1500), ' [^ ]*$', '') ELSE s END AS summary FROM j)
SELECT conv_id, summary, greatest(1, length(summary) // 4) AS tokens FROM c""")
    tpl_tok = max(1, len(PACK_TEMPLATE) // 4)
    q["pack_by_token_budget"] = (
        lambda s, d: TX.pack_by_token_budget(load(s, d, "conversations"), PACK_TEMPLATE, PACK_LIMIT),
        f"""WITH RECURSIVE t AS (
  SELECT conv_id, turn, text, greatest(1, length(text) // 4) AS tok,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
r AS (SELECT conv_id, rn, tok AS cur, 0 AS chunk_no FROM t WHERE rn = 1
      UNION ALL
      SELECT t.conv_id, t.rn,
             CASE WHEN r.cur + t.tok + {tpl_tok} > {PACK_LIMIT} THEN t.tok ELSE r.cur + t.tok END,
             CASE WHEN r.cur + t.tok + {tpl_tok} > {PACK_LIMIT} THEN r.chunk_no + 1 ELSE r.chunk_no END
      FROM r JOIN t ON t.conv_id = r.conv_id AND t.rn = r.rn + 1),
p AS (SELECT t.conv_id, r.chunk_no, count(*) AS n_texts, SUM(t.tok) AS text_tokens,
             '{PACK_TEMPLATE}' || chr(10) || chr(10) || string_agg(t.text, chr(10) ORDER BY t.turn) AS prompt
      FROM t JOIN r ON t.conv_id = r.conv_id AND t.rn = r.rn GROUP BY t.conv_id, r.chunk_no)
SELECT conv_id, CAST(chunk_no AS INTEGER) AS chunk_no, n_texts, text_tokens,
       greatest(1, length(prompt) // 4) AS prompt_tokens, prompt FROM p""")
    # every turn twice under one turn number, groups named by text
    q["pack_repeated_turns"] = (
        lambda s, d: TX.pack_by_token_budget(
            load(s, d, "conversations").select(F.concat(F.lit("c"), F.col("conv_id")).alias("conv_id"),
                                               F.floor(F.col("turn") / 2).alias("turn"), "text"),
            PACK_TEMPLATE, PACK_LIMIT),
        f"""WITH RECURSIVE t AS (
  SELECT 'c' || conv_id AS conv_id, text, greatest(1, length(text) // 4) AS tok,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn // 2, text) AS rn FROM conversations),
r AS (SELECT conv_id, rn, tok AS cur, 0 AS chunk_no FROM t WHERE rn = 1
      UNION ALL
      SELECT t.conv_id, t.rn,
             CASE WHEN r.cur + t.tok + {tpl_tok} > {PACK_LIMIT} THEN t.tok ELSE r.cur + t.tok END,
             CASE WHEN r.cur + t.tok + {tpl_tok} > {PACK_LIMIT} THEN r.chunk_no + 1 ELSE r.chunk_no END
      FROM r JOIN t ON t.conv_id = r.conv_id AND t.rn = r.rn + 1),
p AS (SELECT t.conv_id, r.chunk_no, count(*) AS n_texts, SUM(t.tok) AS text_tokens,
             '{PACK_TEMPLATE}' || chr(10) || chr(10) || string_agg(t.text, chr(10) ORDER BY t.rn) AS prompt
      FROM t JOIN r ON t.conv_id = r.conv_id AND t.rn = r.rn GROUP BY t.conv_id, r.chunk_no)
SELECT conv_id, CAST(chunk_no AS INTEGER) AS chunk_no, n_texts, text_tokens,
       greatest(1, length(prompt) // 4) AS prompt_tokens, prompt FROM p""")
    q["token_usage"] = (
        lambda s, d: EV.token_usage(load(s, d, "conversations")),
        "SELECT role, SUM(greatest(1, length(text) // 4)) AS tokens, count(*) AS entries "
        "FROM conversations GROUP BY role")
    q["embed_text"] = (
        lambda s, d: TX.sparse_rows(TX.embed_text(load(s, d, "documents"), "doc_id", "text"))
                       .withColumn("weight", F.round("weight", 9)),
        "WITH" + _embed_sql("e", "doc_id", "documents") +
        "\nSELECT id, bucket, round(weight, 9) AS weight FROM e")
    q["upsert_index"] = (
        lambda s, d: TX.sparse_rows(TX.upsert_index(
                         TX.embed_text(load(s, d, "documents"), "doc_id", "text"),
                         TX.embed_text(load(s, d, "benchmark"), "item_id", "text")))
                       .withColumn("weight", F.round("weight", 9)),
        "WITH" + _embed_sql("e", "doc_id", "documents") + "," +
        _embed_sql("b", "item_id", "benchmark") + """
SELECT id, bucket, round(weight, 9) AS weight FROM e WHERE id NOT IN (SELECT id FROM b)
UNION ALL SELECT id, bucket, round(weight, 9) FROM b""")
    # the same in hash partitions: two upserts, each rewriting what it touches
    q["upsert_index_versions"] = (_versioned_upserts, "@upsert_index")
    q["append_index"] = (
        lambda s, d: TX.sparse_rows(TX.upsert_index(
                         TX.embed_text(load(s, d, "documents"), "doc_id", "text"),
                         TX.embed_text(load(s, d, "benchmark"), "item_id", "text"), replace=False))
                       .withColumn("weight", F.round("weight", 9)),
        "WITH" + _embed_sql("e", "doc_id", "documents") + "," +
        _embed_sql("b", "item_id", "benchmark") + """
SELECT id, bucket, round(weight, 9) AS weight FROM e UNION ALL SELECT id, bucket, round(weight, 9) FROM b""")
    q["similarity_pairs"] = (
        lambda s, d: TX.similarity_pairs(TX.embed_text(load(s, d, "documents"), "doc_id", "text"),
                                         TX.embed_text(load(s, d, "benchmark"), "item_id", "text")),
        "WITH" + _embed_sql("e", "doc_id", "documents") + "," +
        _embed_sql("b", "item_id", "benchmark") + """
SELECT b.id AS qid, e.id, round(SUM(e.weight * b.weight), 6) AS score
FROM e JOIN b ON e.bucket = b.bucket GROUP BY b.id, e.id""")
    def _query_index(s, d):
        # build the index with text and metadata, keep it (S11), load it again and query it
        docs = load(s, d, "documents").withColumn("meta", F.create_map(F.lit("source"), F.col("source")))
        index = TX.embed_text(docs, "doc_id", "text", keep=["text", "meta"]).select(
            F.col("id").cast("string").alias("id"), "text", "vec", "meta")
        path = SK.save_index(index, scratch_path(s, "doc-index"))
        return TX.query_index(SK.load_index(s, path), load(s, d, "benchmark"), "item_id", "text", k=5).select(
            "qid", "id", "score", "rank", "text", F.col("meta")["source"].alias("source"))
    q["query_index"] = (
        _query_index,
        "WITH" + _embed_sql("e", "doc_id", "documents") + "," +
        _embed_sql("b", "item_id", "benchmark") + """,
dot AS (SELECT b.id AS qid, e.id, SUM(e.weight * b.weight) AS score FROM e JOIN b ON e.bucket = b.bucket GROUP BY ALL),
every AS (SELECT i.item_id AS qid, o.doc_id AS id, o.text, o.source FROM benchmark i CROSS JOIN documents o),
scored AS (SELECT v.qid, CAST(v.id AS VARCHAR) AS id, round(coalesce(dot.score, 0), 6) AS score, v.text, v.source
           FROM every v LEFT JOIN dot ON dot.qid = v.qid AND dot.id = v.id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scored) t
WHERE rank <= 5""")
    dense = """WITH x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v,
                  generate_subscripts(embedding, 1) AS i FROM embeddings),
nrm AS (SELECT vec_id, sqrt(SUM(v * v)) AS n FROM x GROUP BY vec_id),
e AS (SELECT x.vec_id AS id, x.label, x.i, x.v / CASE WHEN n = 0 THEN 1 ELSE n END AS w FROM x JOIN nrm USING (vec_id))"""
    q["topk_similar"] = (
        lambda s, d: TX.topk_similar(TX.normalized_vectors(load(s, d, "embeddings"), "vec_id", "embedding"),
                                     TX.label_centroids(load(s, d, "embeddings"), "label", "embedding"), k=5),
        dense + """,
m AS (SELECT label AS id, i, avg(v) AS m FROM x GROUP BY ALL),
c AS (SELECT id, i, m / sqrt(SUM(m * m) OVER (PARTITION BY id)) AS w FROM m),
dot AS (SELECT c.id AS qid, e.id, round(SUM(e.w * c.w), 6) AS score FROM e JOIN c ON e.i = c.i GROUP BY c.id, e.id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM dot) t
WHERE rank <= 5""")
    # the query set fixed for searches: every row whose id is divisible by 50
    q["topk_similar_rows"] = (
        lambda s, d: TX.topk_similar(
            TX.normalized_vectors(load(s, d, "embeddings"), "vec_id", "embedding"),
            TX.normalized_vectors(load(s, d, "embeddings").where(F.col("vec_id") % 50 == 0), "vec_id", "embedding"), k=5),
        dense + """,
dot AS (SELECT c.id AS qid, e.id, round(SUM(e.w * c.w), 6) AS score FROM e JOIN e c ON e.i = c.i
        WHERE c.id % 50 = 0 GROUP BY c.id, e.id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM dot) t
WHERE rank <= 5""")
    # the same from an index of cells with bounds, saved and searched in rounds
    def _topk_cells(s, d):
        index = TX.normalized_vectors(load(s, d, "embeddings"), "vec_id", "embedding")
        path = CE.save_cells(index, scratch_path(s, "cells"))
        return CE.topk_cells(s, path, index.where(F.col("id") % 50 == 0), k=5)
    q["topk_similar_cells"] = (_topk_cells, "@topk_similar_rows")
    q["query_index_rows"] = (
        lambda s, d: TX.query_index(TX.embed_text(load(s, d, "documents"), "doc_id", "text"),
                                    load(s, d, "documents").where(F.col("doc_id") % 50 == 0), "doc_id", "text", k=5),
        "WITH" + _embed_sql("e", "doc_id", "documents") + """,
dot AS (SELECT b.id AS qid, e.id, SUM(e.weight * b.weight) AS score FROM e JOIN e b ON e.bucket = b.bucket
        WHERE b.id % 50 = 0 GROUP BY ALL),
every AS (SELECT i.doc_id AS qid, o.doc_id AS id FROM documents i CROSS JOIN documents o WHERE i.doc_id % 50 = 0),
scored AS (SELECT v.qid, v.id, round(coalesce(dot.score, 0), 6) AS score
           FROM every v LEFT JOIN dot ON dot.qid = v.qid AND dot.id = v.id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scored) t
WHERE rank <= 5""")
    # few entries, all of them candidates: the labels' means against their
    # opposites, where most cosines are negative
    q["topk_similar_negative"] = (
        lambda s, d: TX.topk_similar(
            TX.label_centroids(load(s, d, "embeddings"), "label", "embedding"),
            TX.label_centroids(load(s, d, "embeddings"), "label", "embedding")
              .withColumn("vec", F.transform("vec", lambda x: -x)), k=8),
        dense + """,
m AS (SELECT label AS id, i, avg(v) AS m FROM x GROUP BY ALL),
c AS (SELECT id, i, m / sqrt(SUM(m * m) OVER (PARTITION BY id)) AS w FROM m),
dot AS (SELECT c.id AS qid, o.id, round(SUM(-o.w * c.w), 6) AS score FROM c o JOIN c ON o.i = c.i GROUP BY c.id, o.id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM dot) t
WHERE rank <= 8""")

    # ---- events: A12, A13, A16, W5, W6, S13, P16, P17
    q["step_counters"] = (
        lambda s, d: EV.step_counters(load(s, d, "events")),
        "SELECT event_type, count(*) AS count, SUM(value) AS total_value FROM events GROUP BY event_type")
    q["step_timings"] = (
        lambda s, d: EV.step_timings(load(s, d, "events")),
        "SELECT event_type, arg_max(value, (ts, event_id)) AS latest_value, count(value) AS n, "
        "avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value FROM events GROUP BY event_type")
    q["step_percentiles"] = (
        lambda s, d: EV.step_percentiles(load(s, d, "events")).select(
            "event_type", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")]),
        "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, "
        "round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type")
    q["run_log_summary"] = (
        lambda s, d: EV.run_log_summary(load(s, d, "events")),
        "SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_status, count(*) AS attempts, "
        "count_if(event_type = 'error') AS errors FROM events GROUP BY user_id")
    q["failure_streaks"] = (
        lambda s, d: EV.failure_streaks(load(s, d, "events")),
        """WITH x AS (SELECT user_id, ts, event_type = 'error' AS f,
                  SUM(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
                    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
           FROM events)
SELECT user_id, island, min(ts) AS streak_start, max(ts) AS streak_end, count(*) AS failures,
       count(*) >= 3 AS tripped FROM x WHERE f GROUP BY user_id, island""")
    q["breaker_trips"] = (lambda s, d: EV.breaker_trips(load(s, d, "events")), _BREAKER_SQL + """
SELECT k.user_id, k.trip_at, k.open_until,
       (SELECT count(*) FROM t WHERE t.user_id = k.user_id AND t.ts > k.trip_at AND t.ts <= k.open_until)
         AS blocked_events
FROM trips k""")
    q["latest_summaries"] = (
        lambda s, d: SK.latest_per_key(load(s, d, "events"), ["user_id"], "ts"),
        "SELECT user_id, arg_max(event_id, (ts, event_id, event_type, value, props)) AS event_id, max(ts) AS ts, "
        "arg_max(event_type, (ts, event_id, event_type, value, props)) AS event_type, "
        "arg_max(value, (ts, event_id, event_type, value, props)) AS value, "
        "arg_max(props, (ts, event_id, event_type, value, props)) AS props FROM events GROUP BY user_id")
    q["compress_record"] = (
        lambda s, d: FN.compress_record(CH.churn_lists(_cq(s, d))),
        _CQ + f""",
hits AS (SELECT *, (row_number() OVER (PARTITION BY prev_quarter, curr_quarter ORDER BY ClientID) - 1) // {CH.PAGE_ROWS} AS page
         FROM al WHERE ({_TOOLS_LOST}) OR ({_TOOLS_NEW})),
pg AS (SELECT prev_quarter, curr_quarter, page,
              count_if({_TOOLS_LOST}) AS num_lost, count_if({_TOOLS_NEW}) AS num_new,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_LOST} THEN prev_revenue END), 0) AS DOUBLE) AS revenue_loss,
              CAST(COALESCE(SUM(CASE WHEN {_TOOLS_NEW} THEN curr_revenue END), 0) AS DOUBLE) AS revenue_gain
       FROM hits GROUP BY 1, 2, 3)
SELECT p.prev_quarter AS q_prev, p.curr_quarter AS q_curr, pg.page,
       CAST(COALESCE(pg.num_lost, 0) AS INTEGER) AS lost_customers,
       CAST(COALESCE(pg.num_new, 0) AS INTEGER) AS new_customers,
       COALESCE(pg.num_lost, 0) AS num_lost, COALESCE(pg.num_new, 0) AS num_new,
       COALESCE(pg.revenue_loss, 0.0) AS revenue_loss, COALESCE(pg.revenue_gain, 0.0) AS revenue_gain
FROM pairs p LEFT JOIN pg ON p.prev_quarter = pg.prev_quarter AND p.curr_quarter = pg.curr_quarter""")
    q["summary_to_json"] = (
        lambda s, d: EV.step_counters(load(s, d, "events")).select(
            FN.summary_to_json(F.col("event_type"),
                               F.struct("count", F.round("total_value", 2).alias("total_value"))).alias("json")),
        "SELECT CAST(to_json(struct_pack(step := event_type, summary := struct_pack(count := count(*), "
        "total_value := round(SUM(value), 2)))) AS VARCHAR) AS json FROM events GROUP BY event_type")


# ----------------------------------------------------------------- streaming
def _rev_files(spark, d):
    """The revenue view written as the files the streams consume: one per
    shuffle partition, by date, so no client's share decides a file's size.
    Returns path, schema and the files of a micro-batch (a quarter of all)."""
    path = scratch_path(spark, "rev-files")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    revenue_view(spark, d).repartitionByRange(n, "Date", "ClientID").write.parquet(path)
    return path, spark.read.parquet(path).schema, max(1, n // 4)


def _stream_table(spark, d, build, keys):
    from qtrlens.streaming import revenue_stream as ST
    src, schema, per = _rev_files(spark, d)
    out = scratch_path(spark, "stream-out")
    ST.run_to_table(build(ST.stream_revenue_files(spark, src, schema, max_files_per_trigger=per)), out,
                    scratch_path(spark, "stream-ckpt"))
    return ST.read_latest(spark, out, keys)


def _st_quarter_region(s, d):
    apply_conf(s)
    from qtrlens.streaming import revenue_stream as ST
    t = _stream_table(s, d, ST.stream_quarter_region, RV.GEO_KEYS)
    return _dbl(t, "TotalRevenue")


def _st_num_clients(s, d):
    apply_conf(s)
    from qtrlens.streaming import revenue_stream as ST
    return _stream_table(s, d, ST.stream_num_clients, RV.GEO_KEYS)


def _st_client_bitmaps(s, d):
    apply_conf(s)
    t = _stream_table(s, d, BM.stream_client_bitmaps, [*RV.GEO_KEYS, "bucket"])
    return BM.count_ids(t, RV.GEO_KEYS, "NumClients")


def _st_churn(s, d):
    apply_conf(s)
    from qtrlens.streaming import revenue_stream as ST
    state = _stream_table(s, d, ST.stream_client_quarterly, ["ClientID", "Quarter"])
    return CH.churn_counts(state)


def _st_breaker(s, d):
    """ST4 over loads that arrive in time order: five time ranges of the
    events, each written and then streamed on."""
    apply_conf(s)
    from qtrlens.streaming import revenue_stream as ST
    ev = load(s, d, "events")
    feed, out, ck = (scratch_path(s, x) for x in ("event-feed", "trips", "trips-ckpt"))
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    edges = [lo + (hi - lo) * i / 5 for i in range(1, 5)]
    for i in range(5):
        here = F.lit(True) if i == 0 else F.col("ts") >= F.lit(edges[i - 1])
        here = here if i == 4 else here & (F.col("ts") < F.lit(edges[i]))
        ev.where(here | F.col("ts").isNull() if i == 0 else here).write.mode("append").parquet(feed)
        ST.run_append_to_parquet(ST.stream_breaker_trips(ST.stream_revenue_files(
            s, feed, ev.schema, max_files_per_trigger=None)), out, ck)
    return s.read.parquet(out)


def _st_breaker_unordered(s, d):
    """ST4 over events that come up to a day late: five loads by the time of
    arrival, files within a load in any order, then a heartbeat that brings
    out what is held. The stream's delay covers the day and a load."""
    apply_conf(s)
    from qtrlens.streaming import breaker as BR
    from qtrlens.streaming import revenue_stream as ST
    day, n = 86400, int(s.conf.get("spark.sql.shuffle.partitions"))
    ev = load(s, d, "events")
    feed, out, ck = (scratch_path(s, x) for x in ("event-feed", "trips", "trips-ckpt"))
    arrival = F.unix_seconds(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(day))
    lo, hi, last = ev.agg(F.min(arrival), F.max(arrival), F.max("ts")).first()
    span = (hi - lo) // 5 + 1 if hi is not None else 1
    load_no = F.coalesce(F.floor((arrival - F.lit(lo)) / F.lit(span)), F.lit(0)).cast("int")
    loads = cut_lineage(ev.withColumn("_load", load_no), s, "event-loads")
    for i in range(5):
        loads.where(F.col("_load") == i).drop("_load").repartition(n).write.mode("append").parquet(feed)
    delay = day + span
    beat = {"event_type": F.lit(BR.HEARTBEAT), "ts": F.lit(last) + F.make_dt_interval(secs=F.lit(delay + 2 * day))}
    s.range(1).select(*(beat.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ev.schema)) \
        .write.mode("append").parquet(feed)
    BR.run_with_timers(BR.stream_breaker_ordered(ST.stream_revenue_files(
        s, feed, ev.schema, max_files_per_trigger=n), delay, slot_s=day), out, ck)
    return s.read.parquet(out)


def _st_idempotent(s, d):
    """ST5: the files replayed with a fresh checkpoint, and once more under
    another path."""
    apply_conf(s)
    from qtrlens.streaming import revenue_stream as ST
    src, schema, per = _rev_files(s, d)
    out, copy = scratch_path(s, "applied"), scratch_path(s, "rev-copy")
    # the same files under other paths: a partition per file, written as one
    s.read.schema(schema).option("mergeSchema", "false").parquet(src).withColumn("_f", F.input_file_name()) \
        .repartition("_f").write.partitionBy("_f").parquet(copy)
    for path in (src, src, copy):
        feed = ST.stream_revenue_files(s, path, schema, max_files_per_trigger=per).select(*schema.names)
        ST.idempotent_apply(s, feed, out, scratch_path(s, "apply-ckpt"))
    return _dbl(ST.read_applied(s, out), "Revenue")


def _st_totals(s, d):
    """ST6: the totals after the last batch."""
    apply_conf(s)
    from qtrlens.streaming import revenue_stream as ST
    src, schema, per = _rev_files(s, d)
    out = scratch_path(s, "totals")
    ST.stream_totals_check(ST.stream_revenue_files(s, src, schema, max_files_per_trigger=per), out,
                           scratch_path(s, "totals-ckpt"))
    t = ST.running_totals(s, out)
    return t.orderBy(F.desc("batch_id")).limit(1).select(
        F.col("input_total").cast("double").alias("input_total"), F.col("agg_total").cast("double").alias("agg_total"), "ok")


def _json_roundtrip(spark, df, name):
    """Write a table as JSON lines under the shared checkpoint folder and read
    it back with the same schema (arrays and structs keep their shape)."""
    path = SK.write_json(df, scratch_path(spark, name))
    return SK.read_json(spark, path, df.schema)


def _bundle_violations(s, d):
    """V6: the churn entries of a bundle with violations planted by their
    counts, and no other section."""
    j, n = F.to_json(F.struct("revenue_loss", "revenue_gain", "lost_customers", "new_customers")), F.col("lost_customers") % 5
    bad = (F.when(n == 1, F.regexp_replace(j, '"revenue_gain"', '"gain"'))
            .when(n == 2, F.regexp_replace(j, '"lost_customers":(\\d+)', '"lost_customers":"$1"'))
            .when(n == 3, F.regexp_replace(j, "[}]$", "")).when(n == 4, F.concat(F.lit("["), j, F.lit("]"))).otherwise(j))
    entries = CH.churn_counts(_cq(s, d)).select(
        F.lit("churn_report").alias("section"), F.concat_ws("_to_", "prev_quarter", "curr_quarter").alias("key"), bad.alias("json"))
    return VA.bundle_violations(_json_roundtrip(s, entries, "planted"))


def _run_metrics(s, d):
    """The metrics that a whole report run observed while writing."""
    apply_conf(s)
    out = scratch_path(s, "report")
    from qtrlens.plans.report import revenue_churn_report
    revenue_churn_report(_rev(s, d), out_dir=out)
    return SK.read_json(s, f"{out}/run_metrics", "step string, rows long, amount double").withColumn(
        "amount", F.round("amount", 2))


def _bundle(s, d):
    """The bundle written as JSON lines, read back, and its entries
    summed up per section and key."""
    apply_conf(s)
    cq = CH.stored_client_quarters(_cq(s, d))
    agg = RV.group_by_quarter(_cq(s, d), year_blind=False)
    checks = VA.check_result("churn", VA.churn_reconciles(cq), "reconciles")
    bundle = _json_roundtrip(s, SK.export_bundle(["load", "aggregate", "churn", "validate"], agg,
                                                 RV.client_quarterly_revenue(cq, PIVOT_QUARTERS),
                                                 CH.churn_counts(cq), checks), "bundle")
    j = F.col("json")
    per_quarter = F.from_json(j, "array<struct<TotalRevenue:double,NumClients:long>>")
    cells = F.map_values(F.from_json(j, "map<string,double>"))
    entry = F.from_json(j, "struct<lost_customers:long,revenue_loss:double,ok:boolean,step:string>")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    n = (F.when(F.col("section") == "quarterly", F.size(per_quarter).cast("long"))
          .when(F.col("section") == "pivot", F.size(F.filter(cells, lambda x: x != 0)).cast("long"))
          .when(F.col("section") == "churn_report", entry["lost_customers"])
          .when(F.col("section") == "validations", entry["ok"].cast("long"))
          .when(F.col("section") == "plan", F.length(entry["step"]).cast("long")))
    amount = (F.when(F.col("section") == "quarterly", total(per_quarter["TotalRevenue"]))
               .when(F.col("section") == "pivot", total(cells))
               .when(F.col("section") == "churn_report", entry["revenue_loss"]))
    return bundle.select("section", "key", n.alias("n"), F.round(amount, 2).alias("amount"))


def _report(name):
    """One of the report's tables (the whole run, tools path)."""
    def run(s, d):
        apply_conf(s)
        from qtrlens.plans.report import revenue_churn_report
        return revenue_churn_report(_rev(s, d))[name]
    return run


def _summaries(s, d):
    """The latest summary per user saved as a version and read back."""
    apply_conf(s)
    base = scratch_path(s, "summaries")
    path = SK.save_summaries(load(s, d, "events"), base, "v1", key=["user_id"])
    return s.read.parquet(path)


_SINKS = {
    "report_run_metrics": (_run_metrics, lambda of: f"""
SELECT 'quarterly' AS step, count(*) AS rows, round(sum(TotalRevenue), 2) AS amount FROM {of("aggregate_by_quarter_region")} q
UNION ALL SELECT 'pivot', count(DISTINCT o_custkey), 0.0 FROM orders WHERE o_orderdate IS NOT NULL
UNION ALL SELECT 'churn_counts', count(*), CAST(sum(lost_customers + new_customers) AS DOUBLE) FROM {of("churn_counts_tools")} c
UNION ALL SELECT 'churn_report', count(*), 0.0 FROM {of("churn_lists")} l
UNION ALL SELECT 'validations', 2, 2.0"""),
    "contract_violations": (_bundle_violations, lambda of: f"""
WITH c AS (SELECT prev_quarter || '_to_' || curr_quarter AS key, lost_customers % 5 AS n FROM {of("churn_counts")} x)
SELECT 'churn_report' AS section, key,
       CASE n WHEN 1 THEN 'revenue_gain' WHEN 2 THEN 'lost_customers' END AS field,
       CASE n WHEN 1 THEN 'missing' WHEN 2 THEN 'not an integer' WHEN 3 THEN 'not JSON' ELSE 'not an object' END AS problem
FROM c WHERE n > 0
UNION ALL SELECT s, NULL, NULL, 'section is missing' FROM (VALUES ('plan'), ('quarterly'), ('pivot'), ('validations')) v(s)"""),
    "report_churn_counts": (_report("churn_report"), "@churn_counts_tools"),
    "report_quarterly": (_report("quarterly"), "@aggregate_by_quarter_region"),
    "report_churn_lists": (_report("churn_lists"), "@churn_lists"),
    "report_reflections": (_report("reflections"), "@churn_flags"),
    "report_suggestions": (_report("suggestions"), "@retention_suggestions"),
    "report_validations": (
        _report("validations"),
        "SELECT 'quarterly' AS \"check\", count(*) >= 0 AS ok FROM orders UNION ALL "
        "SELECT 'churn', bool_and(o_totalprice > 0) FROM orders"),
    "report_actions": (
        _report("actions"),
        "SELECT 'accept' AS action, 'all checks passed' AS reason FROM orders HAVING bool_and(o_totalprice > 0)"),
    "save_summaries": (_summaries, "@latest_summaries"),
    # the alignment-based plan of A9, checked against the same oracle
    "churn_counts_aligned": (lambda s, d: CH.churn_counts_aligned(_cq(s, d)), "@churn_counts"),
    "write_churn_report": (
        lambda s, d: _json_roundtrip(s, CH.churn_lists(_cq(s, d)), "churn-report"),
        "@churn_lists"),
    "write_run_metrics": (
        lambda s, d: _json_roundtrip(s, EV.step_counters(load(s, d, "events")), "run-metrics"),
        "SELECT event_type, count(*) AS count, SUM(value) AS total_value FROM events GROUP BY event_type"),
    "export_bundle": (_bundle, _CQ + """,
qr AS (SELECT Quarter, Region, Country, SUM(Revenue) AS r FROM revq GROUP BY ALL),
cc AS (SELECT prev_quarter, curr_quarter, count_if(prev_revenue > 0 AND curr_revenue = 0) AS n,
              COALESCE(SUM(CASE WHEN prev_revenue > 0 AND curr_revenue = 0 THEN prev_revenue END), 0) AS r
       FROM al GROUP BY ALL)
SELECT 'quarterly' AS section, Quarter AS key, count(*) AS n, round(CAST(SUM(r) AS DOUBLE), 2) AS amount FROM qr GROUP BY Quarter
UNION ALL SELECT 'pivot', CAST(ClientID AS VARCHAR), count(*), round(CAST(SUM(Revenue) AS DOUBLE), 2) FROM cq GROUP BY ClientID
UNION ALL SELECT 'churn_report', prev_quarter || '_to_' || curr_quarter, n, round(CAST(r AS DOUBLE), 2) FROM cc
UNION ALL SELECT 'validations', 'churn', 1, NULL
UNION ALL SELECT * FROM (VALUES ('plan', '000', 4, NULL), ('plan', '001', 9, NULL), ('plan', '002', 5, NULL),
                                ('plan', '003', 8, NULL)) p"""),
}

_STREAM = {
    "stream_quarter_region": (_st_quarter_region, _REVQ + """
SELECT Quarter, Region, Country, CAST(SUM(Revenue) AS DOUBLE) AS TotalRevenue, COUNT(Revenue) AS NumRows
FROM revq GROUP BY Quarter, Region, Country"""),
    "stream_num_clients": (_st_num_clients, _REVQ + """
SELECT Quarter, Region, Country, COUNT(DISTINCT ClientID) AS NumClients FROM revq GROUP BY Quarter, Region, Country"""),
    "stream_client_bitmaps": (_st_client_bitmaps, "@stream_num_clients"),
    "stream_churn_counts": (_st_churn, _CQ + _COUNTS_SELECT),
    "stream_breaker_trips": (_st_breaker, _BREAKER_SQL + "\nSELECT user_id, trip_at, open_until, false AS late FROM trips"),
    "stream_breaker_unordered": (_st_breaker_unordered, "@stream_breaker_trips"),
    "idempotent_apply": (_st_idempotent,
                         _REV + "\nSELECT ClientID, Region, Country, Date, CAST(Revenue AS DOUBLE) AS Revenue FROM rev"),
    "stream_totals_check": (_st_totals, _REV + """
SELECT CAST(SUM(Revenue) AS DOUBLE) AS input_total, CAST(SUM(Revenue) AS DOUBLE) AS agg_total, true AS ok FROM rev"""),
}

def _registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """All keys: batch operators, streams and sink round trips. The second
    item is the DuckDB oracle text, ``None`` for a rows-only check, or
    ``@key`` to reuse another key's oracle."""
    q = _batch_registry()
    q.update(_STREAM)
    q.update(_SINKS)
    if LLM is not None:
        q.update(LLM.QUERIES)
        q["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
    return q
