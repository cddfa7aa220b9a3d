"""Churn between consecutive observed quarters (J1–J5, W1, A9–A11, T1, V8,
V9, R1, U1–U3).

Plan shape. The quarter index (distinct labels with their neighbours) is
joined without a hint: it is as small as the calendar for date labels, so AQE
broadcasts it by its measured size, and a caller's own labels may be many.

The client alignment does not pivot and does not full-outer-join quarter
pairs. Each (client, quarter, revenue) row is emitted twice: once as the
*previous* side of the pair that starts at its quarter and once as the
*current* side of the pair that ends there. One ``groupBy(client, pair)``
then yields ``prev_revenue`` and ``curr_revenue`` for every client active in
either quarter of every pair — the sparse equivalent of the zero-filled
pivot. Partial aggregation runs before the shuffle, so a client holding a
large share of all rows is collapsed map-side.

The pair counts (``churn_counts``) do not need the per-client rows at all:
they come from one pass with per-client neighbours and a small statistics
table, see its docstring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pair_label
from ..session import cut_lineage
from .revenue import client_quarterly_long, money_sum, quarter_range, with_quarter

CORE = "core"
TOOLS = "tools"
PAGE_ROWS = 1000            # clients per page of an id list

# ---------------------------------------------------------------- fixed values
NOTE_SIGNIFICANT = "significant_loss"
NOTE_STABLE = "stable"
SIGNIFICANT_LOSS_FACTOR = 2
RETENTION_SUGGESTION = "Investigate top lost clients and run retention offers."
# -----------------------------------------------------------------------------


def quarter_index(df: DataFrame, col: str = "Quarter") -> DataFrame:
    """Distinct labels with their observed neighbours: ``(Quarter, before,
    after, qi, quarter_total)``. Consecutive means consecutive among labels present in the
    data (a quarter with no rows is skipped), as in the reference."""
    if "Revenue" in df.columns:
        # carrying the quarter total keeps this branch's input identical to
        # the caller's, so Spark reuses the scan/shuffle below it
        q = df.where(F.col(col).isNotNull()).groupBy(col).agg(
            F.sum("Revenue").alias("quarter_total"))
    else:
        q = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn(
            "quarter_total", F.lit(None).cast("decimal(38,2)"))
    w = Window.orderBy(col)  # one row per distinct label
    idx = q.select(
        F.col(col), "quarter_total",
        F.lag(col).over(w).alias("before"),
        F.lead(col).over(w).alias("after"),
        (F.row_number().over(w) - 1).alias("qi"),
    )
    return idx.select(col, "before", "after", "qi", "quarter_total")


def quarter_pairs(df: DataFrame) -> DataFrame:
    """Consecutive observed labels ``(pair_index, prev_quarter, curr_quarter)``."""
    idx = quarter_index(with_quarter(df))
    return idx.where(F.col("after").isNotNull()).select(
        F.col("qi").alias("pair_index"),
        F.col("Quarter").alias("prev_quarter"),
        F.col("after").alias("curr_quarter"))


def _client_quarters(df: DataFrame, client_col: str) -> DataFrame:
    """A3, written once to the checkpoint folder (a table that
    ``stored_client_quarters`` has written already is used as it is). Both the
    quarter index and the per-client rows read it; left lazy, Catalyst would
    prune the index branch into a second, narrower pass over the whole input."""
    if getattr(df, "_client_quarters_of", None) == client_col:
        return df
    return stored_client_quarters(df, client_col)


def stored_client_quarters(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """A3 written to the checkpoint folder and marked, so that every churn
    function given it reads that one table."""
    out = cut_lineage(client_quarterly_long(df, client_col), df.sparkSession, "client-quarters")
    out._client_quarters_of = client_col
    return out


def _aligned(df: DataFrame, client_col: str) -> tuple[DataFrame, DataFrame]:
    cq = _client_quarters(df, client_col)
    rtype = cq.schema["Revenue"].dataType
    idx = quarter_index(cq)
    x = cq.join(idx.drop("quarter_total", "qi"), "Quarter")
    none = F.lit(None).cast(rtype)
    sides = F.explode(F.array(
        F.struct(F.col("Quarter").alias("pq"), F.col("after").alias("cq"),
                 F.col("Revenue").alias("p"), none.alias("c")),
        F.struct(F.col("before").alias("pq"), F.col("Quarter").alias("cq"),
                 none.alias("p"), F.col("Revenue").alias("c")),
    ))
    y = (x.select(client_col, sides.alias("e"))
          .select(client_col, "e.*")
          .where(F.col("pq").isNotNull() & F.col("cq").isNotNull()))
    al = y.groupBy(client_col, F.col("pq").alias("prev_quarter"),
                   F.col("cq").alias("curr_quarter")).agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("prev_revenue"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("curr_revenue"))
    return al, idx


def period_compare(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """W1 / J1 for all pairs: ``(client, prev_quarter, curr_quarter,
    prev_revenue, curr_revenue)`` for every client with a row in either
    quarter of each consecutive pair. Accepts raw rows or A3 output.

    On a cluster the revenue rows arrive hash-partitioned by client (the
    orders ⋈ customer shuffle); A3 and the pair aggregation both cluster on
    the client, so Spark adds no further shuffle of the large side."""
    return _aligned(df, client_col)[0]


def churn_predicates(mode: str = CORE, p: str = "prev_revenue",
                     c: str = "curr_revenue") -> tuple[Column, Column]:
    """(lost, new) conditions. They differ only for negative revenue:
    core: lost = prev > 0 and curr == 0; new = prev == 0 and curr > 0.
    tools: lost = prev > 0 and not curr > 0; new = curr > 0 and not prev > 0."""
    return _predicates(mode, F.col(p), F.col(c))


def _predicates(mode: str, pv: Column, cv: Column) -> tuple[Column, Column]:
    if mode == CORE:
        return (pv > 0) & (cv == 0), (pv == 0) & (cv > 0)
    if mode == TOOLS:
        return (pv > 0) & ~(cv > 0), (cv > 0) & ~(pv > 0)
    raise ValueError(f"mode must be '{CORE}' or '{TOOLS}'")


def churn_counts(df: DataFrame, mode: str = CORE, client_col: str = "ClientID") -> DataFrame:
    """Per consecutive pair — lost and new counts, lost and gained
    revenue, and both period totals.

    One pass over the client × quarter table. A per-client window (at most
    one row per quarter per client) gives every row its client's next and
    previous observed quarter. One aggregate keyed by (quarter, neighbour)
    keeps the row's contribution under both cases — the client has a row in
    the next observed quarter, or not — and which case holds is decided per
    pair afterwards, on tables whose size depends only on the number of
    quarters. The quarter index comes from that small aggregate, which is
    written once to the checkpoint folder, so the base data is read once."""
    cq = df if getattr(df, "_client_quarters_of", None) == client_col else client_quarterly_long(df, client_col)
    w = Window.partitionBy(client_col).orderBy("Quarter")
    x = cq.select("Quarter", "Revenue",
                  F.lead("Quarter").over(w).alias("nq"), F.lead("Revenue").over(w).alias("nr"),
                  F.lag("Quarter").over(w).alias("pq"))
    r, nr = F.col("Revenue"), F.col("nr")
    zero = F.lit(0).cast(cq.schema["Revenue"].dataType)
    lost_c, new_c = _predicates(mode, r, nr)          # client also in the next quarter
    lost_g, _ = _predicates(mode, r, zero)            # client absent from the next quarter
    _, new_b = _predicates(mode, zero, r)             # client absent from the previous quarter

    def cnt(c):
        return F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")

    def amt(c, v):
        return F.when(c, v).otherwise(zero)
    rec = F.explode(F.array(
        F.struct(F.lit("A").alias("kind"), F.col("nq").alias("other"), cnt(lost_c).alias("lc"),
                 cnt(new_c).alias("nc"), amt(lost_c, r).alias("loss_c"), amt(new_c, nr).alias("gain_c"),
                 cnt(lost_g).alias("lg"), amt(lost_g, r).alias("loss_g"), r.alias("total")),
        F.struct(F.lit("B").alias("kind"), F.col("pq").alias("other"), F.lit(0).cast("long").alias("lc"),
                 cnt(new_b).alias("nc"), zero.alias("loss_c"), amt(new_b, r).alias("gain_c"),
                 F.lit(0).cast("long").alias("lg"), zero.alias("loss_g"), zero.alias("total")),
    ))
    stats = (x.select("Quarter", rec.alias("e")).select("Quarter", "e.*")
              .groupBy("kind", "Quarter", "other")
              .agg(*[F.sum(c).alias(c) for c in ("lc", "nc", "loss_c", "gain_c", "lg", "loss_g", "total")]))
    # at most two rows per (quarter, neighbour quarter): written once so the
    # three small consumers below do not each re-run the pass over the data
    stats = cut_lineage(stats, df.sparkSession, "churn-stats")
    # quarter index and totals from the small stats table
    qt = stats.where(F.col("kind") == "A").groupBy("Quarter").agg(F.sum("total").alias("quarter_total"))
    idx = quarter_index(qt.withColumnRenamed("quarter_total", "Revenue"))
    pairs = idx.select(F.col("Quarter").alias("prev_quarter"), F.col("after").alias("curr_quarter"),
                       F.col("quarter_total").alias("total_prev"),
                       F.lead("quarter_total").over(Window.orderBy("Quarter")).alias("total_curr")
                       ).where(F.col("curr_quarter").isNotNull())
    a = stats.where(F.col("kind") == "A").join(pairs, F.col("Quarter") == F.col("prev_quarter"))
    cont = F.col("other") == F.col("curr_quarter")
    contrib_a = a.select("prev_quarter", "curr_quarter",
                         F.when(cont, F.col("lc")).otherwise(F.col("lg")).alias("lost"),
                         F.when(cont, F.col("nc")).otherwise(F.lit(0)).alias("new"),
                         F.when(cont, F.col("loss_c")).otherwise(F.col("loss_g")).alias("loss"),
                         F.when(cont, F.col("gain_c")).otherwise(zero).alias("gain"))
    b = (stats.where(F.col("kind") == "B").join(pairs, F.col("Quarter") == F.col("curr_quarter"))
              .where(F.col("other").isNull() | (F.col("other") != F.col("prev_quarter"))))
    contrib_b = b.select("prev_quarter", "curr_quarter", F.lit(0).cast("long").alias("lost"),
                         F.col("nc").alias("new"), zero.alias("loss"), F.col("gain_c").alias("gain"))
    counts = contrib_a.unionByName(contrib_b).groupBy("prev_quarter", "curr_quarter").agg(
        F.sum("lost").alias("lost_customers"), F.sum("new").alias("new_customers"),
        money_sum("loss").alias("revenue_loss"), money_sum("gain").alias("revenue_gain"))
    totals = pairs.select("prev_quarter", "curr_quarter",
                          F.coalesce("total_prev", F.lit(0)).cast("double").alias("total_prev_revenue"),
                          F.coalesce("total_curr", F.lit(0)).cast("double").alias("total_curr_revenue"))
    return counts.join(totals, ["prev_quarter", "curr_quarter"])


def churn_counts_aligned(df: DataFrame, mode: str = CORE, client_col: str = "ClientID") -> DataFrame:
    """A9 from the explicit per-client alignment (W1); same result as
    ``churn_counts``, kept as an independent cross-check."""
    al, idx = _aligned(df, client_col)
    lost, new = churn_predicates(mode)
    counts = al.groupBy("prev_quarter", "curr_quarter").agg(
        F.count_if(lost).alias("lost_customers"),
        F.count_if(new).alias("new_customers"),
        money_sum(F.when(lost, F.col("prev_revenue"))).alias("revenue_loss"),
        money_sum(F.when(new, F.col("curr_revenue"))).alias("revenue_gain"),
    )
    w = Window.orderBy("Quarter")
    totals = idx.select(
        F.col("Quarter").alias("prev_quarter"), F.col("after").alias("curr_quarter"),
        F.coalesce(F.col("quarter_total"), F.lit(0)).cast("double").alias("total_prev_revenue"),
        F.coalesce(F.lead("quarter_total").over(w), F.lit(0)).cast("double").alias("total_curr_revenue"),
    ).where(F.col("curr_quarter").isNotNull())
    return counts.join(totals, ["prev_quarter", "curr_quarter"])


def churn_rows(df: DataFrame, mode: str = TOOLS, client_col: str = "ClientID") -> DataFrame:
    """One row per (pair, client) that was lost or new, with the amount
    (previous revenue when lost, current revenue when new)."""
    al = period_compare(df, client_col)
    lost, new = churn_predicates(mode)
    status = F.when(lost, F.lit("lost")).when(new, F.lit("new"))
    amount = F.when(lost, F.col("prev_revenue")).otherwise(F.col("curr_revenue"))
    return (al.select("prev_quarter", "curr_quarter", client_col,
                      status.alias("status"), amount.cast("double").alias("amount"))
              .where(F.col("status").isNotNull()))


def churn_lists(df: DataFrame, mode: str = TOOLS, client_col: str = "ClientID",
                page_rows: int = PAGE_ROWS) -> DataFrame:
    """A10: per pair, the lost and new client ids as sorted arrays, with
    counts and amounts, in pages of ``page_rows`` clients in id order.

    An id list can be as long as the client base, so it is never one array:
    the lost and new clients get a global row number (``global_row_index``:
    range partitions with offsets, no pair in one task), and a pair's page is
    its clients' position over ``page_rows``. Summing a pair's pages gives the
    pair totals. A pair with no lost and no new client keeps one row with
    ``page`` null and empty lists.
    """
    from ..sources.chunks import global_row_index

    al, idx = _aligned(df, client_col)
    lost, new = churn_predicates(mode)
    hit = al.where(lost | new).select("prev_quarter", "curr_quarter", client_col, "prev_revenue", "curr_revenue")
    hit = global_row_index(hit, ["prev_quarter", "curr_quarter", client_col], out="_row")
    first = hit.groupBy("prev_quarter", "curr_quarter").agg(F.min("_row").alias("_first"))
    hit = hit.join(first, ["prev_quarter", "curr_quarter"])
    page = F.floor((F.col("_row") - F.col("_first")) / F.lit(page_rows)).cast("long")
    pages = (hit.groupBy("prev_quarter", "curr_quarter", page.alias("page")).agg(
                   F.sort_array(F.collect_list(F.when(lost, F.col(client_col)))).alias("lost_customers"),
                   F.sort_array(F.collect_list(F.when(new, F.col(client_col)))).alias("new_customers"),
                   F.count_if(lost).alias("num_lost"),
                   F.count_if(new).alias("num_new"),
                   money_sum(F.when(lost, F.col("prev_revenue"))).alias("revenue_loss"),
                   money_sum(F.when(new, F.col("curr_revenue"))).alias("revenue_gain")))
    pairs = idx.where(F.col("after").isNotNull()).select(F.col("Quarter").alias("prev_quarter"),
                                                         F.col("after").alias("curr_quarter"))
    out = pairs.join(pages, ["prev_quarter", "curr_quarter"], "left")
    empty = F.array().cast(f"array<{df.schema[client_col].dataType.simpleString()}>")
    return out.select(
        F.col("prev_quarter").alias("q_prev"), F.col("curr_quarter").alias("q_curr"), "page",
        F.coalesce("lost_customers", empty).alias("lost_customers"),
        F.coalesce("new_customers", empty).alias("new_customers"),
        F.coalesce("num_lost", F.lit(0)).alias("num_lost"),
        F.coalesce("num_new", F.lit(0)).alias("num_new"),
        F.coalesce("revenue_loss", F.lit(0.0)).alias("revenue_loss"),
        F.coalesce("revenue_gain", F.lit(0.0)).alias("revenue_gain"))


# --------------------------------------------------------------- single pair

def _of_quarters(df: DataFrame, labels: list[str], client_col: str) -> DataFrame:
    """Rows of some quarters with a non-null client. A feed with dates and
    ``YYYYQn`` labels is filtered by date ranges, which reach the scan."""
    if "Quarter" in df.columns:
        rows = df.where(F.col("Quarter").isin(labels))
    else:
        wanted = F.lit(False)
        for q in labels:
            lo, hi = quarter_range(q)
            wanted = wanted | ((F.col("Date") >= F.lit(lo)) & (F.col("Date") < F.lit(hi)))
        rows = with_quarter(df.where(wanted))
    return rows.where(F.col(client_col).isNotNull())


def align_periods(df: DataFrame, q_prev: str, q_curr: str,
                  client_col: str = "ClientID") -> DataFrame:
    """Two quarters side by side per client, missing = 0. One read of the
    two quarters' rows and one aggregate with two conditional sums."""
    rows = _of_quarters(df, [q_prev, q_curr], client_col)
    side = lambda q: F.coalesce(F.sum(F.when(F.col("Quarter") == q, F.col("Revenue"))), F.lit(0))
    return rows.groupBy(client_col).agg(side(q_prev).alias("prev_revenue"), side(q_curr).alias("curr_revenue"))


def top_lost_clients(df: DataFrame, q_prev: str, q_curr: str, n: int = 10,
                     client_col: str = "ClientID") -> DataFrame:
    """Clients with prev > 0 and curr == 0, the ``n`` largest by previous
    revenue (ties by id). Raises ``ValueError`` when a label is absent (found
    by looking for one row of each quarter)."""
    missing = [q for q in (q_prev, q_curr) if _of_quarters(df, [q], client_col).isEmpty()]
    if missing:
        raise ValueError(f"Requested quarters not present: {missing}")
    al = align_periods(df, q_prev, q_curr, client_col)
    lost = al.where((F.col("prev_revenue") > 0) & (F.col("curr_revenue") == 0))
    return (lost.orderBy(F.desc("prev_revenue"), client_col).limit(n)
                .select(client_col, F.col("prev_revenue").cast("double").alias("prev_revenue")))


def top_lost_clients_all_pairs(df: DataFrame, n: int = 10, client_col: str = "ClientID") -> DataFrame:
    """T1 for every consecutive pair: ``row_number() <= n`` per pair, which
    Spark plans with a per-partition group limit before the shuffle, so each
    pair's final sort sees at most ``n`` rows per input partition."""
    al = period_compare(df, client_col)
    lost, _ = churn_predicates(CORE)
    w = Window.partitionBy("prev_quarter", "curr_quarter").orderBy(F.desc("prev_revenue"), client_col)
    return (al.where(lost)
              .withColumn("rank", F.row_number().over(w))
              .where(F.col("rank") <= n)
              .select("prev_quarter", "curr_quarter", "rank", client_col,
                      F.col("prev_revenue").cast("double").alias("prev_revenue")))


# ---------------------------------------------------- set forms

def active_by_pair(df: DataFrame, client_col: str = "ClientID") -> tuple[DataFrame, DataFrame]:
    """Active (revenue > 0) client sets keyed by pair, as the previous side
    and as the current side: ``(client, prev_quarter, curr_quarter, Revenue)``."""
    cq = _client_quarters(df, client_col)
    idx = quarter_index(cq)
    a = cq.where(F.col("Revenue") > 0).join(idx, "Quarter")
    as_prev = a.where(F.col("after").isNotNull()).select(
        client_col, F.col("Quarter").alias("prev_quarter"), F.col("after").alias("curr_quarter"), "Revenue")
    as_curr = a.where(F.col("before").isNotNull()).select(
        client_col, F.col("before").alias("prev_quarter"), F.col("Quarter").alias("curr_quarter"), "Revenue")
    return as_prev, as_curr


def _keys(client_col: str) -> list[str]:
    return [client_col, "prev_quarter", "curr_quarter"]


def lost_clients(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """Active in the previous quarter and not in the current (anti join)."""
    as_prev, as_curr = active_by_pair(df, client_col)
    return as_prev.join(as_curr.select(_keys(client_col)), _keys(client_col), "left_anti").select(
        *_keys(client_col))


def new_clients(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """Active in the current quarter and not in the previous (anti join)."""
    as_prev, as_curr = active_by_pair(df, client_col)
    return as_curr.join(as_prev.select(_keys(client_col)), _keys(client_col), "left_anti").select(
        *_keys(client_col))


def retained_clients(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """Active in both quarters (semi join)."""
    as_prev, as_curr = active_by_pair(df, client_col)
    return as_prev.join(as_curr.select(_keys(client_col)), _keys(client_col), "left_semi").select(
        *_keys(client_col))


def churn_amounts(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """Revenue lost and gained per pair: two conditional sums over the
    aligned rows (W1), by activity in either quarter."""
    al = period_compare(df, client_col)
    lost, new = churn_predicates(TOOLS)
    return al.groupBy("prev_quarter", "curr_quarter").agg(
        money_sum(F.when(lost, F.col("prev_revenue"))).alias("revenue_loss"),
        money_sum(F.when(new, F.col("curr_revenue"))).alias("revenue_gain"))


def lost_by_except(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """The lost set as a multiset difference of id sets."""
    as_prev, as_curr = active_by_pair(df, client_col)
    k = _keys(client_col)
    return as_prev.select(k).exceptAll(as_curr.select(k))


def active_in_either(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """Clients active in the previous or the current quarter of a pair."""
    as_prev, as_curr = active_by_pair(df, client_col)
    k = _keys(client_col)
    return as_prev.select(k).unionByName(as_curr.select(k)).distinct()


def client_sets(df: DataFrame, load_col: str, client_col: str = "ClientID") -> DataFrame:
    """U2 (first half): the client ids of every load, ``(load, client)``, to
    be kept beside the loads."""
    return df.where(F.col(client_col).isNotNull()).select(load_col, client_col).distinct()


def union_client_sets(sets: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """The union of the client id sets of all loads."""
    return sets.select(client_col).where(F.col(client_col).isNotNull()).distinct()


# ------------------------------------------------------- flags and reporting

def churn_flags(counts: DataFrame) -> DataFrame:
    """V8: ``net_change = gain - loss``; ``significant_loss`` when the loss is
    more than twice the gain and positive, else ``stable``."""
    loss, gain = F.col("revenue_loss"), F.col("revenue_gain")
    prev = "prev_quarter" if "prev_quarter" in counts.columns else "q_prev"
    curr = "curr_quarter" if "curr_quarter" in counts.columns else "q_curr"
    note = F.when((loss > gain * SIGNIFICANT_LOSS_FACTOR) & (loss > 0),
                  F.lit(NOTE_SIGNIFICANT)).otherwise(F.lit(NOTE_STABLE))
    return counts.select(pair_label(prev, curr).alias("pair"),
                         (gain - loss).alias("net_change"), note.alias("note"))


def retention_suggestions(flags: DataFrame) -> DataFrame:
    """V9: a fixed suggestion for every pair flagged ``significant_loss``."""
    return flags.where(F.col("note") == NOTE_SIGNIFICANT).select(
        "pair", F.lit(RETENTION_SUGGESTION).alias("suggestion"))


def churn_trend_data(counts: DataFrame) -> DataFrame:
    """Long chart data ``(period, type, amount)``."""
    prev = "prev_quarter" if "prev_quarter" in counts.columns else "q_prev"
    curr = "curr_quarter" if "curr_quarter" in counts.columns else "q_curr"
    base = counts.select(pair_label(prev, curr).alias("period"),
                         F.col("revenue_loss").cast("double").alias("revenue_loss"),
                         F.col("revenue_gain").cast("double").alias("revenue_gain"))
    return base.unpivot(["period"], ["revenue_loss", "revenue_gain"], "type", "amount")
