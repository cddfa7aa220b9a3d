"""Revenue aggregation operators.

Every function takes a long revenue DataFrame and returns a DataFrame; they
compose with ``DataFrame.transform``. Money is summed exactly (the decimal
input type) and only cast to double in the output columns.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import quarter_label, quarter_of_year_label

GEO_KEYS = ["Quarter", "Region", "Country"]


def money_sum(c: str | Column) -> Column:
    """Sum that is 0, not null, over an empty or all-null group (N5), as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c), F.lit(0)).cast("double")


def with_quarter(df: DataFrame, date_col: str = "Date", year_blind: bool = False,
                 out: str = "Quarter") -> DataFrame:
    """Add a quarter label unless one is already there.

    Raises ``ValueError`` when neither the label nor the date column exists.
    """
    if out in df.columns:
        return df
    if date_col not in df.columns:
        raise ValueError(f"DataFrame must contain either '{out}' or '{date_col}'")
    label = quarter_of_year_label(date_col) if year_blind else quarter_label(date_col)
    return df.withColumn(out, label)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with a null grouping key take no part in a grouped result."""
    return df.na.drop(subset=list(keys))


def aggregate_by_quarter_region(df: DataFrame, rows_col: str | None = None, exact: bool = False) -> DataFrame:
    """A1: revenue sum and non-null revenue count by quarter, region, country.
    ``exact`` keeps the sum in the input's own (decimal) type.

    ``rows_col`` names a per-row count when the input is already partly
    aggregated (e.g. one row per client and quarter); ``NumRows`` then sums
    it, so the result equals aggregating the underlying rows."""
    df = drop_null_keys(with_quarter(df), GEO_KEYS)
    n = F.count("Revenue") if rows_col is None else F.coalesce(F.sum(rows_col), F.lit(0)).cast("long")
    total = F.coalesce(F.sum("Revenue"), F.lit(0)) if exact else money_sum("Revenue")
    return df.groupBy(*GEO_KEYS).agg(total.alias("TotalRevenue"), n.alias("NumRows"))


def group_by_quarter(df: DataFrame, year_blind: bool = True,
                     client_col: str = "ClientID", exact: bool = False) -> DataFrame:
    """A2: revenue sum and distinct clients by quarter, region, country
    (``exact`` as in A1).

    ``year_blind=True`` gives ``Qn`` labels (years merged), as the core path
    does; pass ``False`` for ``YYYYQn``. Null client ids are not counted.
    """
    df = drop_null_keys(with_quarter(df, year_blind=year_blind), GEO_KEYS)
    total = F.coalesce(F.sum("Revenue"), F.lit(0)) if exact else money_sum("Revenue")
    return df.groupBy(*GEO_KEYS).agg(total.alias("TotalRevenue"),
                                     F.count_distinct(client_col).alias("NumClients"))


def client_quarterly_long(df: DataFrame, client_col: str = "ClientID",
                          year_blind: bool = False) -> DataFrame:
    """A3: ``(ClientID, Quarter, Revenue)`` summed; the canonical client table.

    Map-side partial aggregation collapses a hot client's rows per partition
    before the shuffle, so one client holding a third of the rows does not
    become one oversized task.
    """
    df = drop_null_keys(with_quarter(df, year_blind=year_blind), [client_col, "Quarter"])
    return df.groupBy(client_col, "Quarter").agg(
        F.coalesce(F.sum("Revenue"), F.lit(0)).alias("Revenue"))


def quarter_labels(df: DataFrame, col: str = "Quarter") -> list[str]:
    """Sorted distinct labels as a Python list (for pivot column names).

    Bounded by the calendar (four per year), never by the row count.
    """
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()
    return [r[0] for r in rows]


def client_quarterly_revenue(df: DataFrame, labels: Sequence[str] | None = None,
                             client_col: str = "ClientID", year_blind: bool = False) -> DataFrame:
    """A4: one row per client, one column per quarter, gaps = 0.

    Passing ``labels`` avoids the extra job that discovers them; a quarter
    outside them raises. This wide form is for serving; churn works on the
    long form (A3).
    """
    long = client_quarterly_long(df, client_col, year_blind)
    if labels is None:
        labels = quarter_labels(long)
    else:
        known = F.col("Quarter").isNull() | F.col("Quarter").isin(list(labels))
        long = long.withColumn("Quarter", F.when(known, F.col("Quarter")).otherwise(F.raise_error(
            F.concat(F.lit("quarter outside the pivot's labels: "), F.col("Quarter")))))
    wide = long.groupBy(client_col).pivot("Quarter", list(labels)).agg(F.first("Revenue"))
    return wide.select(client_col, *[F.coalesce(F.col(f"`{q}`"), F.lit(0)).cast("double").alias(q)
                                     for q in labels])


def total_revenue(df: DataFrame) -> DataFrame:
    """A5: one row ``(total_revenue, num_rows)``."""
    return df.agg(money_sum("Revenue").alias("total_revenue"),
                  F.count(F.lit(1)).alias("num_rows"))


def quarterly_totals(agg: DataFrame) -> DataFrame:
    """Total of ``TotalRevenue`` per quarter over A1/A2 output.

    The per-group totals arrive as double; they are summed as
    ``decimal(38,6)`` (exact for money) so the result does not depend on the
    order in which partitions are combined."""
    exact = F.col("TotalRevenue").cast("decimal(38,6)")
    return agg.groupBy("Quarter").agg(money_sum(exact).alias("TotalRevenue")).orderBy("Quarter")


def partial_aggregate(chunk: DataFrame, client_col: str = "ClientID",
                      year_blind: bool = False, load_col: str | None = None) -> DataFrame:
    """A7 (first half): what one chunk contributes — revenue per
    ``(Quarter, Region, Country, ClientID)``; with ``load_col`` per load as
    well, for a table that holds many. Sums add and id sets union, so partials
    from any split of the input merge to the same answer."""
    df = drop_null_keys(with_quarter(chunk, year_blind=year_blind), GEO_KEYS)
    keys = [*([load_col] if load_col else []), *GEO_KEYS, client_col]
    return df.groupBy(*keys).agg(F.sum("Revenue").alias("Revenue"))


def merge_partials(partials: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """Re-aggregate the stored partials of all loads: ``TotalRevenue``
    adds, ``NumClients`` counts the union of the client sets. (Partials kept
    apart are put together with ``unionByName`` first.)"""
    return partials.groupBy(*GEO_KEYS).agg(
        money_sum("Revenue").alias("TotalRevenue"),
        F.count_distinct(client_col).alias("NumClients"),
    )


def distinct_quarters(df: DataFrame) -> DataFrame:
    """Sorted distinct quarter labels."""
    q = with_quarter(df)
    return q.select("Quarter").where(F.col("Quarter").isNotNull()).distinct().orderBy("Quarter")


def active_clients(cq: DataFrame) -> DataFrame:
    """client-quarters with positive revenue (over A3)."""
    return cq.where(F.col("Revenue") > 0)


def quarter_range(label: str) -> tuple[datetime.date, datetime.date]:
    """First day of a ``YYYYQn`` quarter and of the one after it."""
    m = re.fullmatch(r"(\d{4})Q([1-4])", label)
    if not m:
        raise ValueError(f"not a YYYYQn label: {label}")
    y, q = int(m[1]), int(m[2])
    return datetime.date(y, 3 * q - 2, 1), datetime.date(y + (q == 4), (3 * q) % 12 + 1, 1)


def quarter_slice(df: DataFrame, quarter: str, date_col: str = "Date") -> DataFrame:
    """rows of one quarter. Without a label column the label becomes a
    date range, which reaches the scan."""
    if "Quarter" in df.columns:
        return df.where(F.col("Quarter") == quarter)
    lo, hi = quarter_range(quarter)
    return with_quarter(df.where((F.col(date_col) >= F.lit(lo)) & (F.col(date_col) < F.lit(hi))), date_col)


def top_regions_per_quarter(agg: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest ``TotalRevenue`` rows per quarter; ties keep the
    first in (Region, Country) order. ``row_number() <= n`` is planned with a
    per-partition group limit before the shuffle."""
    w = Window.partitionBy("Quarter").orderBy(F.desc("TotalRevenue"), "Region", "Country")
    return (agg.withColumn("rank", F.row_number().over(w))
               .where(F.col("rank") <= n))


def head_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order (a top-k sort, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """A deterministic sample of exactly ``n`` rows: the ``n`` smallest
    MD5 digests of key and seed (so any engine draws the same rows)."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key], F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")
