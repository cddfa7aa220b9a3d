"""Driver tables and the revenue view derived from them (J6 ``star_join``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.revenue import quarter_range
from ..schemas import MONEY
from ..session import table_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def geo_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region → (nationkey, Region, Country). No hint and no counting
    job: Catalyst broadcasts by the tables' sizes, AQE by measured ones."""
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return geo.select(F.col("n_nationkey"), F.col("r_name").alias("Region"),
                      F.col("n_name").alias("Country"))


def revenue_view(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = (),
                 quarters: Sequence[str] = ()) -> DataFrame:
    """Long revenue feed ``(ClientID, Region, Country, Date, Revenue)``.

    orders ⋈ customer ⋈ nation ⋈ region, inner equi-joins without hints:
    Catalyst broadcasts a side whose size is under
    ``autoBroadcastJoinThreshold``, otherwise it is a sort-merge join (AQE may
    still convert it at run time). ``keep`` carries extra order columns
    through; ``quarters`` (``YYYYQn``) reads only those quarters' orders, by
    ranges of the stored date that reach the scan.
    """
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", *keep)
    if quarters:
        wanted = F.lit(False)
        for q in quarters:
            lo, hi = (F.lit(str(d)).cast(orders.schema["o_orderdate"].dataType) for d in quarter_range(q))
            wanted = wanted | ((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
        orders = orders.where(wanted)
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = geo_dimension(spark, sf_dir)
    cust_geo = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    cust_geo = cust_geo.select("c_custkey", "Region", "Country")
    rev = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey)
    return rev.select(
        F.col("o_custkey").alias("ClientID"),
        F.col("Region"),
        F.col("Country"),
        F.col("o_orderdate").cast("date").alias("Date"),
        F.col("o_totalprice").cast(MONEY).alias("Revenue"),
        *keep,
    )


# DuckDB text of the same view, used by the SQL oracles.
REVENUE_VIEW_SQL = """
rev AS (
  SELECT o.o_custkey AS ClientID, r.r_name AS Region, n.n_name AS Country,
         CAST(o.o_orderdate AS DATE) AS Date,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS Revenue
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def client_quarter_view(spark: SparkSession, sf_dir: str, year_blind: bool = False) -> DataFrame:
    """A3 straight from the star schema: ``(ClientID, Region, Country,
    Quarter, Revenue, NumRows)`` at one row per client and quarter
    (``NumRows`` counts the orders behind the row).

    Orders are aggregated to (customer, quarter) *before* the customer and
    geography join. Partial aggregation collapses a customer with a huge
    share of all orders on the map side, so the join (and every churn step
    after it) sees at most one row per client-quarter; geography depends on
    the customer only, so the result equals aggregating the joined feed. The
    inner join keeps the feed's rule: orders without a known customer,
    nation and region are dropped.
    """
    from ..functions.columns import quarter_label, quarter_of_year_label

    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    d = F.col("o_orderdate").cast("date")
    q = quarter_of_year_label(d) if year_blind else quarter_label(d)
    a = (orders.where(F.col("o_custkey").isNotNull() & d.isNotNull())
               .groupBy(F.col("o_custkey").alias("ClientID"), q.alias("Quarter"))
               .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("Revenue"),
                    F.count("o_totalprice").alias("NumRows")))
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = geo_dimension(spark, sf_dir)
    cust_geo = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    cust_geo = cust_geo.select("c_custkey", "Region", "Country")
    j = a.join(cust_geo, a.ClientID == cust_geo.c_custkey)
    return j.select("ClientID", "Region", "Country", "Quarter", "Revenue", "NumRows")
