"""Ordered scans per key that stay distributed whatever one key's share.

``segmented_running`` gives a running value per key in a stated order without
putting a key's rows in one task, and it is the only plan, for every size:

1. range-partition by (key, order), so that a key holding a third of the rows
   is split over many partitions, and write that table (range bounds come
   from sampling; the written table fixes the assignment and survives a lost
   executor);
2. a window over (partition, key) computes the running value inside each
   partition's share of a key;
3. one row per (partition, key) carries the share's total; a window over them
   gives what precedes each share. Only a key that continues from an earlier
   partition has such a value, so at most one row per partition is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_OPS = ("sum", "max", "previous")


def segmented_running(df: DataFrame, key: str, order: Sequence[str], value: str, out: str,
                      op: str = "sum") -> DataFrame:
    """``out`` per ``key`` in the order of ``order``: the running ``sum`` or
    ``max`` of ``value`` up to and with the row, or the ``previous`` row's
    value (which must not fall along the order; null at a key's first row).
    Rows with a null key are one key."""
    if op not in _OPS:
        raise ValueError(f"op must be one of {_OPS}")
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, F.col(key), *[F.col(c) for c in order]).withColumn("_p", F.spark_partition_id())
    ranged = cut_lineage(ranged, spark, "segscan")
    inside = Window.partitionBy("_p", key).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = {"sum": F.sum(value).over(upto), "max": F.max(value).over(upto),
             "previous": F.lag(value).over(inside)}[op]
    agg = F.sum if op == "sum" else F.max
    totals = ranged.groupBy("_p", key).agg(agg(value).alias("_t"))
    before = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.select("_p", F.col(key).alias("_k"), agg("_t").over(before).alias("_off"))
               .where(F.col("_off").isNotNull()))
    rows = ranged.withColumn("_local", local).withColumnRenamed("_p", "_row_p")
    combined = {"sum": F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)),
                "max": F.greatest("_local", "_off"),
                "previous": F.coalesce("_local", "_off")}[op]
    return (rows.join(offsets, (F.col("_row_p") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")), "left")
            .withColumn(out, combined).drop("_p", "_row_p", "_k", "_local", "_off"))


def segmented_running_sum(df: DataFrame, key: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Running sum per key (see ``segmented_running``)."""
    return segmented_running(df, key, order, value, out, "sum")
