"""Consecutive row blocks (S6 ``chunk_rows``) and per-block summaries.

A global row number is built without moving all rows to one task: rows are
range-partitioned and sorted by the caller's (unique) key, each partition
numbers its own rows, and a tiny per-partition count table gives each
partition its starting offset. The numbered rows are written once to the
shared checkpoint folder so the count pass and the numbering pass see the
same partitioning, and so a lost executor does not renumber anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..operators.revenue import money_sum

# bits of monotonically_increasing_id() that hold the in-partition position
_LOCAL_BITS = 33


def global_row_index(df: DataFrame, order_by: Sequence[str], num_partitions: int | None = None,
                     out: str = "row_idx") -> DataFrame:
    """0-based position of every row in ``order_by`` order (key must be unique)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged, spark, "rowidx")
    part = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid") - F.shiftleft(part, _LOCAL_BITS)
    ranged = ranged.withColumn("_part", part).withColumn("_local", local)
    # one row per partition: bounded by the partition count, not the data
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_part")
                  .withColumn(out, F.col("_off") + F.col("_local"))
                  .drop("_mid", "_part", "_local", "_off"))


def chunk_rows(df: DataFrame, order_by: Sequence[str], chunk_size: int = 10_000) -> DataFrame:
    """Add ``chunk_id`` — consecutive blocks of ``chunk_size`` rows in
    ``order_by`` order (the last block may be shorter)."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    idx = global_row_index(df, order_by)
    return idx.withColumn("chunk_id", F.floor(F.col("row_idx") / chunk_size).cast("long"))


def chunk_summaries(df: DataFrame, order_by: Sequence[str], chunk_size: int = 10_000) -> DataFrame:
    """``(chunk_id, rows, revenue_sum)`` for every chunk; the number of
    chunks is the row count of this table (see ``num_chunks``)."""
    return chunk_rows(df, order_by, chunk_size).groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("rows"), money_sum("Revenue").alias("revenue_sum"))


def num_chunks(summaries: DataFrame) -> DataFrame:
    """One row ``(num_chunks, rows, revenue_sum)`` over the summaries."""
    return summaries.agg(F.count(F.lit(1)).alias("num_chunks"), F.sum("rows").alias("rows"),
                         F.sum("revenue_sum").alias("revenue_sum"))
