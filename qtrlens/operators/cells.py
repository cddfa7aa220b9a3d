"""A search index of cells with bounds: exact top-k without scoring all entries.

Entries (unit vectors, or zeros) are stored by coarse cell, each cell with its
centre, its size and its radius: the largest angle between an entry and the
centre. For a query at angle ``t`` from the centre no entry of the cell scores
above ``cos(t - radius)``, so a query takes the cells in the order of that
bound and stops as soon as its k-th best score beats the next bound. The
answer is that of the full search.

Centres are fitted on a bounded sample (``SAMPLE_ROWS``), every entry is
indexed. Only centres and cell sizes, a few hundred rows, pass the driver.
Queries are a table: in each round every open query goes to twice as many of
its next cells as before, by one keyed shuffle of (cell share x query).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import shares as SH
from .text import SCORE_DECIMALS, _near, _with_columns

CELLS = 64                 # centres fitted
SAMPLE_ROWS = 20_000       # entries they are fitted on, at most
FIT_ROUNDS = 8
_ZERO = -1                 # the cell of zero vectors, which score 0 with everything


def fit_centres(index: DataFrame, cells: int = CELLS, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Unit centres by spherical k-means over the entries whose ids hash
    lowest (at most ``sample_rows``)."""
    some = index.where("vec is not null").select("vec", F.xxhash64("id").alias("_h")).orderBy("_h").limit(sample_rows)
    x = np.array([r.vec for r in some.select("vec").collect()], dtype="float64")         # bounded by sample_rows
    x = x[(x * x).sum(axis=1) > 0] if len(x) else x
    if not len(x):
        return np.zeros((0, 0))
    centre = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(FIT_ROUNDS):
        own = np.argmax(x @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(size > 0, total / np.where(size > 0, size, 1), centre)
    return centre


def _assign(centre: np.ndarray):
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("vec")
            flat = np.asarray(batch.column(at).flatten(), dtype="float64")
            v = flat.reshape(len(batch), -1) if len(flat) else np.zeros((len(batch), 1))
            some = (v * v).sum(axis=1) > 0
            dot = v @ centre.T if centre.size else np.zeros((len(v), 1))
            cell = np.where(some, np.argmax(dot, axis=1), _ZERO)
            near = np.where(some, dot[np.arange(len(v)), np.maximum(cell, 0)], 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(near)],
                                             names=[*batch.schema.names, "_cell", "_dot"])
    return run


def _entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/entries")


def save_cells(index: DataFrame, path: str, cells: int = CELLS) -> str:
    """Write an index (``id, vec, ...``) by cell under ``path``, its centres
    and bounds beside it. Entries without a vector are left out."""
    spark = index.sparkSession
    entries = cut_lineage(index.where("vec is not null"), spark, "entries")
    centre = fit_centres(entries, cells)
    schema = T.StructType([*entries.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_dot", T.DoubleType())])
    placed = entries.mapInArrow(_assign(centre), schema).withColumn("_row", F.monotonically_increasing_id())
    placed.write.mode("overwrite").partitionBy("_cell").parquet(f"{path}/entries")
    spark.createDataFrame([], placed.schema).write.mode("overwrite").parquet(f"{path}/schema")   # an index may be empty
    stored = _entries(spark, path)
    found = stored.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_dot").alias("least")).collect()
    rows = [(r["_cell"], r["n"], r["least"], centre[r["_cell"]].tolist() if r["_cell"] >= 0 else None) for r in found]
    spark.createDataFrame(rows, "cell int, n long, least double, centre array<double>").write.mode("overwrite").parquet(f"{path}/cells")
    return path


def _bounds(cells):
    """For each query its cells in the order of their bounds."""
    ids = [r["cell"] for r in cells]
    centre = np.array([r["centre"] for r in cells if r["centre"] is not None], dtype="float64")
    has = np.array([r["centre"] is not None for r in cells])
    radius = np.arccos(np.clip([r["least"] for r in cells], -1, 1)) + 1e-6

    def run(batches):
        for batch in batches:
            flat = np.asarray(batch.column(1).flatten(), dtype="float64")
            q = flat.reshape(len(batch), -1) if len(flat) else np.zeros((len(batch), 1))
            norm = np.sqrt((q * q).sum(axis=1, keepdims=True))
            bound = np.zeros((len(q), len(ids)))
            if has.any():
                angle = np.arccos(np.clip((q / np.where(norm > 0, norm, 1)) @ centre.T, -1, 1))
                bound[:, has] = np.cos(np.maximum(angle - radius[has], 0)) * norm
            order = np.argsort(-bound, axis=1, kind="stable")
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.tile(np.arange(n), len(q)), pa.int32()),
                 pa.array(np.array(ids)[order].reshape(-1), pa.int32()), pa.array(np.take_along_axis(bound, order, 1).reshape(-1))],
                names=["_q", "place", "cell", "bound"])
    return run


def topk_cells(spark: SparkSession, path: str, queries: DataFrame, k: int = 5, log: list | None = None) -> DataFrame:
    """T2 / M3 on a saved index: the rows of ``topk_similar``. ``log`` gets
    the number of (query, entry) pairs that each round scored."""
    cells = spark.read.parquet(f"{path}/cells").collect()                # one row per cell
    entries = _entries(spark, path)
    asked = cut_lineage(queries.select("id", "vec").where("vec is not null").withColumn("_q", F.monotonically_increasing_id()),
                        spark, "queries")
    schema = T.StructType([T.StructField("_q", T.LongType()), T.StructField("qid", queries.schema["id"].dataType),
                           T.StructField("score", T.DoubleType()), entries.schema["id"], T.StructField("_row", T.LongType())])
    numbered = entries.drop("_dot", "_cell")
    best = spark.createDataFrame([], schema)
    if not cells:
        return _with_columns(best.withColumn("rank", F.lit(1)), numbered, ["rank"])
    split = F.create_map(*[F.lit(x) for r in cells for x in (r["cell"], max(1, math.ceil(r["n"] / SH.SHARE_ROWS)))])
    size = F.create_map(*[F.lit(x) for r in cells for x in (r["cell"], r["n"])])
    todo = cut_lineage(asked.select("_q", "vec").mapInArrow(_bounds(cells), "_q long, place int, cell int, bound double"), spark, "bounds")
    # one share of a cell: its number and the cell's, in a long
    share = lambda c, s: F.col(c).cast("long") * F.lit(1 << 32) + s
    e, q = F.struct("id", "vec", "_row"), F.struct("id", "vec", "_q")
    etype, qtype = entries.select(e).schema[0].dataType, asked.select(q).schema[0].dataType
    w = Window.partitionBy("_q").orderBy(F.desc("score"), "id", "_row")
    width = done = 0
    while done < len(cells):
        width = max(1, 2 * width)
        now = cut_lineage(todo.where((F.col("place") >= done) & (F.col("place") < done + width)), spark, "visits")
        done += width
        if log is not None:
            log.append(now.agg(F.sum(size[F.col("cell")])).first()[0] or 0)
        visited = entries.join(now.select(F.col("cell").alias("_cell")).distinct(), "_cell", "left_semi")
        dealt = visited.select(share("_cell", F.pmod("_row", split[F.col("_cell")])).alias("_share"), F.lit(0).alias("_kind"),
                               e.alias("_e"), F.lit(None).cast(qtype).alias("_q"))
        sent = now.join(asked, "_q").select(
            "cell", q.alias("_q"), F.explode(F.sequence(F.lit(0), split[F.col("cell")] - 1)).alias("s")).select(
            share("cell", F.col("s")).alias("_share"), F.lit(1).alias("_kind"), F.lit(None).cast(etype).alias("_e"), "_q")
        found = (dealt.unionByName(sent).repartition("_share").sortWithinPartitions("_share", "_kind")
                 .mapInArrow(SH._meet(_near(k), SH.QUERY_BLOCK), schema))
        best = cut_lineage(best.unionByName(found).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                           .drop("rank"), spark, "best")
        if done >= len(cells):
            break
        # open: fewer than k found, or the next cell's bound still reaches the k-th
        kth = best.groupBy("_q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
        ahead = todo.where(F.col("place") == done).select("_q", "bound")
        still = ahead.join(kth, "_q", "left").where(
            F.col("n").isNull() | (F.col("n") < k) | (F.col("bound") + 10.0 ** -SCORE_DECIMALS >= F.col("kth"))).select("_q")
        todo = cut_lineage(todo.where(F.col("place") >= done).join(still, "_q", "left_semi"), spark, "bounds")
        if todo.isEmpty():
            break
    return _with_columns(best.withColumn("rank", F.row_number().over(w)), numbered, ["rank"])
