"""Connected components over a table of links, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrlens.llm.common import stored


def components(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """``id, comp``: the smallest id reachable over ``links`` (``a, b``), for
    every id that occurs. ``start`` holds labels known already (same columns);
    each must be reachable from its id.

    Every round points each vertex at its smallest neighbour, follows that
    pointer once more, and contracts the links to the vertices pointed at:
    links inside a contracted vertex drop out, so the table shrinks by the
    round until none is left. The smallest id of a component never moves, so
    it is the label in the end. Hot vertices are met by map-side minima and
    split joins; each round's tables are written.
    """
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        links.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    if start is not None:
        edges = edges.unionByName(start.select(F.col("id").alias("src"), F.col("comp").alias("dst"))).unionByName(
            start.select(F.col("comp").alias("src"), F.col("id").alias("dst")))
    edges = stored(edges.distinct(), "cc-edges")
    labels = edges.select(F.col("src").alias("id")).distinct().withColumn("comp", F.col("id"))
    edges = edges.where("src <> dst")
    while not edges.isEmpty():
        near = edges.groupBy(F.col("src").alias("v")).agg(F.least(F.min("dst"), F.first("src")).alias("p"))
        further = near.select(F.col("v").alias("p"), F.col("p").alias("q"))
        jump = stored(near.join(further, "p").select("v", "q"), "cc-jump")
        labels = labels.join(jump, F.col("comp") == F.col("v"), "left").select("id", F.coalesce("q", "comp").alias("comp"))
        edges = stored(edges.join(jump.select(F.col("v").alias("src"), F.col("q").alias("s")), "src")
                       .join(jump.select(F.col("v").alias("dst"), F.col("q").alias("d")), "dst")
                       .where("s <> d").select(F.col("s").alias("src"), F.col("d").alias("dst")).distinct(), "cc-edges")
    return stored(labels, "cc-labels")
