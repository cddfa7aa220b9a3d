"""The corpus pipeline: from raw documents to packed training windows.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents the
stage before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrlens.llm import bpe, exact_dedup, near_dedup, packing, quality, substring_dedup
from qtrlens.llm.common import stored

ORACLE_SQL = None      # tests/llm holds the stages against brute-force versions


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage may have shortened."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, documents that the rules reject go."""
    return _recount(quality.keep_clean(docs))


def _whole(docs: DataFrame, *extra) -> DataFrame:
    """Each row as one column ``doc``, so that no name of the input can clash
    with what a stage puts beside it."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), *extra)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays. Rows are told apart by
    id, length and normalised text, so of rows that repeat an id each is
    judged by its own text; an empty table stays empty."""
    kept = exact_dedup.exact_dedup(docs).where("kept").select("doc_id", "n_points", "text_sha256")
    text = F.coalesce(F.col("text"), F.lit(""))
    mine = _whole(docs, F.col("doc_id").cast("long").alias("id"), F.length(text).cast("long").alias("n_points"),
                  F.sha2(F.translate(text, " \t\n\x0b\x0c\r", ""), 256).alias("text_sha256"))
    same = (mine.id.eqNullSafe(kept.doc_id) & (mine.n_points == kept.n_points) & (mine.text_sha256 == kept.text_sha256))
    return (mine.join(kept, same, "left_semi").dropDuplicates(["id", "n_points", "text_sha256"]).select("doc.*"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the
    smallest id (a null id after all), then the first row. Rows are linked by
    their place in ``docs``, so rows that repeat an id, or have none, are
    documents of their own; ``docs`` must come in the same order twice, as a
    written table does."""
    row = F.monotonically_increasing_id()
    numbered = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), "text")
    groups = near_dedup.near_dedup(numbered.select("row", "text"), id_col="row").select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    kept = numbered.select("row", "id").join(groups, "row").groupBy("component").agg(first).select("first.row")
    return _whole(docs, row.alias("row")).join(kept, "row", "left_semi").select("doc.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has go; the documents stay,
    as does white space between the words that stay."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = substring_dedup.substring_dedup(docs, with_text=True, carry=rest)
    cols = {"doc_id": F.col("doc_id"), "text": F.col("kept_text")}
    return _recount(out.select(*(cols[c].alias(c) if c in cols else F.col("carried").getField(c).alias(c)
                                 for c in docs.columns)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 ids, one row per piece of a document."""
    return packing.pack(docs, bpe.session_vocabulary(spark))


STAGES = [("quality rules", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
          ("substring dedup", substring_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread as the next
    one's input."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
