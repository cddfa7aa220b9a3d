"""Sinks (S7–S13). Writers are distributed (one file per partition); nothing
is gathered on the driver. Paths should point at shared storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import BUNDLE_REQUIRED, INDEX_ENTRY


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header (quarterly-by-region table, client pivot)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON lines; array and struct columns keep their shape."""
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def table_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The parquet table at ``path``, or None where there is none yet; any
    other trouble (a schema, a permission) is raised."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class RunMetrics:
    """Metrics of a run, taken by Spark while its outputs are written
    (``observe``): no output is read a second time for them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.steps: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, amount=None) -> DataFrame:
        """``df``, whose next action also counts its rows and sums ``amount``."""
        seen = Observation(step)
        self.steps.append((step, seen))
        total = F.sum(F.lit(0.0) if amount is None else amount.cast("double"))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), total.alias("amount"))

    def table(self) -> DataFrame:
        """``step, rows, amount`` of all watched outputs; each must have been
        written."""
        rows = [(step, int(m["rows"]), float(m["amount"] or 0.0)) for step, m in ((n, o.get) for n, o in self.steps)]
        return self.spark.createDataFrame(rows, "step string, rows long, amount double")

    def write(self, path: str) -> str:
        return write_json(self.table(), path)


def save_index(index: DataFrame, path: str) -> str:
    """Persist a vector index (entries with text and metadata) as parquet."""
    index.write.mode("overwrite").parquet(path)
    return path


def load_index(spark: SparkSession, path: str, schema=INDEX_ENTRY) -> DataFrame:
    """Reload an index; a missing path gives an empty, typed index."""
    found = table_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def export_bundle(plan: Sequence[str], quarterly: DataFrame, pivot: DataFrame, churn: DataFrame,
                  validations: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """All sections of the output bundle as JSON text, one row per entry:
    ``(section, key, json)``. Sections are those of ``BUNDLE_REQUIRED``.

    Each quarter's records are serialised in their own group, so no single
    task holds more than one quarter's aggregate rows (bounded by the number
    of regions × countries); pivot entries are one row per client; the tables
    themselves stay the primary output.
    """
    spark = quarterly.sparkSession
    steps = spark.createDataFrame([(f"{i:03d}", name) for i, name in enumerate(plan)], "key string, step string")
    p = steps.select(F.lit("plan").alias("section"), "key", F.to_json(F.struct("step")).alias("json"))
    q = (quarterly.groupBy("Quarter")
                  .agg(F.to_json(F.sort_array(F.collect_list(F.struct(*[c for c in quarterly.columns
                                                                       if c != "Quarter"])))).alias("json"))
                  .select(F.lit("quarterly").alias("section"), F.col("Quarter").alias("key"), "json"))
    w = pivot.select(F.lit("pivot").alias("section"), F.col(client_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(f"`{c}`") for c in pivot.columns if c != client_col])).alias("json"))
    c = churn.select(F.lit("churn_report").alias("section"),
                     F.concat("prev_quarter", F.lit("_to_"), "curr_quarter").alias("key"),
                     F.to_json(F.struct(*churn.columns)).alias("json"))
    v = validations.select(F.lit("validations").alias("section"), F.col("check").alias("key"),
                           F.to_json(F.struct(*validations.columns)).alias("json"))
    return p.unionByName(q).unionByName(w).unionByName(c).unionByName(v)


def missing_sections(bundle: DataFrame) -> list[str]:
    """Required sections that a bundle has no entry for."""
    have = {r.section for r in bundle.select("section").distinct().collect()}   # at most the known sections
    return [x for x in BUNDLE_REQUIRED if x not in have]


def save_summaries(summaries: DataFrame, base_path: str, version: str,
                   key: Sequence[str] = ("key",), ts: str = "ts") -> str:
    """Keep the latest summary per key (by ``ts``) and write it to a new
    version folder; earlier versions are left as they were."""
    latest = latest_per_key(summaries, key, ts)
    path = f"{base_path.rstrip('/')}/version={version}"
    latest.write.mode("error").parquet(path)
    return path


def latest_per_key(df: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Latest row per key: ``max_by`` over a struct of the other columns, a
    plain hash aggregate (partial aggregation keeps hot keys small)."""
    others = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(ts, *others)).alias("_r"))
    return picked.select(*key, "_r.*")
