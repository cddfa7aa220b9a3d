"""A vector index kept in hash partitions, of which an upsert rewrites only
those that its entries fall into (M2, S11).

Layout under a path: ``data/<write>/part=<k>/`` holds the files of one write,
``manifest/v=<n>/`` one row per partition with the write that holds it in
version ``n``. A write never touches the files of another, and a version exists
once its manifest is committed; so a reader sees one version whole, a failed
upsert leaves no trace in the answer, and earlier versions stay readable. One
writer at a time is expected: a second that commits the same version fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.text import upsert_index
from .sinks import table_or_none

PARTS = 64
_MANIFEST = "part int, parts int, key string, folder string"


def _part(key: str, parts: int):
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _write(index: DataFrame, path: str, key: str, parts: int) -> str:
    """Write entries under a folder of their own, one task per partition."""
    folder = f"data/{uuid.uuid4().hex}"
    placed = index.withColumn("part", _part(key, parts))
    placed.repartition("part").write.mode("error").partitionBy("part").parquet(f"{path}/{folder}")
    return folder


def _commit(spark: SparkSession, path: str, version: int, rows: list[tuple]) -> int:
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("error").parquet(f"{path}/manifest/v={version}")
    return version


def _held(spark: SparkSession, path: str, folder: str) -> list[int]:
    """The partitions that a write has files of (at most ``parts``)."""
    return [r.part for r in spark.read.schema("part int").parquet(f"{path}/{folder}").distinct().collect()]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list]:
    """The latest version (or the one asked for) and its manifest rows, at
    most one per partition."""
    found = table_or_none(spark, f"{path.rstrip('/')}/manifest", f"{_MANIFEST}, v long")
    if found is None:
        raise ValueError(f"no index at {path}")
    if version is None:
        version = found.agg(F.max("v")).first()[0]
    rows = found.where(F.col("v") == version).collect()
    if not rows:
        raise ValueError(f"no version {version} of the index at {path}")
    return version, rows


def save_versioned(index: DataFrame, path: str, key: str = "id", parts: int = PARTS) -> int:
    """Write a new index as version 0. ``parts`` is fixed then: size it so
    that one partition fits a task. An empty index keeps its columns."""
    path, spark = path.rstrip("/"), index.sparkSession
    if parts < 1:
        raise ValueError("parts must be positive")
    folder = _write(index, path, key, parts)
    index.limit(0).write.mode("error").parquet(f"{path}/schema")
    held = set(_held(spark, path, folder))
    return _commit(spark, path, 0, [(k, parts, key, folder if k in held else None) for k in range(parts)])


def load_versioned(spark: SparkSession, path: str, version: int | None = None, parts: list[int] | None = None) -> DataFrame:
    """The index as of a version (the latest, if not given); with ``parts``
    only those partitions. Only the files of that version are listed."""
    path = path.rstrip("/")
    _, rows = manifest(spark, path, version)
    schema = spark.read.parquet(f"{path}/schema").schema
    at = [f"{path}/{r.folder}/part={r.part}" for r in rows if r.folder and (parts is None or r.part in parts)]
    return spark.read.schema(schema).parquet(*at) if at else spark.createDataFrame([], schema)


def upsert_versioned(spark: SparkSession, path: str, new: DataFrame, order: str | None = None) -> int:
    """Entries of ``new`` replace those of the same key or are added, as in
    ``upsert_index``, and the next version is returned. Only the partitions
    they fall into are read and written; without entries the next version
    equals the last. Entries without a key share a partition and replace
    none."""
    path = path.rstrip("/")
    version, rows = manifest(spark, path)
    parts, key = rows[0].parts, rows[0].key
    touched = {r.part for r in new.select(_part(key, parts).alias("part")).distinct().collect()}   # at most parts
    folder = None
    if touched:
        old = load_versioned(spark, path, version, sorted(touched))
        folder = _write(upsert_index(old, new.select(*old.columns), key, order=order), path, key, parts)
    return _commit(spark, path, version + 1,
                   [(r.part, parts, key, folder if r.part in touched else r.folder) for r in rows])
