"""Session helpers: one place for the settings every job here relies on.

Cluster settings (executor sizes, checkpoint folder, shuffle partitions) belong
to whoever launches the job; these helpers only fill in values that are unset,
so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query here assumes. UTC keeps quarter boundaries identical on
# every executor; ANSI makes bad casts loud unless a try_* function is used.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "qtrlens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them ``None`` and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Pin the session settings on an existing session (e.g. the driver's)."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set and point at shared storage: each executor
    would write to its own disk otherwise. Only a local master gets a fresh
    local folder when it is unset (tests, single-machine runs).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (Spark Connect)
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master or ""):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="qtrlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the checkpoint folder for an intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None, name: str = "stage"):
    """Materialise ``df`` as parquet in the shared checkpoint folder and read it back.

    A written table survives executor loss (unlike cached blocks) and gives the
    optimizer real statistics for the next stage.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
