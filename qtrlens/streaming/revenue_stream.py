"""Incremental revenue results with Structured Streaming (S2, ST1–ST3,
ST5, ST6) and the online breaker (ST4).

Pattern. A streaming aggregate runs in ``update`` mode; each micro-batch's
changed rows are appended to a parquet table partitioned by ``batch_id``
(dynamic partition overwrite, so a replayed batch replaces its own partition
instead of duplicating it). The current answer is the latest row per key,
resolved with ``max_by`` at read time. Writes are proportional to what
changed, never to the whole table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.columns import content_key
from ..operators.events import FAILURE_TYPE, FAIL_THRESHOLD, RESET_TIMEOUT_SECONDS
from ..operators.revenue import GEO_KEYS, drop_null_keys, with_quarter
from ..sources.sinks import table_or_none


def stream_revenue_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                         max_files_per_trigger: int | None = 1) -> DataFrame:
    """A revenue feed as a stream of files (explicit schema, no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_quarter_region(stream: DataFrame) -> DataFrame:
    """ST1: running revenue sum and row count by quarter, region, country."""
    s = drop_null_keys(with_quarter(stream), GEO_KEYS)
    return s.groupBy(*GEO_KEYS).agg(F.sum("Revenue").alias("TotalRevenue"),
                                    F.count("Revenue").alias("NumRows"))


def stream_num_clients(stream: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """ST2: running distinct clients per quarter, region, country.

    Distinct counts are not allowed on streams; de-duplicating the
    (quarter, region, country, client) keys and counting them is. The
    de-duplication state holds one entry per key and has no watermark,
    because a late correction to any quarter must still count."""
    s = drop_null_keys(with_quarter(stream), GEO_KEYS + [client_col])
    return (s.dropDuplicates(GEO_KEYS + [client_col])
             .groupBy(*GEO_KEYS).agg(F.count(F.lit(1)).alias("NumClients")))


def stream_client_quarterly(stream: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """ST3: running revenue per client and quarter (the state churn reads)."""
    s = drop_null_keys(with_quarter(stream), [client_col, "Quarter"])
    return s.groupBy(client_col, "Quarter").agg(F.sum("Revenue").alias("Revenue"))


def run_to_table(agg: DataFrame, out_path: str, checkpoint: str, output_mode: str = "update") -> None:
    """Run a streaming aggregate over everything available and append each
    micro-batch's changed rows under ``batch_id=<n>``. Re-running with the
    same checkpoint resumes; a replayed batch overwrites its own partition."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").parquet(out_path))

    q = (agg.writeStream.outputMode(output_mode).foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, out_path: str, keys: list[str], base: str | None = None) -> DataFrame:
    """Current answer: the latest row per key across all appended batches, or
    across a compacted table ``base`` and the batches after it."""
    t = spark.read.parquet(out_path)
    if base:
        b = spark.read.parquet(base)
        upto = b.agg(F.max("batch_id")).first()[0]
        t = (t.where(F.col("batch_id") > upto) if upto is not None else t).unionByName(b)
    vals = [c for c in t.columns if c not in keys and c != "batch_id"]
    latest = t.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("_v"))
    return latest.select(*keys, "_v.*")


def compact(spark: SparkSession, out_path: str, keys: list[str], target: str, base: str | None = None) -> str:
    """Write the current answer to ``target``, labelled with the newest batch
    it covers; batches up to that one need not be read again (and may go)."""
    upto = spark.read.parquet(out_path).agg(F.max("batch_id")).first()[0]
    (read_latest(spark, out_path, keys, base).withColumn("batch_id", F.lit(upto).cast("long"))
     .write.mode("error").parquet(target))
    return target


# ------------------------------------------------------------ ST5 idempotency

def idempotent_apply(spark: SparkSession, stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """ST5: apply each file content exactly once, even across replays with a
    fresh checkpoint, under another path, or after a crash.

    A file's key is a digest of its rows (count and sum of row hashes, which
    no order changes). The output is its own ledger: it carries the key of
    every row, in folders by the key's first two digits, and a batch's keys
    are looked up there before its rows are appended; Spark's commit makes the
    append one step, so there is no gap between output and ledger. Of files
    with the same content in one batch the first path is applied."""
    cols = stream.columns
    named = stream.withColumn("_path", F.input_file_name())

    def sink(batch: DataFrame, batch_id: int) -> None:
        row = F.xxhash64(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
        files = batch.groupBy("_path").agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("h"))
        keys = files.groupBy(content_key("n", "h").alias("_src")).agg(F.min("_path").alias("_path")) \
            .withColumn("_part", F.substring("_src", 1, 2))
        done = table_or_none(spark, out_path, T.StructType([T.StructField("_src", T.StringType()),
                                                            T.StructField("_part", T.StringType())]))
        if done is not None:                   # only the folders of this batch's keys are read, of them only the key
            keys = keys.join(done.join(keys.select("_part").distinct(), "_part", "left_semi").select("_src", "_part").distinct(),
                             ["_src", "_part"], "left_anti")
        (batch.join(keys, "_path").drop("_path")
              .write.mode("append").partitionBy("_part").parquet(out_path))

    q = (named.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True).start())
    q.awaitTermination()


def read_applied(spark: SparkSession, out_path: str) -> DataFrame:
    """ST5: the applied rows (without the source key)."""
    return spark.read.parquet(out_path).drop("_src", "_part")


# ------------------------------------------------------------- ST6 totals

def stream_totals_check(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """ST6: per micro-batch, the exact input revenue total next to the total
    of the quarter × region aggregate of the same rows (null keys dropped),
    under ``batch_id=<n>``; ``running_totals`` adds them up."""
    from ..operators.revenue import GEO_KEYS as keys

    def sink(batch: DataFrame, batch_id: int) -> None:
        # one pass: groups of all rows, of which the aggregate keeps those with whole keys
        groups = with_quarter(batch).groupBy(*keys).agg(F.sum("Revenue").alias("r"))
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        zero = F.lit(0)
        check = groups.agg(F.coalesce(F.sum("r"), zero).cast("decimal(38,10)").alias("input_total"),
                           F.coalesce(F.sum(F.when(whole, F.col("r"))), zero).cast("decimal(38,10)").alias("agg_total"))
        # a replayed batch overwrites its own partition instead of adding a row
        (check.withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("batch_id").parquet(out_path))

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def running_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """ST6: totals over all batches up to each (one row per batch):
    ``(batch_id, input_total, agg_total, ok)``, compared exactly."""
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    t = spark.read.parquet(out_path).select(
        "batch_id", F.sum("input_total").over(w).alias("input_total"), F.sum("agg_total").over(w).alias("agg_total"))
    return t.withColumn("ok", F.col("input_total") == F.col("agg_total"))


# ------------------------------------------------------------ ST4 breaker

_TRIP_OUT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("trip_at", T.TimestampType()),
    T.StructField("open_until", T.TimestampType()),
    T.StructField("late", T.BooleanType()),
])
_TRIP_STATE = T.StructType([
    T.StructField("fail_count", T.LongType()),
    T.StructField("opened_us", T.LongType()),
    T.StructField("last_us", T.LongType()),
    T.StructField("last_id", T.LongType()),
])


def _breaker_state(threshold: int, timeout_s: float):
    timeout = int(timeout_s * 1e6)

    def fn(key, pdfs, state):
        count, opened, last = 0, None, None
        if state.exists:
            count, opened, us, ident = state.get
            last = (us, ident)
        t_us, ids, fails = (np.concatenate(c) for c in zip(*((p["t_us"].to_numpy(), p["event_id"].to_numpy(), p["f"].to_numpy())
                                                           for p in pdfs)))       # 17 bytes an event
        order = np.lexsort((ids, t_us))
        out = []
        for t, ident, f in zip(t_us[order].tolist(), ids[order].tolist(), fails[order].tolist()):
            if last is not None and (t, ident) < last:
                out.append((t, None, True))        # behind what was folded already: reported, not folded
                continue
            last = (t, ident)
            if opened is not None:
                if t > opened:
                    count, opened = 0, None
                else:
                    continue
            if f:
                count += 1
                if count >= threshold:
                    opened = t + timeout
                    out.append((t, opened, False))
            else:
                count = 0
        state.update((count, opened, *(last or (None, None))))
        when = lambda x: pd.Series(pd.to_datetime(pd.Series(x, dtype="Int64"), unit="us"), dtype="datetime64[us]")
        yield pd.DataFrame({"user_id": pd.Series([key[0]] * len(out), dtype="Int64"), "trip_at": when([a for a, _, _ in out]),
                            "open_until": when([b for _, b, _ in out]),
                            "late": pd.Series([c for _, _, c in out], dtype="bool")})
    return fn


def stream_breaker_trips(events: DataFrame, threshold: int = FAIL_THRESHOLD,
                         reset_timeout_s: float = RESET_TIMEOUT_SECONDS) -> DataFrame:
    """ST4: the breaker of W6 kept online per user with
    ``applyInPandasWithState``; state per key is four numbers. Events are
    folded in event-time order: within a batch they are sorted, and an event
    behind the last one folded for its key is not folded but comes out as a
    row with ``late`` (its time in ``trip_at``), so that a caller sees it.
    Events without a time take no part, as in the batch form."""
    x = events.where(F.col("ts").isNotNull()).select(
        F.col("user_id").cast("long").alias("user_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"),
        F.col("event_id").cast("long").alias("event_id"),
        F.coalesce(F.col("event_type") == FAILURE_TYPE, F.lit(False)).alias("f"))
    return x.groupBy("user_id").applyInPandasWithState(
        _breaker_state(threshold, reset_timeout_s), _TRIP_OUT, _TRIP_STATE, "append",
        GroupStateTimeout.NoTimeout)


def run_append_to_parquet(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Append-mode stream → parquet file sink, run over everything available."""
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", out_path)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
