"""Exact deduplication by composable polynomial fingerprints.

A text, with white space ``[\\x20\\x09-\\x0D]`` deleted, is cut into chunks of
``chunk_bytes``. Each chunk has a polynomial hash modulo two primes; the
fingerprint of a text is the sum of its chunk hashes, each shifted by the
length that follows it (``h(ab) = h(a) * B**len(b) + h(b)``). Chunks are
hashed independently, one after another in the task that holds the text; it
holds the text and its copy without white space whole, numbers for one chunk.

Equal fingerprints are candidates only: their chunks are then compared
position by position. Per (fingerprint, chunk number) Spark keeps the smallest
and the largest chunk - a streaming aggregate that collapses on the map side,
so a group with a third of all rows is never gathered. Where the two differ,
the fingerprint collided, and its texts are told apart by their chunks.

Defined results: a null text counts as empty; empty texts are equal to each
other. A null id sorts after every id. Rows that repeat an id are rows of
their own; of rows with the same id and equal length exactly one is kept. An
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qtrlens.llm.common import SPACES, narrow, release, stored, text_buffer

CHUNK_BYTES = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 69069 * 16807)

FP = ["fp1", "fp2", "n_bytes"]
_SCHEMA = ("doc_id long, n_points long, text_sha256 string, fp1 long, fp2 long, n_bytes long, "
           "chunk_no int, chunk binary")


def _power_table(chunk_bytes: int, primes) -> list[np.ndarray]:
    out = []
    for base, p in zip(BASES, primes):
        a = np.empty(chunk_bytes, dtype=np.int64)
        x = 1
        for i in range(chunk_bytes):
            a[i] = x
            x = x * base % p
        out.append(a[::-1].copy())          # the first byte has the highest power
    return out


def chunk_hash(chunk: np.ndarray, power: np.ndarray, prime: int) -> int:
    """Polynomial hash of one chunk (bytes + 1, so that zeros count)."""
    if not len(chunk):
        return 0
    terms = (chunk.astype(np.int64) + 1) * power[len(power) - len(chunk):]
    return int(terms.sum() % prime)          # < 2**16 * 2**39: no overflow


def combine(left: int, right: int, right_bytes: int, which: int, prime: int) -> int:
    """Hash of a concatenation from the hashes of its parts."""
    return (left * pow(BASES[which], right_bytes, prime) + right) % prime


_TABLES: dict[tuple, list[np.ndarray]] = {}


def _tables(chunk_bytes, primes):
    key = (chunk_bytes, tuple(primes))
    if key not in _TABLES:
        _TABLES[key] = _power_table(chunk_bytes, primes)
    return _TABLES[key]


def _fingerprints(chunk_bytes: int, primes, with_chunks: bool):
    def run(batches):
        tables = _tables(chunk_bytes, primes)
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            points = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            held = 0
            for i, doc_id in enumerate(ids):
                text = data[off[i]:off[i + 1]].tobytes().translate(None, SPACES)
                buf = np.frombuffer(text, dtype=np.uint8)
                fp = [0, 0]
                for at in range(0, len(buf), chunk_bytes):
                    part = buf[at:at + chunk_bytes]
                    for k in (0, 1):
                        fp[k] = combine(fp[k], chunk_hash(part, tables[k], primes[k]), len(part), k, primes[k])
                head = (doc_id, points[i], hashlib.sha256(text).hexdigest(),
                        fp[0], fp[1], len(text))
                if not with_chunks:
                    rows.append((*head, None, None))
                    continue
                for no, at in enumerate(range(0, max(1, len(text)), chunk_bytes)):
                    rows.append((*head, no, text[at:at + chunk_bytes]))
                held += len(text)
                if held > 1 << 23:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)
    return run


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_points", pa.int64()), ("text_sha256", pa.string()),
                    ("fp1", pa.int64()), ("fp2", pa.int64()), ("n_bytes", pa.int64()),
                    ("chunk_no", pa.int32()), ("chunk", pa.binary())])


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)], schema=_ARROW)


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", chunk_bytes=CHUNK_BYTES,
                 primes=PRIMES) -> DataFrame:
    """One row per text: id, code points, SHA-256 of the normalised text, and
    the combined fingerprint (two residues and the length)."""
    return narrow(docs, id_col, text_col).mapInArrow(_fingerprints(chunk_bytes, primes, False), _SCHEMA) \
        .drop("chunk_no", "chunk")


def collisions(docs: DataFrame, shared: DataFrame, id_col, text_col, chunk_bytes, primes) -> DataFrame:
    """Fingerprints in ``shared`` whose texts differ in some chunk."""
    chunks = narrow(docs, id_col, text_col).mapInArrow(_fingerprints(chunk_bytes, primes, True), _SCHEMA)
    # grouped by a struct, which the join's partitioning does not serve: the
    # join's large partitions can then be split, and each part sends one row
    # per chunk number on
    compared = (chunks.select(*FP, "chunk_no", "chunk").join(shared.select(*FP), FP, "left_semi")
                .groupBy(F.struct(*FP).alias("fp"), "chunk_no")
                .agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")))
    return compared.where("lo <> hi").select("fp.*").distinct()


def _told_apart(docs, clashed, id_col, text_col, chunk_bytes, primes) -> DataFrame:
    """The texts of collided fingerprints (named by their SHA-256) with a
    class string: per chunk the rank of its content among the different
    contents at that place."""
    chunks = narrow(docs, id_col, text_col).mapInArrow(_fingerprints(chunk_bytes, primes, True), _SCHEMA)
    chunks = chunks.select("text_sha256", *FP, "chunk_no", "chunk").join(clashed, FP, "left_semi").distinct()
    ranked = chunks.withColumn("kind", F.dense_rank().over(W.partitionBy(*FP, "chunk_no").orderBy("chunk")))
    return (ranked.groupBy(*FP, "text_sha256")
            .agg(F.to_json(F.sort_array(F.collect_list(F.struct("chunk_no", "kind")))).alias("cls")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                chunk_bytes: int = CHUNK_BYTES, primes=PRIMES) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256, n_points``. Of equal texts the one with most code points in
    the original, then the smallest id, stays."""
    spark = docs.sparkSession
    rows = stored(fingerprints(docs, id_col, text_col, chunk_bytes, primes), "op1-fp")
    shared = rows.groupBy(*FP).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    clashed = stored(collisions(docs, shared, id_col, text_col, chunk_bytes, primes), "op1-clash")
    release(spark)
    keys = [*FP, "cls"]
    if clashed.isEmpty():
        rows = rows.withColumn("cls", F.lit(""))
    else:
        apart = _told_apart(docs, clashed, id_col, text_col, chunk_bytes, primes)
        rows = (rows.join(apart, [*FP, "text_sha256"], "left")
                .withColumn("cls", F.coalesce("cls", F.lit(""))))
    # rows that agree in everything are counted, not gathered
    rows = rows.groupBy(*keys, "text_sha256", "doc_id", "n_points").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("n_points"), F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("neg"))
    best = rows.groupBy(*keys).agg(F.max(order).alias("best"), F.sum("copies").alias("group_size")).select(
        *keys, (-F.col("best.neg")).alias("keep_id"), F.col("best.n_points").alias("keep_points"), "group_size")
    many = best.where("group_size > 1")
    joined = rows.join(many, keys, "left")
    alone = F.col("group_size").isNull()
    first = alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")))
    return (joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), first.alias("first"),
        "text_sha256", "n_points", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .select("doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"),
                "text_sha256", "n_points"))
