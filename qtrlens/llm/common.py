"""Helpers shared by the corpus operators.

Texts reach Python as Arrow columns; the helpers below look at their UTF-8
bytes through numpy, a bounded piece at a time, so memory per task does not
depend on how many documents a batch holds.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrlens.session import scratch_path

PIECE_BYTES = 1 << 20          # text handled by one numpy step
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = b" \t\n\x0b\x0c\r"

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV_BASE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


BATCH_ROWS = 1024              # rows of an Arrow batch: they carry whole texts
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small: a Python worker holds one or two of
    them, in more than one copy, beside the JVM's."""
    now = int(spark.conf.get(_ARROW_ROWS))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_ARROW_ROWS, BATCH_ROWS)


def narrow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and text (string) columns, under fixed names, so
    that no other column of the input can clash with an operator's own."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later
    steps read files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose results are
    already stored (it acts on garbage collection, which an idle driver may
    not run for a long time)."""
    gc.collect()
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()


def shuffle_parts(spark: SparkSession) -> int:
    """Partition count of the packed exchanges: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def partition_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` integers of which ``repartition(n, key)`` sends each to a
    partition of its own (so ``n`` equal shares give ``n`` equal tasks)."""
    found: dict[int, int] = {}
    hi = 4 * n + 64
    while len(found) < n:
        rows = (spark.range(hi).select(F.col("id").cast("int").alias("k"))
                .select("k", F.pmod(F.hash("k"), F.lit(n)).alias("p"))
                .groupBy("p").agg(F.min("k").alias("k")).collect())
        found = {r.p: r.k for r in rows}
        hi *= 4
    return [found[p] for p in range(n)]


# The bucket of a document id, the same in Spark and in numpy.
_ID_MOD, _ID_MUL = 2147483629, 2654435761


def id_bucket(col, n: int):
    return F.pmod(F.shiftright(F.pmod(F.coalesce(col, F.lit(0).cast("long")), F.lit(_ID_MOD)) * F.lit(_ID_MUL), 16),
                  F.lit(n)).cast("int")


def id_bucket_np(ids: np.ndarray, n: int) -> np.ndarray:
    return (((ids % _ID_MOD) * _ID_MUL) >> 16) % n


def key_of(bucket, keys: list[int]):
    """Column with the partition key of a bucket number."""
    return F.element_at(F.array(*[F.lit(k) for k in keys]), bucket + F.lit(1))


# ------------------------------------------------------------- bytes and words
def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets (nulls are empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], dtype=kind)[arr.offset:arr.offset + n + 1].astype(np.int64)
    if arr.null_count:
        size = np.diff(off)
        valid = np.asarray(arr.is_valid())
        if size[~valid].any():
            return text_buffer(arr.fill_null(""))
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off


def pieces(off: np.ndarray, limit: int = PIECE_BYTES):
    """Runs ``(lo, hi)`` of rows holding at most ``limit`` bytes (or one row)."""
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 4096)
        for name, base in (("p", _BASE), ("i", _INV_BASE)):
            a = np.full(size, U(base), dtype=U)
            a[0] = U(1)
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h = h * U(0xD6E8FEB86659FD93)
    h = h ^ (h >> U(29))
    h = h * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


class Words:
    """Words of a run of texts: byte ranges, 64-bit hashes and, per text, the
    offsets of its words. Words are ``[^\\x20\\x09-\\x0D]+``."""

    __slots__ = ("start", "end", "hash", "off")

    def __init__(self, start, end, hash_, off):
        self.start, self.end, self.hash, self.off = start, end, hash_, off


def words(data: np.ndarray, off: np.ndarray, hashed: bool = True) -> Words:
    """Words of the texts ``data[off[i]:off[i+1]]``; byte positions refer to
    ``data``. Long texts are cut at white space, so per-byte arrays stay near
    ``PIECE_BYTES``."""
    lo, hi = int(off[0]), int(off[-1])
    starts, ends, hashes = [], [], []
    bounds = off[1:-1]
    at = lo
    while at < hi:
        to = min(at + PIECE_BYTES, hi)
        if to < hi:
            step = to
            while True:                      # cut after a white space or at a text's end
                b = bounds[np.searchsorted(bounds, at, side="right"):np.searchsorted(bounds, step, side="right")]
                gap = np.flatnonzero(SPACE[data[at:step]])
                cut = max(int(b[-1]) if len(b) else at, at + int(gap[-1]) + 1 if len(gap) else at)
                if cut > at:
                    break
                step = min(step + PIECE_BYTES, hi)
                if step == hi:
                    cut = hi
                    break
            to = cut
        part = data[at:to]
        sep = SPACE[part]
        b = bounds[np.searchsorted(bounds, at, side="right"):np.searchsorted(bounds, to, side="left")] - at
        prev = np.empty(len(part), dtype=bool)
        prev[0] = True
        prev[1:] = sep[:-1]
        prev[b] = True
        nxt = np.empty(len(part), dtype=bool)
        nxt[-1] = True
        nxt[:-1] = sep[1:]
        nxt[b - 1] = True
        word = ~sep
        s = np.flatnonzero(word & prev)
        e = np.flatnonzero(word & nxt) + 1
        if hashed:
            p, inv = _powers(len(part))
            total = np.zeros(len(part) + 1, dtype=U)
            np.cumsum((part.astype(U) + U(1)) * p, out=total[1:])
            hashes.append(mix64((total[e] - total[s]) * inv[s] + (e - s).astype(U)))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    start = cat(starts, np.int64)
    return Words(start, cat(ends, np.int64), cat(hashes, U) if hashed else None,
                 np.searchsorted(start, off, side="left"))


_ROLL = np.array([0xC2B2AE3D27D4EB4F | 1], dtype=U)   # an array: wraps around silently


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive entries (by doubling)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out, have, block, size, mul = None, 0, h, 1, _ROLL
    rest = width
    while rest:
        if rest & 1:
            if out is None:
                out = block
            else:                            # out covers `have` entries, append `size` more
                m = len(h) - (have + size) + 1
                out = out[:m] * mul + block[have:have + m]
            have += size
        rest >>= 1
        if rest:
            block = block[:len(block) - size] * mul + block[size:]
            size *= 2
            mul = mul * mul
    return mix64(out[:n])


def inside(off: np.ndarray, width: int) -> np.ndarray:
    """Mask over the runs of ``rolling``: those that lie within one text."""
    n = int(off[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    ok = np.zeros(n, dtype=np.int32)
    lo, hi = off[:-1], off[1:] - width + 1
    keep = hi > lo
    np.add.at(ok, lo[keep], 1)
    ends = hi[keep]
    np.add.at(ok, ends[ends < n], -1)
    return np.cumsum(ok) > 0


def utf8_points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(len(data) - np.count_nonzero((data & 0xC0) == 0x80))
