"""Near duplicates by SimHash: segment popcounts and a grid range join.

A text's fingerprint has a bit set where more than half of its shingles'
64-bit hashes have it. Two fingerprints link at ``RADIUS`` = 2 differing bits
or fewer.

The 64 bits are cut into segments, and a fingerprint is mapped to the counts of
set bits per segment, a point of a small lattice. A differing bit changes one
count by one, so the Manhattan distance of two points never exceeds the number
of differing bits: points further apart than 2 need not be compared. That
range join runs on the unit grid: between two fingerprints that differ in two
bits lies one that differs from each in one, and its point is within one step
of both. So every fingerprint goes to its own cell and the cells one step away
(at most 33), and only fingerprints that meet in a cell are compared, bit by
bit.

Equal fingerprints are one row before any of this, so copies cost nothing, and
a fingerprint has at most 2,080 others in reach, so links never grow with the
square of a group. A cell holding more than ``CROWD`` fingerprints is split
by segments of one bit: there the fingerprint halfway itself is the cell, and
holds at most 65.

Defined results: a null text and one without words have fingerprint zero, and
link like any other. Every input row gives one row; rows that repeat an id are
linked by their own texts. Rows with a null id are linked too, but lend no id
to their component: one of such rows alone has a null component. An empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrlens.llm.common import LOWER, narrow, stored
from qtrlens.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2                    # the grid's halfway points are made for two bits
SEGMENT_BITS, SEGMENTS = 4, 16
CROWD = 512                   # fingerprints of a cell beyond which it is split by single bits
HASH_WORDS = 1 << 16          # shingles hashed at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> tuple[int, int]:
    """The fingerprint (unsigned) and the number of shingles of a UTF-8 text."""
    joined = b" ".join(text.split())
    if not joined:
        return 0, 0
    flat = LOWER[np.frombuffer(joined, dtype=np.uint8)]
    joined, gaps = flat.tobytes(), np.flatnonzero(flat == 0x20)
    n = len(gaps) + 1
    width = min(shingle, n)
    total, counts = n - width + 1, np.zeros(64, dtype=np.int64)
    start, end = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])
    digest = xxhash.xxh64_intdigest
    for lo in range(0, total, HASH_WORDS):
        hi = min(lo + HASH_WORDS, total)
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(start[lo:hi].tolist(), end[lo + width - 1:hi + width - 1].tolist())], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little"), total


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                rows = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in part.column(1)]
                fp = np.array([r[0] for r in rows], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp), pa.array([r[1] for r in rows], pa.int64())],
                                                 names=["doc_id", "fp", "n_shingles"])
    return run


def _bits(segment: int) -> int:
    """The segment's bits as a signed long."""
    mask = ((1 << SEGMENT_BITS) - 1) << (SEGMENT_BITS * segment)
    return mask - (mask >> 63 << 64)


def segment_counts(fp):
    """The point of a fingerprint: the counts of set bits per segment, in
    ``SEGMENT_BITS`` bits of a long each."""
    cell = F.lit(0).cast("long")
    for i in range(SEGMENTS):
        count = F.bit_count(fp.bitwiseAND(F.lit(_bits(i)))).cast("long")
        cell = cell.bitwiseOR(F.shiftleft(count, SEGMENT_BITS * i))
    return cell


def _around(cell):
    """The cell itself, then those one step up and one step down in each
    segment (null where a segment is full or empty)."""
    count = [F.shiftrightunsigned(cell, SEGMENT_BITS * i).bitwiseAND(F.lit(7)) for i in range(SEGMENTS)]
    step = [F.lit(1 << (SEGMENT_BITS * i)) for i in range(SEGMENTS)]
    return F.array(cell, *(F.when(c < SEGMENT_BITS, cell + s) for c, s in zip(count, step)),
                   *(F.when(c > 0, cell - s) for c, s in zip(count, step)))


# Fingerprints one bit away (or none, for the own cell) whose point is the cell
# at place ``at`` of ``_around``.
_HALFWAY = f"""CASE WHEN at = 0 THEN array(fp) ELSE filter(transform(sequence(0, {SEGMENT_BITS - 1}), j ->
    CASE WHEN getbit(fp, {SEGMENT_BITS} * pmod(at - 1, {SEGMENTS}) + j) = CAST(at > {SEGMENTS} AS TINYINT)
         THEN fp ^ shiftleft(1L, {SEGMENT_BITS} * pmod(at - 1, {SEGMENTS}) + j) END), z -> z IS NOT NULL) END"""


def fingerprint_links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``a, b`` (a < b): all pairs of the distinct fingerprints ``fp`` that
    differ in at most two bits, each at least once."""
    points = stored(fps.select("fp", segment_counts(F.col("fp")).alias("cell")), "op12-points")
    met = points.select("fp", F.posexplode(_around(F.col("cell"))).alias("at", "cell")).where("cell IS NOT NULL")
    crowded = met.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("cell", F.lit(True).alias("split"))
    rows = met.join(crowded, "cell", "left").select(
        "fp", "cell", F.explode(F.when(F.col("split"), F.expr(_HALFWAY)).otherwise(F.array(F.lit(0).cast("long")))).alias("z"))
    # Spark sizes rows by the file of points, not by the cells they are spread over, and would broadcast them
    other = rows.select(F.col("fp").alias("other"), "cell", "z").hint("merge")
    return (rows.join(other, ["cell", "z"])
            .where((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS))
            .select(F.col("fp").alias("a"), F.col("other").alias("b")))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  crowd: int = CROWD) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits),
    ``n_shingles`` and ``component_id``, the smallest doc_id reachable over
    links, itself included."""
    texts = stored(narrow(docs, id_col, text_col).mapInArrow(
        _fingerprints(shingle), "doc_id long, fp long, n_shingles long"), "op12-fingerprints")
    labels = components(fingerprint_links(texts.select("fp").distinct(), crowd))
    first = texts.groupBy("fp").agg(F.min("doc_id").alias("first"))
    # a row per fingerprint takes 5 to 20 times the memory that Spark's size of it says: not broadcast either
    classed = first.join(labels.withColumnRenamed("id", "fp").hint("merge"), "fp", "left").select(
        "fp", "first", F.coalesce("comp", "fp").alias("class"))
    least = classed.groupBy("class").agg(F.min("first").alias("component_id"))
    # one row per fingerprint, stored: a fingerprint with very many copies then meets it in a join that splits
    named = stored(classed.join(least.hint("merge"), "class").select("fp", "component_id"), "op12-components")
    return texts.join(named.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "n_shingles", "component_id")
