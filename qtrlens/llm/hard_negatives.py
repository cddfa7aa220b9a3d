"""Hard-negative mining with segment summaries.

An anchor's positives are the rows of its label that score best; a positive's
hard negatives are the rows of other labels whose scores come next below the
positive's, down to a share of it. Scores are integer inner products of
quantised vectors.

A vector is cut into segments, and each segment is kept as its mean and its
deviation (the length of what the mean leaves). For one segment of ``L``
components the inner product is ``L`` times the product of the means, plus or
minus at most the product of the deviations, so two short vectors bound the
score from both sides. The bounds are taken for 1, 4 and 16 segments in turn:
a pair goes on to the next level, and in the end to its exact score, only if
its bounds still reach what is asked: not below the worst of the best kept so
far or the share of the positive's score, not above the positive's score.

Anchors meet all rows share by share (``operators/shares.py``): a share yields
its best rows per anchor, and shares × anchors × best narrow rows are merged by
a window. The anchors are a stated query set, so the work grows with anchors ×
rows; no pairs but the best leave a task.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part. A shorter vector counts as padded with
zeros. Rows that repeat an id are rows of their own: only the anchor's own row
is left out among its positives. Equal scores go by id. An empty table gives an empty
result; other columns are not looked at. Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qtrlens.llm.common import stored
from qtrlens.operators.shares import meet_shares

EVERY = 100                  # anchors are the rows whose id it divides
POSITIVES, NEGATIVES = 5, 5
SHARE = 80                   # a negative scores at least this many hundredths of the positive
SCALE = 256
LEVELS = (1, 4, 16)          # segments, coarse to fine
CELLS = 1 << 19              # pairs bounded at a time
FEW = 16                     # pairs are looked at one by one when fewer than 1 in FEW are left
EXACT = 1 << 53

_FOUND = "anchor long, place int, id long, row long, score long"
_FOUND_NAMES = ["anchor", "place", "id", "row", "score"]


def _vectors(column, width: int) -> np.ndarray:
    """Integer vectors as rows of float64, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(column) -> int:
    return int(max(column.combine_chunks().value_lengths().to_numpy(zero_copy_only=False), default=0))


def summaries(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """``(means, deviations)``, scaled so that their inner products add up to
    the middle and the reach of the bounds."""
    n, width = v.shape
    length = -(-width // segments)
    part = np.zeros((n, segments * length))
    part[:, :width] = v
    part = part.reshape(n, segments, length)
    mean = part.mean(axis=2)
    return mean * np.sqrt(length), np.sqrt(((part - mean[:, :, None]) ** 2).sum(axis=2))


class _Share:
    """The entries of a share with their summaries."""

    def __init__(self, entries: pa.Table, same: bool, keep: int):
        self.id, self.label, self.row = (entries[c].to_numpy() for c in ("id", "label", "row"))
        self.column, self.same, self.keep = entries["vec"], same, keep
        self.width = 0

    def widen(self, width: int):
        if width > self.width or not self.width:
            self.width = max(width, _width(self.column), 1)
            self.v = _vectors(self.column, self.width)
            self.levels = [summaries(self.v, s) for s in LEVELS if s <= self.width]

    def __call__(self, queries: pa.Table):
        self.widen(_width(queries["vec"]))
        q = _vectors(queries["vec"], self.width)
        own, label = queries["row"].to_numpy(), queries["label"].to_numpy()
        slots = int(max(queries["least"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False), default=0))
        least, most = np.full((len(q), slots), np.inf), np.full((len(q), slots), -np.inf)
        for name, out in (("least", least), ("most", most)):
            for i, x in enumerate(queries[name].to_pylist()):
                out[i, :len(x)] = x
        big = np.abs(self.v).max(initial=0) * np.abs(q).max(initial=0) * self.width >= EXACT
        levels = [] if big else [(e, summaries(q, e[0].shape[1])) for e in self.levels]
        best = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0)]            # entry, query, place, score
        step, lo = 256, 0                        # a short first step, so that the next ones know what to beat
        while lo < len(self.v):
            hi = min(lo + step, len(self.v))
            e, a = self._alive(lo, hi, q, own, label, least.min(axis=1), most.max(axis=1), levels)
            score = self._exact(e, a, lo, hi, q, big)
            for place in range(slots):
                ok = np.flatnonzero((score >= least[a, place]) & (score <= most[a, place]))
                best = [np.concatenate(c) for c in zip(best, (e[ok], a[ok], np.full(len(ok), place), score[ok]))]
            key = best[1] * slots + best[2]
            order = np.lexsort((self.row[best[0]], self.id[best[0]], -best[3], key))
            key = key[order]
            first = np.searchsorted(key, key, side="left")
            stay = np.arange(len(key)) - first < self.keep
            best, key = [c[order][stay] for c in best], key[stay]
            ends = np.searchsorted(key, np.arange(len(q) * slots + 1))
            full = np.flatnonzero(np.diff(ends) == self.keep)
            least.reshape(-1)[full] = best[3][ends[full + 1] - 1]
            lo, step = hi, max(256, CELLS // len(q))
        e, a, place, score = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[a]), pa.array(place, pa.int32()), pa.array(self.id[e]), pa.array(self.row[e]),
             pa.array([int(s) for s in score], pa.int64())], names=_FOUND_NAMES)

    def _alive(self, lo, hi, q, own, label, least, most, levels):
        """Pairs (entry, query) of a step whose bounds reach what is asked."""
        alive = (self.label[lo:hi, None] == label) & (self.row[lo:hi, None] != own) if self.same else \
            self.label[lo:hi, None] != label
        alive &= np.isfinite(least) | (least < 0)                # a query that asks for nothing more
        for n, ((em, ed), (qm, qd)) in enumerate(levels):
            if np.count_nonzero(alive) * FEW < alive.size:
                break
            middle, reach = em[lo:hi] @ qm.T, ed[lo:hi] @ qd.T + 0.5
            alive &= (middle + reach >= least) & (middle - reach <= most)
        else:
            n = len(levels)
        e, a = np.nonzero(alive)
        e = e + lo
        for (em, ed), (qm, qd) in levels[n:]:
            middle, reach = (em[e] * qm[a]).sum(axis=1), (ed[e] * qd[a]).sum(axis=1) + 0.5
            ok = (middle + reach >= least[a]) & (middle - reach <= most[a])
            e, a = e[ok], a[ok]
        return e, a

    def _exact(self, e, a, lo, hi, q, big):
        """Scores of pairs; with Python's integers where doubles would round."""
        if big:
            whole = [[int(x) for x in row] for row in q]
            return np.array([sum(int(x) * y for x, y in zip(self.v[i], whole[j])) for i, j in zip(e, a)], dtype=object)
        if len(e) * FEW < (hi - lo) * len(q):
            return np.einsum("ij,ij->i", self.v[e], q[a])
        return (self.v[lo:hi] @ q.T)[e - lo, a]


def _best(entries: DataFrame, queries: DataFrame, same: bool, keep: int) -> DataFrame:
    """Per anchor and place the ``keep`` best rows, numbered by ``rank``."""
    found = meet_shares(entries, queries, lambda share: _Share(share, same, keep), _FOUND)
    w = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE,
                   scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row whose id ``every`` divides and each of its
    best ``positives``, the best ``negatives`` rows of other labels that score
    from ``share`` hundredths of the positive's score up to it. Components
    count as ``floor(scale * x)``."""
    x = F.col("vec")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    sound = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = stored(rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & sound).select(
        "id", "label", F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("double")).alias("vec"),
        F.monotonically_increasing_id().alias("row")), "op13-rows")
    anchors = rows.where(F.pmod("id", F.lit(every)) == 0)
    every_score = lambda v: F.array(F.lit(v).cast("double"))
    first = stored(_best(rows, anchors.select("label", "vec", "row", every_score(float("-inf")).alias("least"),
                                              every_score(float("inf")).alias("most")), True, positives)
                   .select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "op13-positives")
    # a positive's window of scores, from its share up to itself; a positive below zero has none
    limits = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    low = lambda p: F.when(p["positive_score"] >= 0, F.ceil(p["positive_score"] * share / F.lit(100))
                           .cast("double")).otherwise(F.lit(float("inf")))
    asked = stored(anchors.join(limits, F.col("row") == F.col("anchor")).select(
        "label", "vec", "row", F.transform("p", low).alias("least"),
        F.transform("p", lambda p: p["positive_score"].cast("double")).alias("most")), "op13-anchors")
    found = _best(rows, asked, False, negatives)
    return (found.join(first, ["anchor", "place"])
            .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
