"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. ``TREES`` independent trees branch
the documents by minwise tokens: at every level of a tree a document follows
the smallest of its shingles under that level's hash, so two documents of
similarity J stay together with probability J per level. A node with at most
``NODE`` documents is a leaf; larger ones branch on, down to ``LEVELS``. A
pair of similarity 0.8 misses one tree with probability 0.2 if its first node
is small and 0.49 if all its nodes are large, hence all 16 trees with 1e-11
to 1e-5: the recall aimed at is above 0.9999 per link.

Equal sets are one class first, so copies cost one row each. Leaves are
compared in two rounds, and every link is confirmed on full sets:

1. each document with the leaf's smallest id; connected components follow;
2. what lies in different components of a leaf, exhaustively: documents
   outside the leaf's largest component meet all others in blocks, so a leaf
   of any size is split over tasks, and one that round 1 has connected costs
   nothing more. What may be linked by signature forms clusters, in which full
   sets are compared, block by block again, once for all trees.

No round emits all pairs of a group: round 1 has one per member, round 2 only
what connects components. Signatures are ``TREES * LEVELS`` minima; below half
of them agreeing a pair is no candidate (for J = 0.8 a chance of 1e-6).

Defined results: a null or wordless text has the empty set, is linked with
nothing and stays. A document with a null id is linked with nothing (null
component, kept). Rows that repeat an id are one document; all are reported.
An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrlens.llm.common import (LOWER, U, inside, mix64, narrow, pieces, release, rolling, stored, text_buffer, words)
from qtrlens.llm.components import components

SHINGLE = 5
PERCENT = 80
TREES, LEVELS = 16, 3
NODE = 64
BLOCK = 256
_rng = np.random.default_rng(20240601)
_XOR = _rng.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, TREES * LEVELS, dtype=np.uint32) | np.uint32(1)
AGREE = TREES * LEVELS // 2


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and
    the offsets of the texts' sets. Texts with fewer words than ``width`` have
    their whole sequence as one shingle."""
    w = words(LOWER[data[off[0]:off[-1]]], off - off[0])
    roll, ok = rolling(w.hash, width), inside(w.off, width)
    pos = np.flatnonzero(ok)
    doc, h = np.searchsorted(w.off, pos, side="right") - 1, roll[pos]
    count = np.diff(w.off)
    for k in range(1, width):
        few = np.flatnonzero(count == k)
        if len(few):
            doc = np.concatenate([doc, few])
            h = np.concatenate([h, mix64(rolling(w.hash, k)[w.off[few]] + U(k))])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(len(off)))


def _signatures(width):
    def run(batches):
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in pieces(off):
                h, at = shingle_sets(data, off[lo:hi + 1], width)
                n = np.diff(at)
                full = np.flatnonzero(n)
                sig = np.zeros((hi - lo, TREES * LEVELS), dtype=np.uint32)
                sums = np.zeros((2, hi - lo), dtype=U)
                if len(full):
                    starts = at[full]
                    x = (h >> U(32)).astype(np.uint32)
                    for k in range(TREES * LEVELS):
                        sig[full, k] = np.minimum.reduceat((x ^ _XOR[k]) * _MUL[k], starts)
                    sums[0, full] = np.add.reduceat(mix64(h), starts)
                    sums[1, full] = np.add.reduceat(mix64(h ^ U(0x5851F42D4C957F2D)), starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                     pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "n_shingles", "s1", "s2", "sig"])
    return run


_CLASS = ["n_shingles", "s1", "s2"]


def _paths(batches):
    """The nodes of every class: per tree one key per level."""
    for batch in batches:
        if not len(batch):
            continue
        rep = batch.column(0).to_numpy(zero_copy_only=False)
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(len(rep), TREES, LEVELS)
        key = np.broadcast_to(mix64(np.arange(1, TREES + 1, dtype=U)), (len(rep), TREES))
        keys = []
        for level in range(LEVELS):
            key = mix64(key * U(0x9E3779B97F4A7C15) + sig[:, :, level].astype(U) + U(level + 1))
            keys.append(key.reshape(-1).view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rep, TREES)), *map(pa.array, keys)],
                                         names=["rep", *(f"k{i}" for i in range(LEVELS))])


def leaves(classes: DataFrame, node_size: int = NODE) -> DataFrame:
    """``node, rep, members``: leaves with at least two classes."""
    rows = classes.select("rep", "sig").mapInArrow(
        _paths, "rep long, " + ", ".join(f"k{i} long" for i in range(LEVELS)))
    out = None
    for level in range(LEVELS):
        key = f"k{level}"
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        met = rows.join(sizes, key)
        done = met if level == LEVELS - 1 else met.where(F.col("members") <= node_size)
        done = done.select(F.col(key).alias("node"), "rep", "members")
        out = done if out is None else out.unionByName(done)
        if level < LEVELS - 1:
            rows = stored(met.where(F.col("members") > node_size).drop("members"), f"op4-level{level}")
    return out


def _agree(batches):
    """Candidates whose signatures and sizes allow a link."""
    for batch in batches:
        if not len(batch):
            continue
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint8).reshape(len(batch), -1)
                for k in (4, 5))
        na, nb = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
        ok = ((a == b).sum(axis=1) >= AGREE) & (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb))
        out = batch.filter(pa.array(ok))
        yield pa.RecordBatch.from_arrays([out.column(0), out.column(1)], names=["a", "b"])


def _short(name):
    """One byte of every minimum in ``sig`` (they are four bytes each)."""
    return F.expr("unhex(array_join(transform(sequence(0, " + str(TREES * LEVELS - 1) + "), i -> "
                  "substr(hex(sig), i * 8 + 1, 2)), ''))").alias(name)


def star_candidates(nodes: DataFrame, marks: DataFrame) -> DataFrame:
    """``a, b``: each leaf's smallest id with its other members."""
    first = nodes.groupBy("node").agg(F.min("rep").alias("a"))
    pairs = (nodes.join(first, "node").where("rep <> a").select("a", F.col("rep").alias("b")).distinct())
    for side in ("a", "b"):
        pairs = pairs.join(marks.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"n{side}"),
                                        F.col("mark").alias(f"m{side}")), side)
    return pairs.select("a", "b", "na", "nb", "ma", "mb").mapInArrow(_agree, "a long, b long")


def _find(parent: dict, x):
    while parent.get(x, x) != x:
        parent[x] = parent.get(parent[x], parent[x])
        x = parent[x]
    return x


def _by_block(batches, hold, probe):
    """Stream rows sorted by (group, block, probing or not): the held rows of
    a block are gathered (their number is bounded), the probing ones then pass
    one by one. ``hold(rows)`` prepares a block, ``probe(block, row)`` gives
    links."""
    key, held, block, out = None, [], None, []
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for group, number, probing, *row in zip(*cols):
            if (group, number) != key:
                key, held, block = (group, number), [], None
            if not probing:
                held.append(row)
                continue
            if not held:
                continue                       # no member fell into this block
            if block is None:
                block = hold(held)
            out += probe(block, row)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])


def _likely(batches):
    """Documents that may be linked across components, by signature: not all
    pairs, but links enough to keep each such pair connected."""
    def hold(held):
        rep, comp, size, mark = zip(*held)
        return (np.array(rep), np.array(comp), np.array(size),
                np.frombuffer(b"".join(mark), dtype=np.uint8).reshape(len(rep), -1), {})

    def probe(block, row):
        rep, comp, size, mark, parent = block
        mine = np.frombuffer(row[3], dtype=np.uint8)
        ok = ((mark == mine).sum(axis=1) >= AGREE) & (comp != row[1])
        ok &= 100 * np.minimum(size, row[2]) >= PERCENT * np.maximum(size, row[2])
        out = []
        for other in rep[ok].tolist():
            x, y = _find(parent, row[0]), _find(parent, other)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((row[0], other))
        return out
    return _by_block(batches, hold, probe)


def _linked(percent):
    """Links between components, by full sets: a block's sets form one sorted
    list of (shingle, document), in which a probe finds all its overlaps."""
    def hold(held):
        rep, comp, _, sets = zip(*held)
        arrays = [np.frombuffer(x, dtype=U) for x in sets]
        size = np.array([len(x) for x in arrays])
        flat, doc = np.concatenate(arrays), np.repeat(np.arange(len(rep)), size)
        order = np.argsort(flat, kind="stable")
        return list(rep), list(comp), size, flat[order], doc[order], {}

    def probe(block, row):
        rep, comp, size, flat, doc, parent = block
        mine = np.frombuffer(row[3], dtype=U)
        lo, hi = np.searchsorted(flat, mine, side="left"), np.searchsorted(flat, mine, side="right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(doc[at], minlength=len(rep))
        hit = np.flatnonzero(100 * common >= percent * (size + len(mine) - common))
        out = []
        for k in hit.tolist():
            x, y = _find(parent, row[1]), _find(parent, comp[k])
            if x != y:                         # components already joined need no further link
                parent[max(x, y)] = min(x, y)
                out.append((row[0], rep[k]))
        return out
    return lambda batches: _by_block(batches, hold, probe)


def _in_blocks(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Members of groups (``group, rep, comp`` and more) dealt into blocks:
    each member is held in one block of its group, and those outside the
    group's largest component probe all its blocks. Groups of one component
    drop out."""
    per = rows.groupBy(group, "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = per.groupBy(group).agg(F.count(F.lit(1)).alias("comps"), F.sum("n").alias("members"),
                                     F.max(F.struct("n", "comp")).alias("top")).where("comps > 1") \
        .select(group, "members", F.col("top.comp").alias("top"))
    rows = rows.join(largest, group)
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    held = rows.select(group, F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"), F.lit(False).alias("probing"),
                       *columns)
    probes = rows.where(F.col("comp") != F.col("top")).select(
        group, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(True).alias("probing"), *columns)
    return held.unionByName(probes)


def _meet(blocks: DataFrame, group: str) -> DataFrame:
    return blocks.repartition(group, "block").sortWithinPartitions(group, "block", "probing", "rep")


def cross_candidates(nodes: DataFrame, comps: DataFrame, marks: DataFrame) -> DataFrame:
    """``a, b``: links that connect the leaves' members which, by signature,
    may be linked across components."""
    rows = nodes.join(comps.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(
        "node", "rep", F.coalesce("comp", "rep").alias("comp"))
    blocks = _in_blocks(rows, "node", ["rep", "comp"]).join(
        marks.select("rep", F.col("n_shingles").alias("size"), "mark"), "rep") \
        .select("node", "block", "probing", "rep", "comp", "size", "mark")
    return _meet(blocks, "node").mapInArrow(_likely, "a long, b long").distinct()


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of some ids. The ids are a share of the corpus, so the plan
    is a shuffled join at every size; the hash side holds ids only, and the
    texts need no sort."""
    return texts.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")


def cross_links(candidates: DataFrame, comps: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links between components (stored). What the candidates
    connect is one cluster, whatever trees it came from, and is compared once,
    on full sets: documents outside its largest component with all others."""
    clusters = stored(components(candidates).select(F.col("id").alias("rep"), F.col("comp").alias("cluster")), "op4-clusters")
    rows = clusters.join(comps.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(
        "cluster", "rep", F.coalesce("comp", "rep").alias("comp"))
    sets = stored(_texts_of(texts, clusters.select(F.col("rep").alias("doc_id")))
                  .mapInArrow(_set_rows(width), "rep long, set binary"), "op4-sets-cross")
    release(texts.sparkSession)
    blocks = _in_blocks(rows, "cluster", ["rep", "comp"]).join(sets, "rep").select(
        "cluster", "block", "probing", "rep", "comp", F.lit(0).alias("size"), "set")
    links = stored(_meet(blocks, "cluster").mapInArrow(_linked(percent), "a long, b long"), "op4-links-cross")
    release(texts.sparkSession)
    return links


def _set_rows(width):
    def run(batches):
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            for lo, hi in pieces(off):
                h, at = shingle_sets(data, off[lo:hi + 1], width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo),
                     pa.array([h[at[i]:at[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())], names=["rep", "set"])
    return run


def _confirm(percent):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(a.as_buffer(), dtype=U)
                y = np.frombuffer(b.as_buffer(), dtype=U)
                if len(x) < len(y):
                    x, y = y, x
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                common = int(np.count_nonzero(x[at] == y)) if len(x) else 0
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            out = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1)], names=["a", "b"])
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity (stored)."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = stored(_texts_of(texts, wanted).mapInArrow(_set_rows(width), "rep long, set binary"), "op4-sets")
    release(texts.sparkSession)
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("set").alias("sb")), "b"))
    links = stored(both.select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a long, b long"), "op4-links")
    release(texts.sparkSession)
    return links


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               percent: int = PERCENT, node_size: int = NODE) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    texts = narrow(docs, id_col, text_col)
    rows = stored(texts.mapInArrow(_signatures(shingle), "doc_id long, n_shingles long, s1 long, s2 long, sig binary"),
                  "op4-signatures")
    classes = stored(rows.where("n_shingles > 0 and doc_id is not null").groupBy(*_CLASS).agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "op4-classes")
    marks = stored(classes.select("rep", "n_shingles", _short("mark")), "op4-marks")
    nodes = stored(leaves(classes, node_size), "op4-nodes")
    release(docs.sparkSession)

    pairs = stored(star_candidates(nodes, marks), "op4-stars")
    links = confirmed(pairs, texts, shingle, percent)
    comps = components(links)
    pairs = stored(cross_candidates(nodes, comps, marks), "op4-cross")
    if not pairs.isEmpty():
        links = cross_links(pairs, comps, texts, shingle, percent)
        if not links.isEmpty():
            comps = components(links, comps)

    named = classes.join(comps, classes.rep == comps.id, "left").select(
        *_CLASS, F.coalesce("comp", "rep").alias("component_id"))
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return (rows.drop("sig").join(named, _CLASS, "left")
            .select("doc_id", "n_shingles",
                    F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
