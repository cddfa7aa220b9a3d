"""Substring deduplication with fixed-block anchors.

A passage of ``window`` words that occurs in two documents contains, wherever
it lies, one whole block of ``block`` words of the first document when blocks
are cut at multiples of ``block`` and ``2 * block - 1 <= window``. So only the
non-overlapping blocks are indexed, and every rolling window of ``block``
words of every document probes that index. A hit is an anchor, and is
extended: the ``window``-word stretches around it are compared with those
around the anchored blocks, and the stretches that occur in a document with a
smaller id are merged into maximal repeats, whose words are removed.

No pairs of documents are made. The index keeps the smallest document per
block, a stretch only asks for the smallest document that has it, and a
passage shared by many documents costs each of them its own length.

Exchanges are packed: a task sends one binary row per target partition and
flush, holding sorted hashes grouped by document, rather than a row per
window. Blocks are compared by hash (a chance agreement costs one needless
extension), stretches by 96 bits of two independent hashes. The index side
travels to ``SALTS`` partitions each, so that a block probed by a third of all
documents is probed in several tasks.

Defined results: a null text has no words. Documents with a null id lose
nothing and are no reference. Rows that repeat an id are judged one by one
(told apart by the CRC-32 of their texts) and never count as each other's
reference. An empty table gives an empty result;
other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from itertools import compress
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrlens.llm.common import (U, id_bucket, id_bucket_np, inside, key_of, mix64, narrow, partition_keys, pieces,
                                release, rolling, shuffle_parts, stored, text_buffer, words)

WINDOW, BLOCK = 50, 25
SALTS = 4
FLUSH = 2_000_000            # windows a task holds before it sends them
MAX_DOCS = 60_000            # documents per flush (their number must fit 16 bits)
_PACKED = "key int, kind int, payload binary"


def _rows(keys, kinds, payloads):
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(kinds, pa.int32()),
                                       pa.array(payloads, pa.binary())], names=["key", "kind", "payload"])


def _pack(doc_ids: np.ndarray, counts: np.ndarray, *columns: np.ndarray, tag: int = 0, marks=None) -> bytes:
    """One binary row: documents, entries per document, the documents' text
    marks if given, and the entries' columns one after another."""
    n = int(counts.sum())
    head = np.array([len(doc_ids), n, tag], dtype=np.int64)
    return b"".join([head.tobytes(), doc_ids.astype(np.int64).tobytes(), counts.astype(np.uint32).tobytes(),
                     b"" if marks is None else marks.astype(np.uint32).tobytes(), *(c.tobytes() for c in columns)])


def _unpack(raw: bytes, *kinds, marked: bool = False):
    """(doc id per entry, tag, text mark per entry if ``marked``, columns...)
    of a packed row."""
    nd, n, tag = np.frombuffer(raw, dtype=np.int64, count=3)
    at = 24
    ids = np.frombuffer(raw, dtype=np.int64, count=nd, offset=at)
    at += 8 * nd
    counts = np.frombuffer(raw, dtype=np.uint32, count=nd, offset=at)
    at += 4 * nd
    out = []
    if marked:
        out.append(np.repeat(np.frombuffer(raw, dtype=np.uint32, count=nd, offset=at), counts))
        at += 4 * nd
    for k in kinds:
        out.append(np.frombuffer(raw, dtype=k, count=n, offset=at))
        at += np.dtype(k).itemsize * n
    return np.repeat(ids, counts), int(tag), *out


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal entries."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return starts, np.diff(np.concatenate([starts, [len(a)]]))


def _pair_runs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs in which both columns stay equal."""
    starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return starts, np.diff(np.concatenate([starts, [len(a)]]))


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U(32)) * U(shards)) >> U(32)


class _Buffer:
    """Entries waiting to be sent: packed per target on ``drain``."""

    def __init__(self):
        self.ids: list[int] = []
        self.marks: list[int] = []
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, ids, ordinals, *columns, marks=()):
        """``ordinals`` index ``ids``, the documents of this call."""
        base = len(self.ids)
        self.ids.extend(ids)
        self.marks.extend(marks)
        self.parts.append((ordinals + base, *columns))
        self.size += len(ordinals)

    @property
    def full(self):
        return self.size >= FLUSH or len(self.ids) >= MAX_DOCS

    def take(self):
        ids = np.asarray(self.ids, dtype=np.int64)
        cols = [np.concatenate(c) for c in zip(*self.parts)]
        self.__init__()
        return ids, cols


def _by_target(target: np.ndarray, ids, ordinals, columns):
    """Slices of the columns per target (all sorted by target, document)."""
    starts, sizes = _runs(target)
    for s, n in zip(starts, sizes):
        o = ordinals[s:s + n]
        ds, dn = _runs(o)
        yield int(target[s]), ids[o[ds]], dn, [c[s:s + n] for c in columns]


def _anchors_out(keys, shards, salts, block):
    """First pass over the texts: blocks (kind 0) and probes (kind 1)."""
    def drain(buf: _Buffer, kind: int):
        ids, (ordinals, h) = buf.take()
        val = h & U(0xFFFFFFFF)
        packed = np.unique((_shard(h, shards) << U(48)) | (ordinals.astype(U) << U(32)) | val)
        shard, o, val = packed >> U(48), ((packed >> U(32)) & U(0xFFFF)).astype(np.int64), packed.astype(np.uint32)
        out = []
        if kind == 0:
            for t, d, n, (v,) in _by_target(shard, ids, o, [val]):
                out += [(keys[t * salts + s], 0, _pack(d, n, v, tag=t)) for s in range(salts)]
        else:
            salt = id_bucket_np(ids, salts)[o].astype(U)
            order = np.argsort(shard * U(salts) + salt, kind="stable")
            target = (shard * U(salts) + salt)[order]
            for t, d, n, (v,) in _by_target(target, ids, o[order], [val[order]]):
                out.append((keys[t], 1, _pack(d, n, v, tag=t // salts)))
        return _rows(*zip(*out))

    def run(batches):
        bufs = [_Buffer(), _Buffer()]
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            data, off = text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in pieces(off):
                w = words(data, off[lo:hi + 1])
                roll, ok = rolling(w.hash, block), inside(w.off, block)
                pos = np.flatnonzero(ok)
                if not len(pos):
                    continue
                doc = np.searchsorted(w.off, pos, side="right") - 1
                aligned = (pos - w.off[doc]) % block == 0
                bufs[0].add(ids[lo:hi].tolist(), doc[aligned], roll[pos[aligned]])
                bufs[1].add(ids[lo:hi].tolist(), doc, roll[pos])
                for kind in (0, 1):
                    if bufs[kind].full:
                        yield drain(bufs[kind], kind)
        for kind in (0, 1):
            if bufs[kind].size:
                yield drain(bufs[kind], kind)
    return run


def _to_documents(keys, doc: np.ndarray, tag: int, *columns, marks=None):
    """Answers, packed for the partitions of their documents."""
    bucket = id_bucket_np(doc, len(keys))
    order = np.lexsort((doc, bucket) if marks is None else (marks, doc, bucket))
    b, d = bucket[order], doc[order]
    m = None if marks is None else marks[order]
    cols = [c[order] for c in columns]
    starts, sizes = _runs(b)
    out = []
    for s, n in zip(starts, sizes):
        ds, dn = _runs(d[s:s + n]) if m is None else _pair_runs(d[s:s + n], m[s:s + n])
        out.append((keys[int(b[s])], 0, _pack(d[s:s + n][ds], dn, *(c[s:s + n] for c in cols), tag=tag,
                                              marks=None if m is None else m[s:s + n][ds])))
    return out


def _match_anchors(keys):
    """Index the blocks of a shard, probe them, answer with the anchors of
    each document: where it has a block of a smaller document, and which of
    its own blocks a larger document has."""
    def run(batches):
        state = {"key": None}

        def begin(key):
            state.update(key=key, docs=[], vals=[], index=None, tag=0, held=[], size=0)

        def index():
            docs = np.concatenate(state["docs"]) if state["docs"] else np.zeros(0, np.int64)
            vals = np.concatenate(state["vals"]) if state["vals"] else np.zeros(0, np.uint32)
            order = np.lexsort((docs, vals))
            state["docs"], state["vals"] = docs[order], vals[order]
            first, size = _runs(state["vals"])
            state["index"] = (state["vals"][first], state["docs"][first],
                              np.full(len(first), np.iinfo(np.int64).min), size)

        def answer():
            doc, val = (np.concatenate(c) for c in zip(*state["held"]))
            state.update(held=[], size=0)
            return _to_documents(keys, doc, state["tag"], val)

        def finish():
            if state["key"] is None:
                return []
            out = answer() if state["held"] else []
            if state["index"] is not None:
                _, _, most, size = state["index"]
                hit = np.repeat(most, size) > state["docs"]
                if hit.any():
                    out += _to_documents(keys, state["docs"][hit], state["tag"], state["vals"][hit])
            return out

        for batch in batches:
            for key, kind, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key != state["key"]:
                    if out := finish():
                        yield _rows(*zip(*out))
                    begin(key)
                doc, state["tag"], val = _unpack(payload, np.uint32)
                if kind == 0:
                    state["docs"].append(doc)
                    state["vals"].append(val)
                    continue
                if state["index"] is None:
                    index()
                known, least, most, _ = state["index"]
                if not len(known):
                    continue
                at = np.searchsorted(known, val)
                at[at == len(known)] = 0
                hit = (known[at] == val) & (least[at] < doc)
                if hit.any():
                    np.maximum.at(most, at[hit], doc[hit])
                    state["held"].append((doc[hit], val[hit]))
                    state["size"] += int(hit.sum())
                    if state["size"] >= FLUSH:
                        yield _rows(*zip(*answer()))
        if out := finish():
            yield _rows(*zip(*out))
    return run


def _with_documents(answers: DataFrame, docs: DataFrame, keys: list[int]) -> DataFrame:
    """Answers and whole documents, each in its document's partition, answers
    first."""
    n = len(keys)
    bucket = id_bucket(F.coalesce("doc_id", F.xxhash64("text")), n)
    both = answers.select("key", "kind", "payload", *(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema)
                          ).unionByName(
        docs.select(key_of(bucket, keys).alias("key"), F.lit(1).alias("kind"),
                    F.lit(None).cast("binary").alias("payload"), *docs.columns))
    return both.repartition(n, "key").sortWithinPartitions("key", "kind")


class _Answers:
    """Answers of a partition, looked up by document."""

    def __init__(self, columns, marked: bool = False):
        self.columns, self.parts, self.marked = [*([np.uint32] if marked else []), *columns], [], marked
        self.doc = None

    def add(self, payload):
        doc, tag, *cols = _unpack(payload, *self.columns[self.marked:], marked=self.marked)
        self.parts.append((doc, np.full(len(doc), tag, dtype=np.int64), *cols))

    def seal(self):
        if self.doc is None:
            cols = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else \
                [np.zeros(0, np.int64), np.zeros(0, np.int64), *(np.zeros(0, k) for k in self.columns)]
            order = np.argsort(cols[0], kind="stable")
            self.doc, *self.values = [c[order] for c in cols]
            self.parts = []

    def of(self, doc_id):
        lo, hi = np.searchsorted(self.doc, [doc_id, doc_id + 1]) if doc_id is not None else (0, 0)
        return [v[lo:hi] for v in self.values]


def _stretches_out(keys, window, block, shards):
    """Second pass: the stretches around the anchors, by their hashes."""
    def drain(buf):
        marks = np.asarray(buf.marks, dtype=np.uint32)
        ids, (o, g, check, pos) = buf.take()
        shard = _shard(g, len(keys))
        order = np.lexsort((pos, o, shard))
        out = []
        both = np.stack([ids, marks.astype(np.int64)], axis=1)
        for t, d, n, cols in _by_target(shard[order], both, o[order], [g[order], check[order], pos[order]]):
            out.append((keys[t], 0, _pack(d[:, 0], n, *cols, marks=d[:, 1])))
        return _rows(*zip(*out))

    def run(batches):
        found, buf = _Answers([np.uint32]), _Buffer()
        for batch in batches:
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            for payload in batch.column(2).filter(pa.array(kind == 0)):
                found.add(payload.as_py())
            if not (kind == 1).any():
                continue
            found.seal()
            rows = batch.filter(pa.array(kind == 1))
            rows = rows.filter(rows.column(3).is_valid())
            ids = rows.column(3).to_numpy(zero_copy_only=False)
            mine = np.isin(ids, found.doc)
            rows, ids = rows.filter(pa.array(mine)), ids[mine]
            data, off = text_buffer(rows.column(4))
            for lo, hi in pieces(off):
                w = words(data, off[lo:hi + 1])
                if len(w.hash) < window:
                    continue
                roll, g, ok = rolling(w.hash, block), rolling(w.hash, window), inside(w.off, window)
                check = rolling(mix64(w.hash ^ U(0xA5A5A5A55A5A5A5A)), window).astype(np.uint32)
                near = np.zeros(len(w.hash) + 1, dtype=np.int32)
                name = (_shard(roll, shards) << U(32)) | (roll & U(0xFFFFFFFF))
                for i in range(hi - lo):
                    tag, val = found.of(int(ids[lo + i]))
                    a, b = w.off[i], w.off[i + 1]
                    if not len(val) or b - a < window:
                        continue
                    at = a + np.flatnonzero(np.isin(name[a:b - block + 1], (tag.astype(U) << U(32)) | val.astype(U)))
                    np.add.at(near, np.maximum(at - (window - block), a), 1)
                    np.add.at(near, np.minimum(at + 1, b), -1)
                pos = np.flatnonzero((np.cumsum(near)[:len(ok)] > 0) & ok)
                if len(pos):
                    doc = np.searchsorted(w.off, pos, side="right") - 1
                    buf.add(ids[lo:hi].tolist(), doc, g[pos], check[pos], (pos - w.off[doc]).astype(np.uint32),
                            marks=[crc32(data[off[i]:off[i + 1]]) for i in range(lo, hi)])
                    if buf.full:
                        yield drain(buf)
        if buf.size:
            yield drain(buf)
    return run


def _match_stretches(keys):
    """Per stretch its smallest document; larger ones are told where theirs
    starts."""
    def judge(parts):
        doc, mark, g, check, pos = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((doc, check, g))
        doc, mark, g, check, pos = doc[order], mark[order], g[order], check[order], pos[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (check[1:] != check[:-1])])
        starts = np.flatnonzero(new)
        least = np.repeat(doc[starts], np.diff(np.concatenate([starts, [len(doc)]])))
        late = doc > least
        return _to_documents(keys, doc[late], 0, pos[late], marks=mark[late]) if late.any() else []

    def run(batches):
        key, parts = None, []
        for batch in batches:
            for k, payload in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != key:
                    if parts and (out := judge(parts)):
                        yield _rows(*zip(*out))
                    key, parts = k, []
                doc, _, *cols = _unpack(payload, U, np.uint32, np.uint32, marked=True)
                parts.append((doc, *cols))
        if parts and (out := judge(parts)):
            yield _rows(*zip(*out))
    return run


_OUT = ("doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,stop:int>>, "
        "kept_text string")
_OUT_NAMES = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept_text"]


def _remove(window, with_text):
    """Third pass: words covered by removed stretches go."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def one(doc_id, text: bytes, starts: np.ndarray):
        found = text.split()                 # bytes split at exactly this white space
        n = len(found)
        if not len(starts):
            return (doc_id, n, 0, hashlib.sha256(b" ".join(found)).hexdigest(), [],
                    text.decode("utf-8", "replace") if with_text else None)
        starts = np.unique(starts.astype(np.int64))
        new = np.concatenate([[True], starts[1:] > starts[:-1] + window])
        first = starts[new]
        last = np.concatenate([starts[:-1][new[1:]], starts[-1:]]) + window
        keep = np.ones(n, dtype=bool)
        for a, b in zip(first, last):
            keep[a:b] = False
        left = None
        if with_text:
            w = words(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), hashed=False)
            edge = [0]
            for a, b in zip(first, last):    # cut up to the next word that stays
                edge += [int(w.start[a]), int(w.start[b]) if b < n else len(text)]
            edge.append(len(text))
            left = b"".join(text[edge[k]:edge[k + 1]] for k in range(0, len(edge), 2)).decode("utf-8", "replace")
        return (doc_id, n, int(n - keep.sum()), hashlib.sha256(b" ".join(compress(found, keep))).hexdigest(),
                [{"start": int(a), "stop": int(b)} for a, b in zip(first, last)], left)

    def starts_of(found, doc_id, text):
        """Removed stretches of this very text, not of a namesake's."""
        _, mark, start = found.of(doc_id)
        return start[mark == crc32(text)] if len(start) else start

    def run(batches):
        found = _Answers([np.uint32], marked=True)
        for batch in batches:
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            for payload in batch.column(2).filter(pa.array(kind == 0)):
                found.add(payload.as_py())
            rows = batch.filter(pa.array(kind == 1))
            if not len(rows):
                continue
            found.seal()
            data, off = text_buffer(rows.column(4))
            ids = rows.column(3).to_pylist()
            for lo, hi in pieces(off, 1 << 22):
                found_in = [data[off[i]:off[i + 1]].tobytes() for i in range(lo, hi)]
                out = [one(i, t, starts_of(found, i, t)) for i, t in zip(ids[lo:hi], found_in)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.string()]
                carried = [rows.column(k).slice(lo, hi - lo) for k in range(5, rows.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)] + carried,
                    names=_OUT_NAMES + ["carried"] * len(carried))
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    block: int = BLOCK, with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``,
    ``spans`` (removed word ranges, maximal) and, with ``with_text``,
    ``kept_text``: the text without the removed ranges, else as it was.
    Columns named in ``carry`` come along as fields of a struct ``carried``."""
    if 2 * block - 1 > window:
        raise ValueError("a window must contain a whole aligned block: 2 * block - 1 <= window")
    spark = docs.sparkSession
    texts = narrow(docs, id_col, text_col)
    n = shuffle_parts(spark)
    keys = partition_keys(spark, n)
    salts = SALTS if n >= 4 * SALTS else 1
    shards = max(1, n // salts)

    sent = texts.mapInArrow(_anchors_out(keys, shards, salts, block), _PACKED)
    anchors = stored(sent.repartition(n, "key").sortWithinPartitions("key", "kind")
                     .mapInArrow(_match_anchors(keys), _PACKED), "op2-anchors")
    del sent
    release(spark)
    sent = _with_documents(anchors, texts, keys).mapInArrow(_stretches_out(keys, window, block, shards), _PACKED)
    repeats = stored(sent.repartition(n, "key").sortWithinPartitions("key")
                     .mapInArrow(_match_stretches(keys), _PACKED), "op2-repeats")
    del sent
    release(spark)
    schema = T.StructType.fromDDL(_OUT)
    if carry:
        texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                            F.col(f"`{text_col}`").cast("string").alias("text"),
                            F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried"))
        schema = schema.add(texts.schema["carried"])
    out = _with_documents(repeats, texts, keys).mapInArrow(_remove(window, with_text), schema)
    return out if with_text else out.drop("kept_text")
