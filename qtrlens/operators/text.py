"""Text side: token budgets, note summaries, in-order packing, and a hashed
bag-of-words index with cosine top-k (F4, W3, W4, M1–M3, J7, T2, P18).

The index has one row per entry with its vector. Queries and entries are both
tables: entries are dealt into shares, every share meets the queries in blocks
(``shares.py``) and keeps the best per query.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import estimate_tokens, normalize_vector, tokenize
from ..session import cut_lineage
from .pieces import fold_pieces
from .shares import meet_shares

# ---------------------------------------------------------------- fixed values
DEFAULT_DIM = 64
NOTE_SEPARATOR = " | "
NOTES_KEPT = 50
SUMMARY_MAX_CHARS = 1500
SUMMARY_MIN_CHARS = 200
SCORE_DECIMALS = 6
# -----------------------------------------------------------------------------

KNOWN_TOKENS = 1 << 18     # token buckets a task remembers
EMBED_ROWS = 2048          # texts embedded at a time
SCORE_CELLS = 1 << 21      # scores a task computes at a time


def token_budget_gate(df: DataFrame, text_col: str = "text", max_response_tokens: int = 512,
                      budget: int = 2048) -> DataFrame:
    """``tokens`` and ``within_budget`` — prompt tokens plus the response
    allowance must not exceed the budget."""
    tok = estimate_tokens(text_col)
    return (df.withColumn("tokens", tok)
              .withColumn("within_budget", (F.col("tokens") + F.lit(max_response_tokens)) <= F.lit(budget)))


def summary_budget_chars(budget_tokens: int) -> int:
    """W3 budget variant: ``max(200, budget * 4 // 3)`` characters."""
    return max(SUMMARY_MIN_CHARS, budget_tokens * 4 // 3)


def recent_notes_summary(notes: DataFrame, group_col: str = "conv_id", seq_col: str = "turn",
                         text_col: str = "text", max_chars: int = SUMMARY_MAX_CHARS,
                         keep: int = NOTES_KEPT) -> DataFrame:
    """Per group, the last ``keep`` notes in order joined by `` | ``; when
    longer than ``max_chars`` it is cut there and then back to the last space
    (a cut with no space stays as is).

    ``row_number() <= keep`` is planned with a per-partition group limit, so a
    group with very many notes reaches the final task as at most ``keep``
    rows per input partition; the collected list is bounded by ``keep``."""
    w = Window.partitionBy(group_col).orderBy(F.desc(seq_col))
    last = notes.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
    joined = last.groupBy(group_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq_col, text_col))),
                                 lambda s: s[text_col]), NOTE_SEPARATOR).alias("_s"))
    s = F.col("_s")
    cut = F.regexp_replace(F.substring(s, 1, max_chars), r" [^ ]*\z", "")
    out = F.when(F.length(s) > max_chars, cut).otherwise(s)
    return joined.select(group_col, out.alias("summary"), estimate_tokens(out).alias("tokens"))


# ------------------------------------------------------------------ packing

class _Packing:
    """Greedy chunks over one group's texts (columns: group, tokens, ...). A
    chunk's successor is found by binary search in the prefix sums, so the
    chunk starts are a chain of pointers. State: the tokens in the open chunk
    and its number."""

    fresh = (1 << 60, -1)         # full: the first text starts chunk 0

    def __init__(self, limit: int, template_tokens: int):
        self.room = limit - template_tokens

    def _chain(self, tokens, ends):
        """Prefix sums, and for a chunk begun at each text where the next begins."""
        total = np.concatenate([[0], np.cumsum(tokens)])
        at = np.arange(len(tokens))
        follow = np.searchsorted(total[1:], total[:-1] + self.room, side="right")
        return total, np.minimum(np.maximum(follow, at + 1), ends)

    def fold(self, table, starts, state):
        tokens = table.column(1).to_numpy()
        n = len(tokens)
        size = np.diff(np.append(starts, n))
        total, follow = self._chain(tokens, np.repeat(starts + size, size))
        cur, number = state
        at = min(int(np.searchsorted(total[1:], self.room - cur, side="right")), int(size[0]))
        mark = np.zeros(n, dtype=np.int64)
        chain = follow.tolist()
        while at < n:
            mark[at] = 1
            at = chain[at]
        upto = np.cumsum(mark)
        base = np.where(np.arange(len(starts)) == 0, -number, upto[starts])
        chunk = upto - np.repeat(base, size)
        last = int(starts[-1])
        begun = np.flatnonzero(mark[last:])
        cur = int(total[n] - total[last + begun[-1]]) if len(begun) else cur + int(total[n])
        return np.arange(n), {"chunk_no": chunk}, (cur, int(chunk[-1]))

    def transition(self, table):
        """For each text that may be the first of a new chunk: the tokens left
        in the last chunk and the chunks begun, by pointer doubling."""
        tokens = table.column(1).to_numpy()
        n = len(tokens)
        total, follow = self._chain(tokens, np.full(len(tokens), n))
        root = np.where(follow == n, np.arange(n), follow)
        hops = (follow < n).astype(np.int64)
        while hops.any() and (root[root] != root).any():
            hops, root = hops + hops[root], root[root]
        most = min(n - 1, int(np.searchsorted(total[1:], self.room, side="right")))
        pick = slice(0, most + 1)
        return np.concatenate([[total[n]], total[1:][pick], (total[n] - total[root])[pick], hops[pick] + 1]) \
            .astype(np.int64).tobytes()

    def step(self, note, state):
        a = np.frombuffer(note, dtype=np.int64)
        upto, left, begun = a[1:].reshape(3, -1)
        cur, number = state
        at = int(np.searchsorted(upto, self.room - cur, side="right"))
        if at == len(upto):
            return cur + int(a[0]), number
        return int(left[at]), number + int(begun[at])


def pack_by_token_budget(df: DataFrame, template: str, context_token_limit: int,
                         group_col: str = "conv_id", seq_col: str = "turn",
                         text_col: str = "text") -> DataFrame:
    """Greedy in-order packing per group. A new chunk starts when the
    current one is non-empty and ``cur + tokens + template_tokens > limit``;
    a text larger than the limit sits alone. Each chunk's prompt is the
    template, a blank line, then its texts joined by newlines.

    Groups and turns may be null or repeated: rows are ordered by turn (null
    first), then text, and each keeps its place through the fold, so nothing
    is joined back. A null text counts as empty. The rows are sorted once over
    range partitions and folded in pieces (``pieces.py``), so one very long
    conversation is spread over tasks; a chunk's texts meet in a group bounded
    by the limit."""
    tpl_tokens = max(1, len(template) // 4)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(group_col).alias("group"), estimate_tokens(text).alias("tok"),
                     F.col(seq_col).alias("seq"), text.alias("body"))
    chunks, _ = fold_pieces(rows, ["seq", "body"], _Packing(context_token_limit, tpl_tokens),
                            [T.StructField("chunk_no", T.IntegerType())], "packing")
    per = chunks.groupBy("group", "chunk_no").agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum("tok").alias("text_tokens"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("seq").isNotNull(), "seq", "body"))),
                                 lambda x: x["body"]), "\n").alias("_body"))
    prompt = F.concat(F.lit(template + "\n\n"), F.col("_body"))
    return per.select(F.col("group").alias(group_col), "chunk_no", "n_texts", "text_tokens",
                      estimate_tokens(prompt).alias("prompt_tokens"), prompt.alias("prompt"))


# -------------------------------------------------------------------- index
# An index has one row per entry: its id, its vector (unit length, or all
# zeros for a text without a token) and whatever else the caller keeps with it
# (text, metadata).

def _unit_counts(dim: int, names: list[str]):
    """Token lists (the second column) to unit vectors of hash-bucket counts.
    A task hashes a token once while its ``KNOWN_TOKENS`` buckets last."""
    def fn(batches):
        known: dict[str, int] = {}

        def bucket_of(token):
            at = known.get(token)
            if at is None:
                if len(known) >= KNOWN_TOKENS:
                    known.clear()
                at = known[token] = int.from_bytes(md5(token.encode()).digest(), "big") % dim
            return at

        for batch in batches:
            for lo in range(0, len(batch), EMBED_ROWS):
                part = batch.slice(lo, EMBED_ROWS)
                tokens = part.column(1)
                size = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                coded = tokens.flatten().dictionary_encode()
                bucket = np.array([bucket_of(t) for t in coded.dictionary.to_pylist()], dtype=np.int64)
                row = np.repeat(np.arange(len(part)), size)
                flat = row * dim + (bucket[coded.indices.to_numpy(zero_copy_only=False)] if len(row) else row)
                v = np.bincount(flat, minlength=len(part) * dim).astype("float64").reshape(len(part), dim)
                norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
                v /= np.where(norm == 0, 1.0, norm)
                vec = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * dim, pa.int32()), pa.array(v.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), vec, *part.columns[2:]], names=names)
    return fn


def embed_text(df: DataFrame, id_col: str, text_col: str, dim: int = DEFAULT_DIM,
               keep: Sequence[str] = ()) -> DataFrame:
    """M1: hashed bag-of-words, L2-normalised: ``(id, vec, *keep)``, one row
    per input row. Tokens are found in the JVM and counted row by row over
    Arrow batches, so nothing is shuffled."""
    rows = df.select(F.col(id_col).alias("id"), tokenize(text_col).alias("vec"), *keep)
    schema = T.StructType([T.StructField("vec", T.ArrayType(T.DoubleType())) if f.name == "vec" else f
                           for f in rows.schema.fields])
    return rows.mapInArrow(_unit_counts(dim, rows.columns), schema)


def normalized_vectors(df: DataFrame, id_col: str, vec_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """P18 as an index: ``(id, vec, *keep)`` with every vector cleaned and
    brought to unit length; a null vector has no direction and stays null."""
    return df.select(F.col(id_col).alias("id"), normalize_vector(vec_col).alias("vec"), *keep)


def sparse_rows(index: DataFrame) -> DataFrame:
    """The non-zero entries of every vector: ``(id, bucket, weight)``."""
    return index.select("id", F.posexplode("vec").alias("bucket", "weight")).where(F.col("weight") != 0)


def upsert_index(old: DataFrame, new: DataFrame, key: str = "id", replace: bool = True,
                 order: str | None = None) -> DataFrame:
    """M2: same key replaces (``replace=True``) or both are kept (append).
    Within ``new`` a later row replaces an earlier one: the one with the
    largest ``order`` (without it, of the whole row) stays."""
    if not replace:
        return old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in new.columns if c != key]
    first = [order] if order else []
    last = new.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*first, *_orderable(new, rest))).alias("_r"))
    latest = last.select(key, "_r.*").select(*new.columns)
    return old.join(latest.select(key), key, "left_anti").unionByName(latest, allowMissingColumns=True)


def _orderable(df: DataFrame, cols: Sequence[str]) -> list:
    """Columns that can be compared (a map cannot; its JSON text can)."""
    return [F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in cols]


# --------------------------------------------------------------------- search

def _matrix(vec) -> np.ndarray:
    """Rows of a list column without nulls as a matrix."""
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    flat = np.asarray(vec.flatten(), dtype="float64")
    return flat.reshape(len(vec), -1) if len(vec) else flat.reshape(0, 0)


def _ranks(ids) -> np.ndarray:
    """Places of ids in their order."""
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.asarray(pc.array_sort_indices(ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids))] = \
        np.arange(len(ids))
    return rank


def _pairs_batch(entries: pa.Table, queries: pa.Table, e, q, score, names):
    e, q = pa.array(e, pa.int64()), pa.array(q, pa.int64())
    cols = [queries["_q"].take(q), queries["id"].take(q), pa.chunked_array([pa.array(score, pa.float64())]),
            entries["id"].take(e), entries["_row"].take(e)]
    for batch in pa.Table.from_arrays(cols, names=names).combine_chunks().to_batches():
        yield batch


_FOUND = ["_q", "qid", "score", "id", "_row"]


def _near(k: int):
    """The ``k`` best entries of a share for every query of a block: full
    scores are compared with the worst kept so far, only what passes is
    rounded and ordered."""
    slack = 10.0 ** -SCORE_DECIMALS

    def scorer(entries):
        vectors, rank = _matrix(entries["vec"]), _ranks(entries["id"])

        def score(queries):
            m = _matrix(queries["vec"]).T
            nq = m.shape[1]
            best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]       # entry, query, score
            worst = np.full(nq, -np.inf)
            step = max(k + 1, SCORE_CELLS // nq)
            for lo in range(0, len(vectors), step):
                s = vectors[lo:lo + step] @ m
                least = worst - slack
                if len(s) > k and not np.isfinite(worst).all():
                    with np.errstate(invalid="ignore"):
                        own = -np.partition(np.where(np.isnan(s), np.inf, -s), k - 1, axis=0)[k - 1]
                    least = np.maximum(least, own - slack)
                e, q = np.nonzero(s >= least)
                best = [np.concatenate(c) for c in zip(best, (e + lo, q, np.round(s[e, q], SCORE_DECIMALS)))]
                order = np.lexsort((rank[best[0]], -best[2], best[1]))
                of = best[1][order]
                order = order[np.arange(len(of)) - np.searchsorted(of, of, side="left") < k]
                best = [c[order] for c in best]
                ends = np.searchsorted(best[1], np.arange(nq + 1))
                full = np.flatnonzero(np.diff(ends) == k)
                worst[full] = best[2][ends[full + 1] - 1]
            yield from _pairs_batch(entries, queries, *best, _FOUND)
        return score
    return scorer


def _over(min_score: float | None):
    """Every pair that scores at least ``min_score``, or not zero."""
    def scorer(entries):
        vectors = _matrix(entries["vec"])

        def score(queries):
            m = _matrix(queries["vec"]).T
            step = max(1, SCORE_CELLS // m.shape[1])
            for lo in range(0, len(vectors), step):
                s = np.round(vectors[lo:lo + step] @ m, SCORE_DECIMALS)
                e, q = np.nonzero(s >= min_score if min_score is not None else (s != 0) & ~np.isnan(s))
                if len(e):
                    yield from _pairs_batch(entries, queries, e + lo, q, s[e, q], _FOUND)
        return score
    return scorer


def _searched(entries: DataFrame, queries: DataFrame, scorer):
    """``_q, qid, score, id, _row`` of the pairs a scorer picks, and the
    stored entries with their ``_row``."""
    numbered = cut_lineage(entries.where("vec is not null").withColumn("_row", F.monotonically_increasing_id()),
                           name="entries")
    asked = cut_lineage(queries.select("id", "vec").where("vec is not null")
                        .withColumn("_q", F.monotonically_increasing_id()), name="queries")
    schema = T.StructType([T.StructField("_q", T.LongType()), T.StructField("qid", queries.schema["id"].dataType),
                           T.StructField("score", T.DoubleType()), entries.schema["id"],
                           T.StructField("_row", T.LongType())])
    return meet_shares(numbered.select("id", "vec", "_row"), asked, scorer, schema), numbered


def _with_columns(found: DataFrame, numbered: DataFrame, last: Sequence[str] = ()) -> DataFrame:
    """The entries' other columns beside each found pair."""
    rest = [c for c in numbered.columns if c not in ("id", "vec", "_row")]
    if rest:
        found = found.join(numbered.select("_row", *rest), "_row")
    return found.select("qid", "score", *[c for c in numbered.columns if c not in ("vec", "_row")], *last)


def similarity_pairs(entries: DataFrame, queries: DataFrame, min_score: float | None = None) -> DataFrame:
    """``(qid, score, id, ...)`` for every query and entry whose cosine is
    not zero (or reaches ``min_score``). The stated query set meets all
    entries share by share (``shares.py``)."""
    found, numbered = _searched(entries, queries, _over(min_score))
    return _with_columns(found, numbered)


def topk_similar(entries: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best entries per query row by cosine score rounded to
    six places, ties by id: ``(qid, score, id, ..., rank)``; entry columns
    such as text and metadata come along. Every entry with a vector is a
    candidate, also one with a negative or zero score; query rows that share
    an id are answered one by one.

    Queries meet the entries share by share (``shares.py``); a share gives its
    ``k`` best per query, and only those (shares × queries × k narrow rows) are
    merged. Other columns are fetched for the k that stay."""
    found, numbered = _searched(entries, queries, _near(k))
    w = Window.partitionBy("_q").orderBy(F.desc("score"), "id", "_row")
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return _with_columns(best, numbered, ["rank"])


def query_index(index: DataFrame, query_texts: DataFrame, id_col: str = "id", text_col: str = "text",
                k: int = 5, dim: int = DEFAULT_DIM) -> DataFrame:
    """M3: embed the query texts, score against the index, top-k with the
    entries' text and metadata."""
    return topk_similar(index, embed_text(query_texts, id_col, text_col, dim), k)


def label_centroids(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Mean vector per label (position-wise), unit length: ``(id, vec)`` with
    ``id`` = label. Positions are averaged map-side; a label's group holds as
    many rows as the vector has places."""
    e = df.select(F.col(label_col).alias("id"), F.posexplode(F.col(vec_col)).alias("at", "x"))
    m = e.groupBy("id", "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    v = m.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "m"))).alias("v"))
    return v.select("id", normalize_vector(F.transform("v", lambda x: x["m"])).alias("vec"))
