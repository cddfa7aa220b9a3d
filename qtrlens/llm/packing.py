"""Packing documents into training windows by lexical retrieval.

Documents are tokenised once and stored as id arrays, with document frequencies
counted over the whole corpus (one entry per vocabulary entry passes the
driver). A document's *query* are its ``QUERY_TERMS`` strongest ids by BM25
weight. Packing goes in rounds over what is left:

1. some of the documents, picked by hash, are seeds; the others are indexed by
   BM25 (weights in 16 bits). A task holds a lane of seeds with their nearest
   so far and meets a column of the others, a shard at a time; the columns are
   few and fixed, so the lists grow with the seeds and not with the shards;
2. a seed asks for its nearest unused neighbours, as many as fill its window; a
   document asked for by several goes to the one that scores it best, the
   others ask for their next, until a list or the window's room is used up;
3. a seed with what it got is done; documents that nobody got go on.

The share of seeds follows from the mean length (a seed needs half a window on
average) and grows from round to round until all that is left are seeds, so
the rounds are few (about ten) whatever the corpus' size, and one plan holds
for every size. Seeds with their neighbours stand in one row ordered by the
seed's strongest id, cut every ``window`` tokens, so only the corpus' last
window is padded; a window therefore need not start with its seed, and its
last document may go on in the next. Every token lies in exactly one piece.

Nothing is gathered: a task holds one shard and one lane of bounded size,
claims are narrow joins, and offsets are a segmented running sum.
Retrieval grows with seeds x others, through the postings of a query's few
terms.

Defined results: a null text is empty, so its document is the end token only.
Null ids and repeated rows are documents of their own. An empty table gives
an empty result; other columns are not looked at. Equal scores go by a hash of
id and tokens, onward from the seed's own, so that copies do not all name the
same few.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qtrlens.llm import bpe as BPE
from qtrlens.llm.bpe import load_bpe
from qtrlens.llm.common import key_of, narrow, partition_keys, pieces, shuffle_parts, stored, text_buffer
from qtrlens.operators.ordered import segmented_running_sum
from qtrlens.operators.shares import struct_table

WINDOW = 1024
END_ID = 0
QUERY_TERMS = 8
SHARE_ROWS = 1 << 15                    # documents of an index shard, at most
SEED_BLOCK = 16                         # seeds a shard answers at a time, at most
COLUMNS = 3                             # parts of the documents that are searched at the same time, each by its own tasks
LANES, LEAST_LANE = 4, 4096             # lanes of seeds that keep tasks busy, if of so many seeds
LANE_PLACES = 1 << 22                   # places in the lists of a lane, at most
WHOLE = 8                               # an id in more than one of so many documents is kept as a row of all
IMPACTS = 1 << 16                       # steps of a stored weight
TEXT_BYTES = 1 << 22                    # text a task encodes at a time
STEP_BYTES = 1 << 19                    # text cut into words by one numpy step, if a text has no more
TABLE_WORDS = 1 << 18                   # places for words whose ids a task keeps at hand
RARE_WORDS = 1 << 19                    # and for those of them that came once in a piece
WORD_BYTES, WORD_IDS = 15, 8            # words of more bytes or ids are not kept
WORDS_STEP = 1 << 15                    # words looked up by one numpy step
TEXT_IDS = 1 << 18                      # ids a task weighs or cuts at a time
CELLS = 1 << 20                         # scores of one numpy step
GROUPS = 128                            # a row of scores is cut into so many groups to find a lower bound of the k-th
K1, B = 1.2, 0.75
_TOTAL_DOCS, _TOTAL_TOKENS = -2, -1     # pseudo terms of the counts table: its last two entries

_ENCODERS: dict[str, "_Encoder"] = {}

# Bytes by class: letters (all of the two-byte characters, but for two signs), digits, other signs, white space, a text's end.
_LETTER, _DIGIT, _SIGN, _WHITE, _END = range(5)
_CLASS = bytes(_END if i == 0 else _WHITE if i in (0x20, 0x09, 0x0A, 0x0D) else _DIGIT if 0x30 <= i < 0x3A
               else _LETTER if i >= 0x80 or chr(i).isalpha() else _SIGN for i in range(256))
_COMMON = np.zeros(256, dtype=bool)     # bytes of the characters that bpe._NOT_SIMPLE leaves
_COMMON[[0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = True
_ODD = (~_COMMON).tobytes()


def _starts(raw: bytes) -> np.ndarray:
    """Where the pre-tokeniser's words start in texts of common characters,
    each ended by a zero byte (a word of its own)."""
    data = np.frombuffer(raw, dtype=np.uint8)
    c = np.frombuffer(raw.translate(_CLASS), dtype=np.uint8)
    lead = np.flatnonzero(data == 0xC3)                    # the signs among the letters
    lead = lead[np.isin(data[lead + 1], [0x97, 0xB7])]
    if len(lead):
        c = c.copy()
        c[lead] = c[lead + 1] = _SIGN
    before, after = np.append(np.uint8(_END), c[:-1]), np.append(c[1:], np.uint8(_END))
    spaced = np.append(False, data[:-1] == 0x20)
    white = c == _WHITE
    # of white space the last byte starts a word if one follows, and a space goes with it
    start = (white & (after != _WHITE) & (after != _END)) | (c != before) & (white | ~spaced) | (c == _END)
    at = np.flatnonzero(data == 0x27)
    at = at[(before[at] != _SIGN) & ~spaced[at]]
    if len(at):                                            # 's 't 'm 'd 're 've 'll
        x, y = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
        one = np.isin(x, np.frombuffer(b"stmd", np.uint8))
        two = ((x == 0x72) | (x == 0x76)) & (y == 0x65) | (x == 0x6C) & (y == 0x6C)
        start[at[one | two] + 1] = False
        start[at[two] + 2] = False
        start[at[one] + 2] = True
        start[at[two] + 3] = True
    return np.flatnonzero(start)


def _joined(words: pa.Array, which: np.ndarray, before: bytes = b"") -> str:
    """Some of the words in one text, each after ``before``."""
    words = words.filter(pa.array(which))
    if before:
        words = pc.binary_join_element_wise(pa.scalar(before), words, pa.scalar(b""))
    data, off = text_buffer(words)
    return data[off[0]:off[-1]].tobytes().decode()


def _runs(first: np.ndarray, n: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The numbers of runs of ``n`` entries from ``first`` on, one after the other."""
    at = np.repeat(first - (upto - n), n)
    at += np.arange(len(at))
    return at


def _taken(flat: np.ndarray, first: np.ndarray, n: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Runs of ``n`` entries from ``first`` on, one after the other."""
    out, done = np.empty(upto[-1] if len(upto) else 0, flat.dtype), 0
    for lo in range(0, len(n), WORDS_STEP):
        some = slice(lo, lo + WORDS_STEP)
        to = int(upto[some][-1])
        out[done:to] = flat[_runs(first[some], n[some], upto[some] - done)]
        done = to
    return out


_KEPT = [np.array([(1 << 8 * min(max(n - at, 0), 8)) - 1 for n in range(WORD_BYTES + 1)] + [0], np.uint64) for at in (0, 8)]


def _keys(raw: bytes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most ``WORD_BYTES`` bytes, filled up by zeros, as two
    numbers (the others: nought, like the zero byte)."""
    data = np.frombuffer(raw + bytes(24 + -len(raw) % 8), dtype="<u8")
    keys = np.empty((2, len(start)), np.uint64)
    for lo in range(0, len(start), WORDS_STEP):
        some = slice(lo, lo + WORDS_STEP)
        at, n = start[some] >> 3, np.minimum(size[some], WORD_BYTES + 1)
        right = (start[some] & 7).astype(np.uint64) << np.uint64(3)
        left = np.uint64(64) - right                       # a shift by 64 gives nought
        a, b, c = data[at], data[at + 1], data[at + 2]
        keys[0, some] = (a >> right | b << left) & _KEPT[0][n]
        keys[1, some] = (b >> right | c << left) & _KEPT[1][n]
    return keys[0], keys[1]


class _Table:
    """Words and their ids, each in the one place its bytes say: a later word
    takes the place of an earlier one."""

    def __init__(self, most: int, kind):
        self.bits = most.bit_length() - 1
        self.keys = np.zeros((1 << self.bits, 2), np.uint64)   # the second one's free byte: the number of ids
        self.last, self.ids = np.zeros(1 << self.bits, np.int32), np.zeros(WORD_IDS << self.bits, kind)

    def __len__(self) -> int:
        return int(np.count_nonzero(self.keys[:, 0]))

    def _place(self, low, high):
        mixed = (low ^ high * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether words are there, where their ids start, and their number."""
        there, first, n = (np.empty(len(low), kind) for kind in (bool, np.int64, np.int64))
        for lo in range(0, len(low), WORDS_STEP):
            some = slice(lo, lo + WORDS_STEP)
            at = self._place(low[some], high[some])
            key = self.keys.take(at, axis=0)
            there[some] = (key[:, 0] == low[some]) & (key[:, 1] << np.uint64(8) == high[some] << np.uint64(8)) & (low[some] != 0)
            first[some], n[some] = at * WORD_IDS, key[:, 1] >> np.uint64(56)
        return there, first, n

    def keep(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, first: np.ndarray, n: np.ndarray) -> None:
        fit = np.flatnonzero((low != 0) & (n <= WORD_IDS))
        at = self._place(low[fit], high[fit])
        self.last[at] = np.arange(len(at))
        won = self.last[at] == np.arange(len(at))              # of several words for a place one
        at, one = at[won], fit[won]
        n = n[one]
        upto = np.cumsum(n)
        self.keys[at, 0], self.keys[at, 1] = low[one], high[one] | n.astype(np.uint64) << np.uint64(56)
        self.ids[_runs(at * WORD_IDS, n, upto)] = _taken(ids, first[one], n, upto)


class _Encoder:
    """Texts to ids (without the end id): texts of common characters are cut
    into words piecewise, and the words that are new go to the fast byte-pair
    library; the exact pre-tokeniser and automaton take the rest."""

    def __init__(self, path: str):
        import tiktoken

        self.bpe = bpe = load_bpe(path)
        self.size, self.kind = len(bpe.labels), np.uint16 if len(bpe.labels) <= 1 << 16 else np.uint32
        self.special = [x.encode() for x in bpe.special]
        known = sorted(bpe.automaton.known)
        # the words are cut already: this pattern only keeps apart those of one call
        self.fast = tiktoken.Encoding("packing", mergeable_ranks={bpe.labels[i]: i for i in known}, special_tokens={},
                                      pat_str=r" ?[^\x00\t\n\r ]+|[\t\n\r ]+|\x00")
        self.spaced = np.zeros(self.size, dtype=bool)
        self.spaced[[i for i in known if bpe.labels[i].startswith(b" ")]] = True
        self.zero = int(self._ids("\0")[0])
        # bounded caches: words that came more than once in a piece are not pushed out by those met once
        self.words, self.rare = _Table(TABLE_WORDS, self.kind), _Table(RARE_WORDS, self.kind)

    def _ids(self, text: str) -> np.ndarray:
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(self.kind)

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words that are not in the table, where each one's start, and
        their number. Words led by a space are encoded in one call, and so are
        the others with a zero byte before each; white space goes word by word."""
        data, off = text_buffer(words)
        data = np.append(data, np.uint8(0))
        lead, then, n = data[off[:-1]], data[off[:-1] + 1], np.diff(off)
        white = np.frombuffer(_CLASS, dtype=np.uint8) == _WHITE
        led = (lead == 0x20) & (n > 1) & ~white[then]
        own = ~white[lead] & (lead != 0)
        size, flat = np.zeros(len(words), np.int64), []
        for which, ids in ((led, self._ids(_joined(words, led))), (own, self._ids(_joined(words, own, b"\0")))):
            cut = np.flatnonzero(self.spaced[ids] if which is led else ids == self.zero)
            size[which] = np.diff(np.append(cut, len(ids))) - (which is own)
            flat.append(ids if which is led else np.delete(ids, cut))
        rest = np.flatnonzero(white[lead] & ~led)
        flat += [self._ids(words[int(i)].as_py().decode()) for i in rest]
        size[rest] = [len(x) for x in flat[2:]]
        order = np.concatenate([np.flatnonzero(led), np.flatnonzero(own), rest, np.flatnonzero(lead == 0)])
        first = np.empty(len(words), np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate(flat), first, size

    def _common(self, raw: bytes) -> list[np.ndarray]:
        """Ids of texts of common characters, each ended by a zero byte."""
        ended = np.append(0, np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 0) + 1)
        start = np.concatenate([ended[lo] + _starts(raw[ended[lo]:ended[hi]]) for lo, hi in pieces(ended, STEP_BYTES)])
        off = np.append(start, len(raw))
        low, high = _keys(raw, start, np.diff(off))
        there, first, n = self.words.find(low, high)
        flat, new = [self.words.ids], np.flatnonzero(~there & (low != 0) | (np.diff(off) > WORD_BYTES))
        n[~there] = 0                                          # a text's end has no ids
        if len(new):
            words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(raw)])
            words = words.take(pa.array(new)).dictionary_encode()
            found, which = words.dictionary, words.indices.to_numpy()
            one = np.empty(len(found), np.int64)
            one[which] = new
            low, high = low[one], high[one]
            there, begin, size = self.rare.find(low, high)
            upto = np.cumsum(size[there])
            flat.append(_taken(self.rare.ids, begin[there], size[there], upto))
            begin[there] = upto - size[there]
            ids, own, size[~there] = self._learn(found.filter(pa.array(~there)))
            begin[~there] = len(flat[1]) + own
            flat.append(ids)
            first[new], n[new] = len(flat[0]) + begin[which], size[which]
        upto = np.cumsum(n)
        flat = np.concatenate(flat)                            # a copy: words kept now take places that are read here
        ids = _taken(flat, first, n, upto)
        if len(new):
            again = np.bincount(which) > 1
            for table, kept in (self.words, again), (self.rare, ~again & ~there):
                table.keep(low[kept], high[kept], flat, len(self.words.ids) + begin[kept], size[kept])
        ends = np.searchsorted(start, ended[1:] - 1)
        return np.split(ids, upto[ends])[:-1]

    def __call__(self, texts) -> list[np.ndarray]:
        """Ids of every text of a string column (null: none)."""
        data, off = text_buffer(texts)
        out: list = [None] * len(texts)
        for lo, hi in pieces(off, TEXT_BYTES):
            part = data[off[lo]:off[hi]]
            raw = part.tobytes()
            odd = np.flatnonzero(np.frombuffer(raw.translate(_ODD), dtype=bool))
            late = np.flatnonzero(part == 0xC9)            # only the first 16 characters of this block
            odd = np.append(odd, late[part[late + 1] > 0x8F])
            there = np.searchsorted(off, off[lo] + odd, side="right") - 1
            rare = set(there.tolist())
            if any(x in raw for x in self.special):
                rare |= {i for i in range(lo, hi) if any(x in raw[off[i] - off[lo]:off[i + 1] - off[lo]] for x in self.special)}
            for i in rare:
                out[i] = np.asarray(self.bpe.encode(data[off[i]:off[i + 1]].tobytes().decode()), dtype=self.kind)
            easy = [i for i in range(lo, hi) if i not in rare]
            if easy:
                ended = b"".join(y for i in easy for y in (raw[off[i] - off[lo]:off[i + 1] - off[lo]], b"\0"))
                for i, ids in zip(easy, self._common(ended), strict=True):
                    out[i] = ids
        return out


def _encoder(path: str) -> _Encoder:
    """The worker's encoder of a vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


_TOKEN_NAMES = ["doc_id", "n_tokens", "ids", "counts", "row", "name"]


def _tokenise(path, end_id):
    def run(batches):
        encode = _encoder(path)
        end = np.array([end_id], dtype=encode.kind)
        df = np.zeros(encode.size, dtype=np.int64)
        docs = tokens = 0
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                ids, n, names = [], [], []
                bodies = encode(part.column(1))
                for at in range(0, len(bodies), 64):
                    some = bodies[at:at + 64]
                    df += np.bincount(_distinct(np.concatenate(some), np.array([len(x) for x in some]))[1], minlength=len(df))
                for i, body in zip(part.column(0).to_pylist(), bodies):
                    ids.append(np.concatenate([body, end]).tobytes())
                    n.append(len(body) + 1)
                    names.append(int.from_bytes(hashlib.blake2b(ids[-1], digest_size=8, salt=str(i)[-16:].encode())
                                                .digest(), "little", signed=True))
                rows = np.arange(first + docs, first + docs + len(n))
                docs += len(n)
                tokens += sum(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.nulls(len(n), pa.binary()),
                     pa.array(rows, pa.int64()), pa.array(names, pa.int64())], names=_TOKEN_NAMES)
        if docs:                          # the task's document frequencies travel as a last row
            counts = np.concatenate([df, [docs, tokens]]).astype(np.int64).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([counts], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names=_TOKEN_NAMES)
    return run


def tokenise(docs: DataFrame, path: str, id_col="doc_id", text_col="text", end_id: int = END_ID) -> DataFrame:
    """Stored table ``doc_id, n_tokens, ids`` (little-endian unsigned ids with
    the end id), ``row`` (unique) and ``name`` (hash of doc_id and ids), and
    one row per task with its frequencies in ``counts`` and nothing else."""
    return stored(narrow(docs, id_col, text_col).mapInArrow(
        _tokenise(path, end_id), "doc_id long, n_tokens long, ids binary, counts binary, row long, name long"),
        "op7-tokens")


def corpus_counts(tokens: DataFrame) -> dict[int, int]:
    """Documents per token id over the whole corpus, with the totals under the
    pseudo terms: at most one entry per vocabulary entry. A task adds up the
    rows of many token tasks (only this column is read)."""
    def run(batches):
        v = 0
        for batch in batches:
            for raw in batch.column(0):
                v = v + np.frombuffer(raw.as_buffer(), dtype=np.int64)
        if np.ndim(v):
            terms = np.concatenate([np.flatnonzero(v[:-2]), [_TOTAL_DOCS, _TOTAL_TOKENS]])
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(v[terms], pa.int64())], names=["term", "n"])

    some = math.isqrt(shuffle_parts(tokens.sparkSession))
    rows = tokens.where("counts is not null").select("counts").coalesce(some).mapInArrow(run, "term long, n long") \
        .groupBy("term").agg(F.sum("n").alias("n")).collect()          # bounded by the vocabulary
    return {r.term: r.n for r in rows}


def _distinct(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, id and count of every different id of texts of ``n`` ids
    each, in this order."""
    bits = int(ids.max(initial=0)).bit_length()
    kind = np.uint32 if len(n).bit_length() + bits <= 32 else np.int64         # short keys are sorted faster
    key = np.repeat(np.arange(len(n), dtype=kind) << kind(bits), n)
    key |= ids.astype(kind)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key, tf = key[first].astype(np.int64), np.diff(np.append(first, len(key)))
    return key >> bits, key & ((1 << bits) - 1), tf


def weights_of(ids: np.ndarray, n: np.ndarray, idf: np.ndarray, avg_len: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, id and BM25 weight of every different id of texts of ``n``
    ids each. Weights are whole steps of the largest weight an id can have
    (one step at least)."""
    text, terms, tf = _distinct(ids, n)
    norm = (K1 * (1 - B + B * n / max(avg_len, 1e-9)))[text]
    step = max(float(idf.max(initial=0)) * (K1 + 1), 1e-9) / (IMPACTS - 1)
    return text, terms, np.maximum(np.round(idf[terms] * tf * (K1 + 1) / (tf + norm) / step), 1).astype(np.uint16)


def strongest(text: np.ndarray, terms: np.ndarray, weight: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and id of every text's ``most`` ids of the largest weight
    (equal ones: the smaller id first), in the order of ids, and whether an id
    is its text's strongest."""
    assert len(text) == 0 or int(text[-1]) < 1 << 15
    key = np.sort(text << 48 | (0xFFFF - weight.astype(np.int64)) << 32 | terms)
    text = key >> 48
    place = np.arange(len(text)) - np.searchsorted(text, text, side="left")
    text, best, place = text[place < most], key[place < most] & 0xFFFFFFFF, place[place < most]
    order = np.argsort(text << 32 | best)
    return text[order], best[order], place[order] == 0


def _binaries(values: np.ndarray, text: np.ndarray, texts: int) -> pa.Array:
    """Number arrays per text, from those of all texts in order."""
    off = np.searchsorted(text, np.arange(texts + 1)) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(values.tobytes())])


_TERMS = "row long, name long, length long, lead int, terms binary, weights binary, query binary"


def _weighted(idf_raw: bytes, avg_len: float, kind: str, query_terms: int):
    """Id arrays to what the index and the queries need."""
    idf = np.frombuffer(idf_raw, dtype=np.float64)

    def run(batches):
        for batch in batches:
            every, sizes = _flat(batch.column(3), kind)
            off = np.append(0, np.cumsum(sizes))
            for lo, hi in pieces(off, TEXT_IDS):
                n = sizes[lo:hi] - 1                                  # without the end id
                ids = np.delete(every[off[lo]:off[hi]], off[lo + 1:hi + 1] - off[lo] - 1)
                text, terms, weight = weights_of(ids, n, idf, avg_len)
                of, best, first = strongest(text, terms, weight, query_terms)
                lead = np.full(hi - lo, -1, np.int32)
                lead[of[first]] = best[first]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[:3]), pa.array(lead),
                     _binaries(terms.astype(kind), text, hi - lo), _binaries(weight, text, hi - lo),
                     _binaries(best.astype(kind), of, hi - lo)],
                    names=["row", "name", "length", "lead", "terms", "weights", "query"])
    return run


def _flat(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """A column of number arrays as one array, and the arrays' sizes."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(arr):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    off = np.frombuffer(arr.buffers()[1], dtype=np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(arr.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]].view(kind)
    return data, np.diff(off) // np.dtype(kind).itemsize


_LIST = "seed long, row long, length long, score double, tie long"


class _Lane:
    """Seeds with their ``k`` nearest of all entries met so far."""

    def __init__(self, k: int, kind: str, block: int, seeds: pa.Table):
        self.k, self.kind, self.block = k, kind, block
        self.seed, self.name = seeds["seed"].to_numpy(), seeds["name"].to_numpy()
        self.asked, own = _flat(seeds["query"], kind)
        self.upto = np.append(0, np.cumsum(own))
        self.score = np.zeros((len(seeds), k), np.int32)             # nought: no neighbour
        self.tie, self.row, self.length = (np.zeros((len(seeds), k), np.int64) for _ in range(3))

    def meet(self, entries: pa.Table) -> None:
        """Better the lists by a share's entries, through its inverted index."""
        n, k = len(entries), self.k
        row, name, length = (entries[c].to_numpy() for c in ("row", "name", "length"))
        term, size = _flat(entries["terms"], self.kind)
        order = np.argsort(term, kind="stable")
        post_doc = np.repeat(np.arange(n, dtype=np.int32), size)[order]
        post_weight = _flat(entries["weights"], np.uint16)[0][order].astype(np.int32)
        first = np.searchsorted(term[order], np.arange(int(term.max(initial=0)) + 2))
        del term, order
        lo_of, hi_of = (first[np.minimum(self.asked.astype(np.int64) + i, len(first) - 1)] for i in (0, 1))
        whole: dict[int, np.ndarray] = {}                            # lists of frequent ids, as a row of all entries
        step = max(1, min(self.block, CELLS // n))
        room = np.empty((step, n), np.int32)
        for lo in range(0, len(self.seed), step):
            hi = min(lo + step, len(self.seed))
            s = room[:hi - lo]
            s[:] = 0
            for line, a, b in zip(s, self.upto[lo:hi].tolist(), self.upto[lo + 1:hi + 1].tolist()):
                for x, y in zip(lo_of[a:b].tolist(), hi_of[a:b].tolist()):
                    if y - x <= n // WHOLE:
                        line[post_doc[x:y].astype(np.intp)] += post_weight[x:y]     # numpy casts other indices a buffer at a time
                        continue
                    if x not in whole:
                        whole[x] = np.zeros(n, np.int32)
                        whole[x][post_doc[x:y]] = post_weight[x:y]
                    line += whole[x]
            least = np.maximum(self.score[lo:hi, -1], 1)
            if n > k * GROUPS and k <= GROUPS:       # the k-th largest of group maxima is not above the k-th largest
                width = n // GROUPS
                groups = s[:, :GROUPS * width].reshape(-1, GROUPS, width)
                top = np.maximum.reduceat(s[:, :GROUPS * width], np.arange(GROUPS) * width, axis=1)
                least = np.maximum(least, np.partition(top, GROUPS - k, axis=1)[:, GROUPS - k])
                q, g = np.nonzero(top >= least[:, None])     # only these groups hold any, and the few after the last
                of, at = np.nonzero(groups[q, g] >= least[q, None])
                late, after = np.nonzero(s[:, GROUPS * width:] >= least[:, None])
                q, d = np.append(q[of], late), np.append(g[of] * width + at, GROUPS * width + after)
            else:
                q, d = np.divmod(np.flatnonzero(s >= least[:, None]), n)
            if not len(q):
                continue
            old_q, old = np.nonzero(self.score[lo:hi])
            of = np.concatenate([old_q, q])
            x = np.concatenate([self.score[lo + old_q, old], s[q, d]])
            tie = ((name[d].view(np.uint64) - self.name[lo + q].view(np.uint64)) >> np.uint64(1)).astype(np.int64)
            tie, rows, lengths = (np.concatenate([mine[lo + old_q, old], new]) for mine, new in (
                (self.tie, tie), (self.row, row[d]), (self.length, length[d])))
            best = np.lexsort((rows, tie, -x, of))
            of = of[best]
            at = np.arange(len(of)) - np.searchsorted(of, of, side="left")
            kept = at < k
            best, to = best[kept], (lo + of[kept], at[kept])
            self.score[to], self.tie[to], self.row[to], self.length[to] = x[best], tie[best], rows[best], lengths[best]

    def lists(self):
        for lo in range(0, len(self.seed), 4096):
            q, at = np.nonzero(self.score[lo:lo + 4096])
            q += lo
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (self.seed[q], self.row[q, at], self.length[q, at],
                                       self.score[q, at].astype(np.float64), self.tie[q, at])],
                names=["seed", "row", "length", "score", "tie"])


def _cells(k: int, kind: str, share_rows: int, block: int):
    """A cell's seeds, which come first, meet its entries a share at a time."""
    def run(batches):
        cell, seeds, entries, size, lane = None, [], [], 0, None

        def meet():
            nonlocal seeds, entries, size, lane
            if lane is None and seeds:
                lane, seeds = _Lane(k, kind, block, pa.concat_tables(seeds)), []
            if lane is not None and size:
                lane.meet(pa.concat_tables(entries))
            entries, size = [], 0

        for batch in batches:
            at, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(side) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if lo == hi:
                    continue
                if at[lo] != cell:
                    meet()
                    if lane is not None:
                        yield from lane.lists()
                    cell, seeds, lane = at[lo], [], None
                if side[lo] == 0:
                    seeds.append(struct_table(batch.column(2), (lo, hi - lo)))
                    continue
                while lo < hi:
                    here = min(hi - lo, share_rows - size)
                    entries.append(struct_table(batch.column(3), (lo, here)))
                    size, lo = size + here, lo + here
                    if size >= share_rows:
                        meet()
        meet()
        if lane is not None:
            yield from lane.lists()
    return run


def nearest_lists(seeds: DataFrame, others: DataFrame, k: int, kind: str) -> DataFrame:
    """``seed, row, length, score, tie, rank``: for every seed its ``k``
    nearest of all ``others``. The seeds are dealt into lanes, the others into
    ``COLUMNS`` columns, whatever their number; a task holds a lane's seeds
    with their lists and meets a column share by share, so a seed has at most
    ``COLUMNS`` lists of ``k``."""
    spark, n_seeds = seeds.sparkSession, seeds.count()
    lanes = max(1, min(LANES, math.ceil(n_seeds / LEAST_LANE)), math.ceil(n_seeds * k / LANE_PLACES))
    q, e = F.struct(F.col("row").alias("seed"), "name", "query"), F.struct("row", "name", "length", "terms", "weights")
    qtype, etype = seeds.select(q).schema[0].dataType, others.select(e).schema[0].dataType
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    turn = lambda m: F.pmod(F.monotonically_increasing_id(), F.lit(m))
    keys = partition_keys(spark, COLUMNS * lanes)
    cell = key_of((F.col("_c") * F.lit(lanes) + F.col("_l")).cast("int"), keys).alias("_cell")
    sent = seeds.select(turn(lanes).alias("_l"), q.alias("_q")).select("_l", every(COLUMNS).alias("_c"), "_q").select(
        cell, F.lit(0).alias("_side"), "_q", F.lit(None).cast(etype).alias("_e"))
    dealt = others.select(turn(COLUMNS).alias("_c"), e.alias("_e")).select("_c", every(lanes).alias("_l"), "_e").select(
        cell, F.lit(1).alias("_side"), F.lit(None).cast(qtype).alias("_q"), "_e")
    found = (sent.unionByName(dealt).repartition(len(keys), "_cell").sortWithinPartitions("_cell", "_side")
             .mapInArrow(_cells(k, kind, SHARE_ROWS, SEED_BLOCK), _LIST))
    w = Window.partitionBy("seed").orderBy(F.desc("score"), "tie", "row")
    # dealt first: a cell has no more than k rows of a seed, so sorting them to find k would be in vain
    return found.repartition("seed").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def claims(lists: DataFrame, rooms: DataFrame) -> list[DataFrame]:
    """Who gets whom: stored tables of ``seed, row, length, rank, turn``.
    ``rooms``: ``seed, room``, the tokens a seed's window still takes. In a
    turn every seed asks for its nearest open neighbours until they fill its
    room; the best score wins each, and what was asked for is used. A list is
    at most as many turns as it is long."""
    mine = Window.partitionBy("seed").orderBy("rank")
    every = mine.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    length = F.when(F.col("open"), F.col("length"))
    before = F.coalesce(F.sum(length).over(mine.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asks = F.col("open") & (before < F.col("room"))          # stored with the table, so a turn deals its rows by seed once
    names, got = [*lists.columns, "room", "asks"], []
    left = stored(lists.join(rooms, "seed").where("room > 0").withColumn("open", F.lit(True)).withColumn("asks", asks)
                  .select(names), "op7-lists")
    while True:
        best = left.where("asks").groupBy("row").agg(
            F.max(F.struct("score", (-F.col("tie")).alias("t"), "seed")).alias("best")).select("row", F.col("best.seed").alias("winner"))
        turn = stored(left.join(best, "row", "left").withColumn("wins", F.coalesce(F.col("asks") & (F.col("winner") == F.col("seed")), F.lit(False)))
                      .withColumn("room", F.col("room") - F.sum(F.when(F.col("wins"), F.col("length")).otherwise(0)).over(every))
                      .withColumn("open", F.col("winner").isNull() & (F.col("room") > 0)).withColumn("asks", asks), "op7-turn")
        got.append(turn.where("wins").select("seed", "row", "length", "rank", F.lit(len(got)).alias("turn")))
        left = turn.where("open").select(names)
        if left.isEmpty():
            return got


_OUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "ids binary")
_OUT_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def _cut(window: int, kind: str, with_ids: bool):
    """Documents placed at ``at`` in the corpus' order to their pieces."""
    def run(batches):
        for batch in batches:
            every, sizes = _flat(batch.column(2), kind)
            place, off = batch.column(1).to_numpy(), np.append(0, np.cumsum(sizes))
            for lo, hi in pieces(off, TEXT_IDS):
                ids, at, n = every[off[lo]:off[hi]].astype("<u4"), place[lo:hi], sizes[lo:hi]
                upto = np.cumsum((at + n - 1) // window - at // window + 1)
                doc = np.repeat(np.arange(hi - lo), np.diff(upto, prepend=0))
                sequence = at[doc] // window + np.arange(len(doc)) - np.append(0, upto)[doc]
                start = np.maximum(sequence * window - at[doc], 0)
                length = np.minimum((sequence + 1) * window - at[doc], n[doc]) - start
                raw, cut = memoryview(ids).cast("B"), np.append(0, np.cumsum(length)) * ids.itemsize
                crc = [zlib.crc32(raw[a:b]) for a, b in pairwise(cut.tolist())]
                numbers = [start, length, crc, n[doc], sequence, at[doc] + start - sequence * window]
                out = [batch.column(0).take(pa.array(lo + doc)), *(pa.array(x, pa.int64()) for x in numbers)]
                for a in range(0, len(doc), 4096):
                    b = min(a + 4096, len(doc))
                    yield pa.RecordBatch.from_arrays(
                        [*(x.slice(a, b - a) for x in out), pa.Array.from_buffers(
                            pa.binary(), b - a, [None, pa.py_buffer((cut[a:b + 1] - cut[a]).astype(np.int32)),
                                                 pa.py_buffer(raw[cut[a]:cut[b]])]) if with_ids else pa.nulls(b - a, pa.binary())],
                        names=_OUT_NAMES)
    return run


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, with_ids: bool = True, query_terms: int = QUERY_TERMS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, unless ``with_ids`` is false, ``ids`` (the
    piece's ids as little-endian unsigned 32-bit numbers)."""
    tokens = tokenise(docs, path, id_col, text_col, end_id)
    counts = corpus_counts(tokens)
    size = len(load_bpe(path).labels)
    n_docs, n_tokens = max(1, counts.pop(_TOTAL_DOCS, 0)), counts.pop(_TOTAL_TOKENS, 0)
    df = np.zeros(size)
    df[list(counts)] = list(counts.values())
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
    kind, mean = "<u2" if size <= 1 << 16 else "<u4", max(1.0, n_tokens / n_docs)
    texts = tokens.where("counts is null")
    left = stored(texts.select("row", "name", F.col("n_tokens").alias("length"), "ids").mapInArrow(
        _weighted(idf.tobytes(), n_tokens / n_docs, kind, query_terms), _TERMS), "op7-terms")
    share, most = mean / (mean + window / 2), 4 + math.ceil(2 * window / mean)
    bundles, members, turn = [], [], 0
    while not left.isEmpty():
        draw = F.pmod(F.xxhash64("name", F.lit(turn)), F.lit(1 << 20))
        left = left.withColumn("is_seed", draw < F.lit(round((1 - (1 - share) ** (2 ** turn)) * (1 << 20))))
        seeds, others = left.where("is_seed"), left.where(~F.col("is_seed")).drop("is_seed")
        rooms = seeds.select(F.col("row").alias("seed"), F.pmod(-F.col("length"), F.lit(window)).alias("room"))
        won = claims(nearest_lists(seeds, others, most, kind), rooms)
        own = seeds.select(F.col("row").alias("seed"), "row", "length", F.lit(-1).alias("rank"), F.lit(-1).alias("turn"))
        taken = won[0]
        for w in won[1:]:
            taken = taken.unionByName(w)
        members += [own, taken]
        bundles.append(seeds.select(F.col("row").alias("seed"), "lead", "name"))
        left = stored(others.join(taken.select("row"), "row", "left_anti"), "op7-terms")
        turn += 1
    if not members:
        out = texts.select("doc_id", F.lit(0).cast("long").alias("at"), "ids")
    else:
        member, bundle = members[0], bundles[0]
        for m in members[1:]:
            member = member.unionByName(m)
        for b in bundles[1:]:
            bundle = bundle.unionByName(b)
        w = Window.partitionBy("seed").orderBy("turn", "rank")
        placed = stored(member.withColumn("upto", F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                        .select("seed", "row", "upto", (F.col("upto") - F.col("length")).alias("inside")), "op7-members")
        sizes = placed.groupBy("seed").agg(F.max("upto").alias("size")).join(bundle, "seed")
        row = segmented_running_sum(sizes.withColumn("all", F.lit(0)), "all", ["lead", "name", "seed"], "size", "end")
        at = placed.join(row.select("seed", (F.col("end") - F.col("size")).alias("begin")), "seed").select(
            "row", (F.col("begin") + F.col("inside")).alias("at"))
        out = texts.join(at, "row").select("doc_id", "at", "ids")
    out = out.mapInArrow(_cut(window, kind, with_ids), _OUT)
    return out if with_ids else out.drop("ids")
