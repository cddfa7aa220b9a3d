"""Byte-pair encoding and decoding with a tokenization automaton.

The merges are compiled into a deterministic automaton over tokens. It starts
as one state with an arc to itself for every byte. The gadget of merge
``u v -> w`` then gives every state that can read ``u`` and then ``v`` an arc
``w`` to where ``v`` led, and sends ``u`` to a copy of its target that lacks
``v``. After the last gadget a token sequence is accepted exactly when it is
the sequence that applying the merges in order would give, so of all ways to
cut a word into tokens one path is accepted. States are kept as differences
to the state they were copied from; an arc is worked out from that history
once and then held in the transition table.

Encoding reads a word left to right over a trie of the vocabulary: every
prefix of a word has one accepted path, so one table entry per position is
enough. Decoding concatenates the arc labels (the tokens' bytes).

Words come from the pre-tokeniser's pattern; their ids are cached per worker
in a table of bounded size (a cache: what falls out is encoded again).
"""

from __future__ import annotations

import json
import re
from itertools import chain

from pyspark.sql import SparkSession
from tokenizers.pre_tokenizers import ByteLevel

# ---- fixed values: the pattern of byte-level BPE pre-tokenisers, in the
# standard library's classes. They mean the same for the characters that
# _NOT_SIMPLE leaves; texts with others go to the pre-tokeniser itself.
_FAST = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_NOT_SIMPLE = re.compile("[^\\t\\n\\r\\x20-\\x7eÀ-ɏ]")
CACHE_WORDS = 400_000
LONG_WORD = 64


def byte_chars() -> list[str]:
    """Printable character standing for each byte: the byte's own where it is
    visible, else the next free code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(free)
            free += 1
    return out


class Automaton:
    """The automaton of ``merges``: (left, right, merged) ids in order, over
    byte tokens ``byte_ids``.

    All arcs of a token lead to one state, so a state is named by the token
    read last (START before the first). Its arcs are kept as their history:
    ``split[u, v]`` is the gadget that took arc ``v`` from the state after
    ``u``; ``made[w]`` the one that added ``w`` wherever its left part could
    be read, with ``w``'s own state a copy of its right part's."""

    START = -1

    def __init__(self, byte_ids: list[int], merges: list[tuple[int, int, int]]):
        self.known = set(byte_ids)
        self.split: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        self.arcs: dict[tuple[int, int], bool] = {}      # the transition table, filled as used
        for number, (u, v, w) in enumerate(merges):
            self._gadget(2 * number, u, v, w)

    def _gadget(self, number: int, u: int, v: int, w: int) -> None:
        if u in self.known and v in self.known and w not in self.known and self._reads(u, v, number):
            self.known.add(w)
            self.split[u, v] = number
            self.made[w] = (number, u, v)

    def _reads(self, state: int, token: int, before: int) -> bool:
        """Could ``token`` be read in ``state`` before gadget ``before``?
        Follows the history of both back to the bytes."""
        made, split = self.made, self.split
        while True:
            cut = split.get((state, token))
            if cut is not None and cut < before:
                return False
            a, b = made.get(state), made.get(token)
            if b is not None and (a is None or b[0] >= a[0]):
                before, token = b[0] + 1, b[1]           # added because the left part could be read
            elif a is not None:
                before, state = a[0], a[2]               # copied from the right part's state
            else:
                return True

    def has(self, state: int, token: int) -> bool:
        """Is there an arc ``token`` from ``state``?"""
        key = (state, token)
        out = self.arcs.get(key)
        if out is None:
            out = self.arcs[key] = state == self.START or self._reads(state, token, 1 << 62)
        return out


class Bpe:
    """Encoder and decoder of a byte-level BPE file of the tokenizers format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        chars = byte_chars()
        byte_of = {c: b for b, c in enumerate(chars)}
        merges = []
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            merges.append((vocab[a], vocab[b], vocab[a + b]))
        self.automaton = Automaton([vocab[c] for c in chars], merges)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        top = max([*vocab.values(), *self.special.values()]) + 1
        self.labels: list[bytes] = [b""] * top
        for s, i in vocab.items():
            self.labels[i] = bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()
        for s, i in self.special.items():
            self.labels[i] = s.encode()
        self.decimal = [str(i) for i in range(top)]
        self.trie: dict = {}
        reach = self.automaton.known       # tokens some path can read
        for s, i in vocab.items():
            if i in reach:
                node = self.trie
                for b in self.labels[i]:
                    node = node.setdefault(b, {})
                node[-1] = i
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pre = ByteLevel(add_prefix_space=False, use_regex=True)
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    # ------------------------------------------------------------- encoding
    def _tokens_at(self, word: bytes, at: int) -> list[int]:
        """Tokens that the word goes on with at a position, shortest first."""
        node, out = self.trie, []
        for j in range(at, len(word)):
            node = node.get(word[j])
            if node is None:
                break
            token = node.get(-1)
            if token is not None:
                out.append(token)
        return out

    def word_ids(self, word: bytes) -> tuple[int, ...]:
        """Labels of the one accepted path over ``word``.

        Longer arcs are tried first. A prefix has one accepted path only, so
        a position from which the end was not reached is never tried again
        and the work is linear in the word."""
        n, labels, has = len(word), self.labels, self.automaton.has
        dead: set[int] = set()
        path: list[int] = []
        ends = [0]
        left = [self._tokens_at(word, 0)]
        while ends[-1] < n:
            at, choices = ends[-1], left[-1]
            state = path[-1] if path else Automaton.START
            while choices:
                token = choices.pop()
                to = at + len(labels[token])
                if to not in dead and has(state, token):
                    path.append(token)
                    ends.append(to)
                    left.append(self._tokens_at(word, to) if to < n else [])
                    break
            else:
                dead.add(at)
                path.pop()
                ends.pop()
                left.pop()
        return tuple(path)

    def _missing(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            ids = self.word_ids(word.encode("utf-8", "surrogatepass"))
        if len(word) <= LONG_WORD:
            if len(self.cache) >= CACHE_WORDS // 2:      # the older half goes
                self.older, self.cache = self.cache, {}
            self.cache[word] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        if _NOT_SIMPLE.search(text):         # other scripts: the library's own character classes
            found = [text[a:b] for _, (a, b) in self.pre.pre_tokenize_str(text)]
        else:
            found = _FAST.findall(text)
        get, missing = self.cache.get, self._missing     # a cache swapped meanwhile is still right
        return list(chain.from_iterable([get(w) or missing(w) for w in found]))

    def encode(self, text: str, special: bool = True) -> list[int]:
        """Ids of a text; strings of special tokens become those tokens
        unless ``special`` is false."""
        if not text:
            return []
        if special and self.split and any(s in text for s in self.special):
            out: list[int] = []
            for part in self.split.split(text):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self._plain(part)
            return out
        return self._plain(text)

    # ------------------------------------------------------------- decoding
    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def load_bpe(path: str) -> Bpe:
    """The encoder for ``path``, built once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def default_vocabulary() -> str:
    """Path of the 50k byte-level vocabulary of the ``public_tokenizers``
    package (the file is read there, on driver and executors alike)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """One row per document: ``doc_id, n_tokens, ids`` (array of ids).

    Null and empty texts give no ids; null ids and repeated rows are encoded
    like any other; other columns are not looked at."""
    import pyarrow as pa

    from qtrlens.llm.common import narrow

    def run(batches):
        bpe = load_bpe(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(map(len, ids)), pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                    names=["doc_id", "n_tokens", "ids"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decode_documents(encoded, path: str, id_col: str = "doc_id", ids_col: str = "ids"):
    """``doc_id, text`` from rows of ids (null ids give an empty text)."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    def run(batches):
        bpe = load_bpe(path)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([bpe.decode(i or ()) for i in part.column(1).to_pylist()], pa.string())],
                    names=["doc_id", "text"])

    return encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids")) \
        .mapInArrow(run, "doc_id long, text string")


def round_trip_digest(docs, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """Encode, decode and digest in one pass over the texts: ``doc_id,
    n_tokens, ids_sha256, decoded_sha256`` without carrying ids between
    tasks. Defined results as ``encode_documents``."""
    import hashlib

    import pyarrow as pa

    from qtrlens.llm.common import narrow

    def run(batches):
        bpe = load_bpe(path)
        decimal = bpe.decimal.__getitem__
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                n, coded, decoded = [], [], []
                for t in part.column(1):
                    ids = bpe.encode(t.as_py() or "")
                    n.append(len(ids))
                    coded.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrow(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def session_vocabulary(spark: SparkSession) -> str:
    """Vocabulary path of this session (``qtrlens.bpe.path`` if set)."""
    return spark.conf.get("qtrlens.bpe.path", None) or default_vocabulary()
