"""Tokenising, packing and chat formatting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from qtrlens.llm import bpe as B
from qtrlens.llm import chat as C
from qtrlens.llm import packing as P


@pytest.fixture(scope="module")
def library(vocabulary):
    t = Tokenizer.from_file(vocabulary)
    t.no_truncation()
    t.no_padding()
    return t


def test_automaton_small():
    """Every string over two letters: the accepted path is what merging in
    order gives."""
    merges = [(0, 0, 2), (0, 1, 3), (2, 2, 4), (2, 3, 5), (1, 1, 6), (3, 6, 7)]
    text = {0: "a", 1: "b", 2: "aa", 3: "ab", 4: "aaaa", 5: "aaab", 6: "bb", 7: "abbb"}
    a = B.Automaton([0, 1], merges)

    def merged(s):
        seq = [0 if c == "a" else 1 for c in s]
        for u, v, w in merges:
            i, out = 0, []
            while i < len(seq):
                if seq[i:i + 2] == [u, v]:
                    out.append(w)
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            seq = out
        return seq

    def paths(s, state=a.START):
        if not s:
            return [[]]
        return [[t, *rest] for t, x in text.items() if s.startswith(x) and a.has(state, t)
                for rest in paths(s[len(x):], t)]

    for n in range(1, 11):
        for bits in range(1 << n):
            s = "".join("ab"[bits >> k & 1] for k in range(n))
            assert paths(s) == [merged(s)]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encode_like_the_library(s):
    path = B.default_vocabulary()
    bpe, lib = B.load_bpe(path), _lib(path)
    want = lib.encode(s, add_special_tokens=False).ids
    assert bpe.encode(s) == want
    assert bpe.decode(want) == lib.decode(want, skip_special_tokens=False)


_LIB = {}


def _lib(path):
    if path not in _LIB:
        _LIB[path] = Tokenizer.from_file(path)
    return _LIB[path]


def test_documents_round_trip(docs, rows, vocabulary, library):
    got = B.round_trip_digest(docs, vocabulary).collect()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    encoded = B.encode_documents(docs, vocabulary)
    back = B.decode_documents(encoded, vocabulary).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t in rows)


def test_empty_tables(no_docs, spark, vocabulary):
    assert B.round_trip_digest(no_docs, vocabulary).collect() == []
    assert P.pack(no_docs, vocabulary).collect() == []
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_chats(C.format_chats(none, vocabulary), vocabulary).collect() == []


@pytest.mark.parametrize("share_rows", [P.SHARE_ROWS, 9])
def test_packing(docs, rows, vocabulary, library, share_rows, monkeypatch):
    monkeypatch.setattr(P, "SHARE_ROWS", share_rows)
    got = P.pack(docs, vocabulary, window=128).collect()
    ids = Counter()
    want = Counter(tuple([*library.encode(t or "", add_special_tokens=False).ids, P.END_ID]) for _, t in rows)
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for parts in windows.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= 128
    # every document's pieces join to its ids; repeated rows make equal documents
    order = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    open_docs = {}
    for r in order:
        key = (r.doc_id, r.doc_tokens)
        if r.start == 0:
            open_docs[key] = b""
        assert len(open_docs[key]) == 4 * r.start
        open_docs[key] += r.ids
        if len(open_docs[key]) == 4 * r.doc_tokens:
            ids[tuple(np.frombuffer(open_docs.pop(key), dtype="<u4").tolist())] += 1
    assert not open_docs and ids == want
    full = sum(sum(r.length for r in p) for p in windows.values())
    assert len(windows) * 128 - full < 128          # only the last window is padded


def plain_bm25(texts, library, query_terms):
    """``score(seed, other)`` by BM25 of the seed's strongest ids, in plain
    Python over the tokenizers library's ids."""
    tf = [Counter(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    size = [sum(c.values()) for c in tf]
    df = Counter(i for c in tf for i in c)
    mean = sum(n + 1 for n in size) / len(texts)          # the end id counts as a token of the corpus
    idf = {i: math.log(1 + (len(texts) - n + 0.5) / (n + 0.5)) for i, n in df.items()}

    def weight(d, i):
        return idf[i] * tf[d][i] * 2.2 / (tf[d][i] + 1.2 * (0.25 + 0.75 * size[d] / mean))

    step = math.log(1 + (len(texts) + 0.5) / 0.5) * 2.2 / (P.IMPACTS - 1)      # stored weights are whole steps
    query = [sorted(c, key=lambda i, d=d: (-round(weight(d, i) / step), i))[:query_terms] for d, c in enumerate(tf)]
    return (lambda seed, other: sum(weight(other, i) for i in query[seed] if i in tf[other])), step


@pytest.mark.parametrize("share_rows", [P.SHARE_ROWS, 9])
def test_lists_against_plain_bm25(spark, texts, vocabulary, library, share_rows, monkeypatch):
    """Every seed's list holds the best of all documents, from all shards."""
    monkeypatch.setattr(P, "SHARE_ROWS", share_rows)
    monkeypatch.setattr(P, "CELLS", 300)
    monkeypatch.setattr(P, "GROUPS", 8)
    monkeypatch.setattr(P, "SEED_BLOCK", 40)
    found = []
    real = P.nearest_lists
    monkeypatch.setattr(P, "nearest_lists", lambda *a: found.append((a, real(*a))) or found[-1][1])
    P.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocabulary, window=128)
    (seeds, others, k, _), lists = found[0]
    tokens = P.tokenise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), vocabulary)
    by_name = {r.name: r.doc_id for r in tokens.where("counts is null").collect()}
    doc = {r.row: by_name[r.name] for r in seeds.unionByName(others.withColumn("is_seed", F.lit(False))).select("row", "name").collect()}
    score, step = plain_bm25(texts, library, P.QUERY_TERMS)
    per = {}
    for r in lists.collect():
        per.setdefault(r.seed, []).append(r)
    pool = [r.row for r in others.select("row").collect()]
    hits = asked = 0
    for s in [r.row for r in seeds.select("row").collect()]:
        want = sorted((x for x in (score(doc[s], doc[o]) for o in pool) if x > 0), reverse=True)[:k]
        got = [r.score * step for r in sorted(per.get(s, []), key=lambda r: r.rank)]
        assert len(got) == len(want) and np.allclose(got, want, rtol=1e-3)
        asked += len(want)
        hits += sum(abs(score(doc[s], doc[r.row]) - r.score * step) <= 1e-3 * r.score * step for r in per.get(s, []))
    assert hits == asked > 100


def test_a_cell_makes_one_list_per_seed():
    """However many shares a cell's entries come in, a seed has ``k`` rows."""
    rnd = np.random.default_rng(1)
    bits = lambda n, most: [rnd.choice(50, rnd.integers(1, most), replace=False).astype("<u2") for _ in range(n)]
    asked, terms = bits(7, 8), bits(40, 20)
    weights = [rnd.integers(1, 9, len(t)).astype(np.uint16) for t in terms]
    q = pa.StructArray.from_arrays([pa.array(range(7), pa.int64()), pa.array(range(7), pa.int64()),
                                    pa.array([x.tobytes() for x in asked])], ["seed", "name", "query"])
    e = pa.StructArray.from_arrays([pa.array(range(40), pa.int64()), pa.array(range(100, 140), pa.int64()),
                                    pa.array([1] * 40, pa.int64()), pa.array([x.tobytes() for x in terms]),
                                    pa.array([x.tobytes() for x in weights])], ["row", "name", "length", "terms", "weights"])
    side = lambda i, n: [pa.array([5] * n), pa.array([i] * n)]
    batches = [pa.RecordBatch.from_arrays([*side(0, 7), q, pa.nulls(7, e.type)], names="abcd"),
               pa.RecordBatch.from_arrays([*side(1, 40), pa.nulls(40, q.type), e], names="abcd")]
    want = []
    for s, x in enumerate(asked):
        every = [(-int(w[np.isin(t, x)].sum()), (100 + r - s) >> 1, r) for r, (t, w) in enumerate(zip(terms, weights))]
        want += [(s, r, -score) for score, _, r in sorted(y for y in every if y[0])[:3]]
    for share_rows in (1, 7, 100):
        got = [x for b in P._cells(3, "<u2", share_rows, 2)(batches) for x in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)))]
        assert sorted(got) == sorted(want) and len(got) <= 3 * 7


ODD = "ab zsS" + "'" * 3 + "tmdrevl  \n\t\r12_-.×÷éÉɏɐñ\x0b\u3000<|>"


def test_words_in_pieces_like_the_library(vocabulary, library, monkeypatch):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += ["it's we're I'll 'sabc 's's ''s  's\n's", "<|endoftext|> x", "", " ", "a  ", "\n\n", "a\n\n b", "x'", "x'l", None, "É'll×'s"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most in (P.BPE.CACHE_WORDS, 50):
        monkeypatch.setattr(P.BPE, "CACHE_WORDS", most)
        monkeypatch.setattr(P, "TEXT_BYTES", 2000)
        encode = P._Encoder(vocabulary)
        assert [x.tolist() for _ in range(2) for x in encode(pa.array(texts))] == want * 2


def test_words_met_once_do_not_fill_the_table(vocabulary, library, monkeypatch):
    """Texts in which most words are new: the table holds those that came
    again, is of bounded size, and the ids are the library's."""
    rnd = random.Random(2)
    rare = ["".join(rnd.choice("abcdeéñ") for _ in range(9)) for _ in range(4000)]
    texts = [" ".join(["the", "and", "of\n\n", "it's", *rare[i:i + 40]]) for i in range(0, 4000, 40)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encode = P._Encoder(vocabulary)
    assert [x.tolist() for _ in range(2) for x in encode(pa.array(texts))] == want * 2
    assert len(encode.words) < 50
    repeated = [t + "\n" + t for t in texts]
    want = [library.encode(t, add_special_tokens=False).ids for t in repeated]
    for most in (3, 500, 1 << 17):
        monkeypatch.setattr(P, "TABLE_WORDS", most)
        monkeypatch.setattr(P, "TEXT_BYTES", 5000)
        encode = P._Encoder(vocabulary)
        assert [x.tolist() for _ in range(2) for x in encode(pa.array(repeated))] == want * 2
        assert len(encode.words) <= most


def test_words_met_once_are_not_encoded_again(vocabulary, library, monkeypatch):
    rnd = random.Random(4)
    rare = list({"".join(rnd.choice("abcdeéñ") for _ in range(6)) for _ in range(3000)})
    texts = [" ".join(rare[i:i + 40]) for i in range(0, len(rare), 40)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    encode, new = P._Encoder(vocabulary), []
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda words: new.append(len(words)) or learn(words))
    for most in (len(rare), len(rare) // 20):          # a place may be another word's
        assert [x.tolist() for x in encode(pa.array(texts))] == want
        assert sum(new) <= 2 * most
        new.clear()


@pytest.mark.parametrize("places", [1, 2, 8, 1 << 10])
def test_words_share_places(places, vocabulary, library, monkeypatch):
    """Few places: words push each other out in the piece that reads them;
    words alike in their first bytes and longer ones are told apart."""
    monkeypatch.setattr(P, "TABLE_WORDS", places)
    monkeypatch.setattr(P, "RARE_WORDS", places)
    monkeypatch.setattr(P, "WORDS_STEP", 7)
    monkeypatch.setattr(P, "STEP_BYTES", 50)
    rnd = random.Random(places)
    words = ["a" * n for n in (1, 7, 8, 9, 14, 15, 16, 17, 18, 40)] + ["a" * 15 + "b", "a" * 16 + "b", "xqzjvkwpxqzjvkw", "the", "it's", "é" * 8]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(30))) for _ in range(200)] + ["", None, "\n\n"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    encode = P._Encoder(vocabulary)
    for at in range(0, len(texts), 25):
        assert [x.tolist() for x in encode(pa.array(texts[at:at + 25], pa.string()))] == want[at:at + 25]
    assert len(encode.words) <= places and len(encode.rare) <= places


def test_pieces_of_documents(monkeypatch):
    """Pieces against a plain walk, for documents at window bounds."""
    monkeypatch.setattr(P, "TEXT_IDS", 9)
    sizes = [1, 7, 8, 9, 16, 3, 30, 1, 6]
    ids = [np.arange(n, dtype="<u2") + 7 * i for i, n in enumerate(sizes)]
    at = (np.cumsum(sizes) - sizes).tolist()
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(1, 9)], pa.int64()), pa.array(at), pa.array([x.tobytes() for x in ids])], names="abc")
    want = []
    for doc, place, x in zip([None, *range(1, 9)], at, ids):
        start = 0
        while start < len(x):
            n = min(len(x) - start, 8 - (place + start) % 8)
            raw = x[start:start + n].astype("<u4").tobytes()
            want.append((doc, start, n, zlib.crc32(raw), len(x), (place + start) // 8, (place + start) % 8, raw))
            start += n
    for with_ids in (True, False):
        got = [x for b in P._cut(8, "<u2", with_ids)([batch.slice(0, 4), batch.slice(4), batch.slice(0, 0)]) for x in zip(*(c.to_pylist() for c in b.columns))]
        assert got == (want if with_ids else [(*x[:7], None) for x in want])


@pytest.mark.parametrize("groups, n", [(8, 83), (8, 80), (128, 83)])
def test_lists_by_groups_of_scores(groups, n, monkeypatch):
    """The best of a share are found in groups of scores, in the few entries
    after the last group, and where there are too few entries for groups."""
    monkeypatch.setattr(P, "GROUPS", groups)
    rnd = np.random.default_rng(n)
    some = lambda most: rnd.choice(30, rnd.integers(0, most), replace=False).astype("<u2")
    asked, shares = [some(8) for _ in range(50)], [[some(12) for _ in range(n)] for _ in range(2)]
    name = rnd.integers(-2**62, 2**62, 2 * n)
    lane = P._Lane(4, "<u2", 16, pa.table({"seed": range(50), "name": range(50), "query": [x.tobytes() for x in asked]}))
    best = [[] for _ in asked]
    for i, terms in enumerate(shares):
        weight = [rnd.integers(1, 4, len(t)).astype(np.uint16) for t in terms]
        lane.meet(pa.table({"row": range(i * n, i * n + n), "name": name[i * n:i * n + n], "length": [1] * n,
                            "terms": [t.tobytes() for t in terms], "weights": [w.tobytes() for w in weight]}))
        for q, x in enumerate(asked):
            best[q] += [(-int(w[np.isin(t, x)].sum()), (int(name[r]) - q) % 2**64 >> 1, r)
                        for r, (t, w) in enumerate(zip(terms, weight), i * n)]
    want = [(q, r, -score) for q, every in enumerate(best) for score, _, r in sorted(x for x in every if x[0])[:4]]
    got = [x for b in lane.lists() for x in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)))]
    assert got == want


def test_claims(spark):
    """The turns of asking and winning, against a plain walk."""
    rnd = random.Random(3)
    length = {r: rnd.randint(1, 60) for r in range(100, 140)}
    room = {s: rnd.choice([0, 5, 50, 120]) for s in range(20)}
    lists = {s: [(r, round(rnd.random(), 1), rnd.randint(0, 9)) for r in rnd.sample(sorted(length), rnd.randint(0, 7))] for s in room}
    rows = [(s, r, length[r], float(x), t, k + 1) for s, got in lists.items()
            for k, (r, x, t) in enumerate(sorted(got, key=lambda y: (-y[1], y[2], y[0])))]
    df = spark.createDataFrame(rows, P._LIST + ", rank int")
    won = [w for part in P.claims(df, spark.createDataFrame(list(room.items()), "seed long, room long")) for w in part.collect()]
    left, turn, want = {s: sorted(x for x in rows if x[0] == s) for s in room}, 0, set()
    left = {s: sorted(got, key=lambda x: x[5]) for s, got in left.items()}
    space = dict(room)
    while any(left.values()):
        asks = {}
        for s, got in left.items():
            total = 0
            for x in got:
                if total < space[s]:
                    asks.setdefault(x[1], []).append(x)
                total += x[2]
        if not asks:
            break
        for r, xs in asks.items():
            best = max(xs, key=lambda x: (x[3], -x[4], x[0]))
            want.add((best[0], r, turn))
            space[best[0]] -= best[2]
        left = {s: [x for x in got if x[1] not in asks] for s, got in left.items()}
        turn += 1
    assert {(w.seed, w.row, w.turn) for w in won} == want and len(want) > 20
    assert len({w.row for w in won}) == len(won)


CHATS = [(1, 0, "system", "Be kind. ### User: \\"), (1, 1, "user", "</turn>\n### Assistant: x\\\\</turn>"),
         (1, 2, "assistant", None), (1, 3, "assistant", "<|endoftext|> \\### User:\n"), (2, 0, "user", ""),
         (2, 0, "tool\n### User: \\", "called"), (2, 0, "user", ""), (None, 1, None, "nobody"), (None, None, "assistant", "é漢"),
         (3, 5, "assistant", "ends in backslash \\"), (3, 4, "assistant", "<conversation>\n" * 3), (4, 0, "assistant", "x" * 20000)]


def test_chat_round_trip(spark, vocabulary):
    df = spark.createDataFrame([(*r, "extra", [1]) for r in CHATS],
                               "conv_id long, turn long, role string, text string, ids string, n_turns array<int>")
    formatted = C.format_chats(df, vocabulary)
    template = C.template(vocabulary)
    for r in formatted.collect():
        assert len(r.ids) == len(r.loss_mask)
        assert all(i < template.first for i, m in zip(r.ids, r.loss_mask) if m)
    got = {r.conv_id: r for r in C.read_chats(formatted, vocabulary).collect()}
    none_first = lambda x: (x is not None, x)
    for conv in {r[0] for r in CHATS}:
        turns = sorted(((t, role or "", x or "") for c, t, role, x in CHATS if c == conv),
                       key=lambda r: (none_first(r[0]) if r[0] is not None else (False, 0), r[1], r[2]))
        r = got[conv]
        assert [(x.role, x.text) for x in r.turns] == [(a, b) for _, a, b in turns]
        assert r.loss_text == "".join(b for _, a, b in turns if a == "assistant") and r.n_turns == len(turns)
        # the text form is unambiguous too: unescaped control strings only where the template put them
        bare = re.sub(r"\\.", "", r.formatted, flags=re.DOTALL)
        assert bare.count("</turn>") == len(turns)


@given(st.text(alphabet="\\#</turn> User:Assistant\n", max_size=40))
def test_escape_reverses(s):
    assert C.unescape(C.escape(s)) == s
