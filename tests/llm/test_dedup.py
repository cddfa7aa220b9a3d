"""Exact, substring and near deduplication against brute force."""

import hashlib
import re
from collections import Counter

import pytest

from qtrlens.llm import exact_dedup as EX
from qtrlens.llm import near_dedup as ND
from qtrlens.llm import substring_dedup as SD
from qtrlens.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_truth(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((len(t or ""), i))
    out = Counter()
    for text, members in groups.items():
        best = max(members, key=lambda m: (m[0], m[1] is not None, -(m[1] or 0)))
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for n, i in sorted(members, key=lambda m: m != best):
            out[(i, best[1], len(members), left == 1, sha)] += 1
            left = 0
    return out


@pytest.mark.parametrize("primes", [EX.PRIMES, (3, 5)])
def test_exact_dedup(docs, rows, primes):
    """With tiny primes most fingerprints of equal length collide and the
    chunks must tell the texts apart."""
    got = EX.exact_dedup(docs, chunk_bytes=64 if primes[0] == 3 else EX.CHUNK_BYTES, primes=primes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == exact_truth(rows)


def test_exact_dedup_empty(no_docs):
    assert EX.exact_dedup(no_docs).collect() == []


def test_fingerprints_compose():
    import numpy as np
    text = np.frombuffer(b"some bytes to be hashed in parts" * 9, dtype=np.uint8)
    for size in (7, 64, 4096):
        tables = EX._power_table(size, EX.PRIMES)
        for k, p in enumerate(EX.PRIMES):
            h = 0
            for at in range(0, len(text), size):
                part = text[at:at + size]
                h = EX.combine(h, EX.chunk_hash(part, tables[k], p), len(part), k, p)
            whole = sum((int(b) + 1) * pow(EX.BASES[k], len(text) - 1 - i, p) for i, b in enumerate(text)) % p
            assert h == whole


def substring_truth(rows, window):
    first = {}
    for i, t in rows:
        if i is None:
            continue
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, i), i)
    out = Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k:k + window])] < i:
                    gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,block", [(50, 25), (9, 5)])
def test_substring_dedup(docs, rows, window, block):
    got = SD.substring_dedup(docs, window=window, block=block, with_text=True, carry=["n_chars", "odd name"]).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == substring_truth(rows, window)
    assert sum(r.n_removed for r in got) > 0
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
        assert hashlib.sha256(" ".join(WORD.findall(r.kept_text)).encode()).hexdigest() == r.kept_sha256
        assert r.carried["odd name"] == "q"
    texts = Counter(rows)
    assert all((r.doc_id, r.kept_text) in texts or r.kept_text == "" for r in got if not r.n_removed)


def test_substring_dedup_empty(no_docs):
    assert SD.substring_dedup(no_docs).collect() == []


def test_block_must_fit_the_window(docs):
    with pytest.raises(ValueError):
        SD.substring_dedup(docs, window=50, block=26)


def near_truth(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        s = frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else \
            frozenset([tuple(w)] if w else [])
        if i is not None:
            sets[i] = s
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("width,node", [(4, 64), (5, 64), (4, 2)])
def test_near_dedup(docs, rows, width, node):
    """Also with leaves of two, so that all branching and the large-leaf
    comparison are used."""
    got = ND.near_dedup(docs, shingle=width, node_size=node).collect()
    assert len(got) == len(rows)
    truth = near_truth(rows, width, 80)
    assert len({v[1] for v in truth.values()}) < len(truth) - 10
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == truth[r.doc_id]


def test_near_dedup_empty(no_docs):
    assert ND.near_dedup(no_docs).collect() == []


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (20, 9), (7, 7)] + [(100 + k, 101 + k) for k in range(40)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in (1, 2, 3, 4, 5)} == {1} and {got[i] for i in (8, 9, 20)} == {8}
    assert {got[i] for i in range(100, 141)} == {100}
