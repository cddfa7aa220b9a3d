"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re

import numpy as np
import pytest

from qtrlens.llm import periodic as P
from qtrlens.llm.common import U, mix64
from qtrlens.llm.queries import plant_period


def brute(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            a, b = i, j + q
            if j > i and b - a >= max(6, 4 * q) and not any(
                    all(w[k] == w[k + p] for k in range(a, b - p)) for p in range(1, q)):
                out.append((a, b - a, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rnd):
    n, v = rnd.choice([0, 1, 3, 5, 6, 7, 8, 20, 50, 100, 200]), rnd.choice([1, 2, 3, 50])
    w = [rnd.randrange(v) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n >= 8:
            a = rnd.randrange(n)
            p = 1 + rnd.randrange(max(1, (n - a) // 3))
            for i in range(a, a + rnd.randint(0, n - a)):
                w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("top", [P.TOP, 4])        # 4: scales whose blocks are known by their first words
def test_find_runs(monkeypatch, top):
    monkeypatch.setattr(P, "TOP", top)
    rnd = random.Random(3)
    for _ in range(60):
        texts = [periodic_words(rnd) for _ in range(rnd.randint(1, 12))]
        h = mix64(np.array([x + 1000 for t in texts for x in t], dtype=U) * U(0x9E3779B97F4A7C15))
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        assert P.find_runs(h, off) == [(i, *r) for i, t in enumerate(texts) for r in brute(t)]


def test_convolution_is_exact():
    """Every place of every block against direct comparison, at each size."""
    rng = np.random.default_rng(5)
    for block in (1, 2, 8, 64):
        s = np.concatenate([P.symbols(rng.integers(0, 2, 10 * block).astype(U), block), np.zeros(2 * block, np.int64)])
        p, d = P.zero_distances(s, block)
        want = {(j, j + t) for j in range(0, 10 * block, block) for t in range(block, 2 * block)
                if (s[j:j + block] == s[j + t:j + t + block]).all()}
        assert {(a, a + b) for a, b in zip(p.tolist(), d.tolist())} == want
    full = np.full(3 * P.TOP, 1)                    # the largest sum there is
    assert len(P.zero_distances(full, P.TOP)[0]) == P.TOP


def test_documents(spark, docs, rows, no_docs):
    got = P.periodic_runs(docs, with_text=True, prepare=plant_period).collect()
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", plant_period(i, t) or "")
        runs = brute(w) if len(w) < 3000 else None
        want.append((i, w, runs))
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.n_words), []).append(r)
    assert len(got) == len(rows)
    for i, w, runs in want:
        for r in by[i, len(w)]:
            found = [(x.start, x.length, x.period) for x in r.runs]
            if runs is not None and (i is not None or len(by[i, len(w)]) == 1):
                assert found == runs
            gone = {k for a, n, q in found for k in range(a + q, a + n)}
            if i is not None:
                assert r.collapsed == " ".join(x for k, x in enumerate(w) if k not in gone)
            assert r.collapsed_sha256 == hashlib.sha256(r.collapsed.encode()).hexdigest()
    assert any(runs for _, _, runs in want)
    assert P.periodic_runs(no_docs).collect() == []


def test_one_long_periodic_text(spark):
    rnd = random.Random(2)
    cycle = [f"w{rnd.randrange(900)}" for _ in range(701)]
    text = "start " + " ".join(cycle * 30) + " " + "x " * 5000
    r = P.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"), with_text=True).first()
    assert [(x.start, x.length, x.period) for x in r.runs] == [(1, 701 * 30, 701), (1 + 701 * 30, 5000, 1)]
    assert r.collapsed == "start " + " ".join(cycle) + " x"
