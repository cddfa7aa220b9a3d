"""SimHash and hard negatives against brute force."""

import math
import random

import xxhash

from qtrlens.llm import hard_negatives as H
from qtrlens.llm import simhash as S
from qtrlens.operators import shares


def reference_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.encode().split() if x]
    grams = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reference_simhash(rows):
    """``(doc_id, fingerprint, component_id)`` by comparing all pairs."""
    fps = [reference_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                comp[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, f"{fps[k]:016x}", least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def signed(v):
    return v - (v >> 63 << 64)


def test_links(spark):
    """Balls around a few centres and random fingerprints; crowded cells split."""
    rnd = random.Random(1)
    vals = {rnd.getrandbits(64) for _ in range(200)}
    for c in (0, (1 << 64) - 1, rnd.getrandbits(64)):
        for _ in range(100):
            v = c
            for _ in range(rnd.randint(0, 3)):
                v ^= 1 << rnd.randrange(64)
            vals.add(v)
    order = sorted(map(signed, vals))
    want = {(a, b) for k, a in enumerate(order) for b in order[k + 1:] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    df = spark.createDataFrame([(v,) for v in order], "fp long")
    for crowd in (S.CROWD, 3):
        assert {(r.a, r.b) for r in S.fingerprint_links(df, crowd).collect()} == want


def plan_of(df):
    """The plan as carried out; ``df`` was collected."""
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_spread_rows_are_not_broadcast(spark):
    """Spark sizes the rows of all cells by the small file of points they come
    from; they are joined without a broadcast."""
    rnd = random.Random(2)
    vals = [rnd.getrandbits(64) for _ in range(300)]
    df = spark.createDataFrame([(signed(v),) for v in [*vals, *(v ^ 1 for v in vals)]], "fp long")
    links = S.fingerprint_links(df)
    assert len({(r.a, r.b) for r in links.collect()}) == 300
    plan = plan_of(links)
    joins = [line for line in plan.splitlines() if "Join" in line and "z#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins), plan


def test_fingerprints_are_not_broadcast(spark, docs):
    """A table with a row per fingerprint meets the texts without a broadcast."""
    found = S.simhash_dedup(docs)
    assert found.collect() and "Broadcast" not in plan_of(found)


def test_documents(spark, docs, rows, no_docs):
    got = S.simhash_dedup(docs).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == reference_simhash(rows)
    assert S.simhash_dedup(no_docs).collect() == []


def test_pieces_of_a_long_text(monkeypatch):
    text = " ".join(random.Random(3).choices([f"W{i}" for i in range(50)], k=500))
    monkeypatch.setattr(S, "HASH_WORDS", 7)
    assert S.fingerprint(text.encode()) == (reference_fingerprint(text), 498)


VECTORS = "vec_id long, label int, embedding array<float>, score double, place int, row string, rank int"


def vectors(seed=4, n=260):
    rnd = random.Random(seed)
    centre = {c: [rnd.uniform(-0.4, 1) for _ in range(20)] for c in range(4)}
    out = []
    for i in range(n):
        c = rnd.randrange(4)
        v = [round((x + rnd.uniform(-0.7, 0.7)) * 4) / 4 for x in centre[c]]        # coarse: many ties
        out.append((i * 10, c, v))
    out += [(10, 1, [1.0] * 20), (2600, 2, [float("nan")] * 20), (2700, 2, [None] + [1.0] * 19), (2800, None, [1.0] * 20),
            (None, 1, [1.0] * 20), (2900, 3, None), (3000, 3, []), (3100, 0, [float("inf")] * 20), (3200, 1, [0.5] * 3),
            (3300, 9, [1.0] * 20), out[7], (400, 2, [-1.0] * 20)]
    return out


def reference_negatives(rows):
    rows = [(i, c, [math.floor(256 * x) for x in v]) for i, c, v in rows if i is not None and c is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, c, v) in enumerate(rows):
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, d) for b, (j, d, w) in enumerate(rows) if b != a)
        for s, j, _ in [r for r in scored if r[2] == c][:5]:
            near = [r for r in scored if r[2] != c and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(i, j, k + 1, r[1], -s, -r[0]) for k, r in enumerate(near)]
    return sorted(out)


COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame([(*r, 1.0, 2, "x", 3) for r in rows], VECTORS).repartition(4)
    want = reference_negatives(rows)
    assert len(want) > 100
    assert sorted(tuple(r[c] for c in COLS) for r in H.hard_negatives(df).collect()) == want
    monkeypatch.setattr(shares, "SHARE_ROWS", 40)      # several shares, several blocks of anchors, short steps
    monkeypatch.setattr(shares, "QUERY_BLOCK", 7)
    assert sorted(tuple(r[c] for c in COLS) for r in H.hard_negatives(df).collect()) == want
    assert H.hard_negatives(df.limit(0)).collect() == []


def test_scores_beyond_doubles(spark):
    """Sums past 2^53 are added up as whole numbers."""
    rows = [(0, 1, [2.0 ** 20, 1.0]), (1, 1, [2.0 ** 20, 3.0]), (2, 2, [2.0 ** 20, 2.0]), (3, 2, [2.0 ** 20, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(tuple(r[c] for c in COLS) for r in H.hard_negatives(df).collect()) == reference_negatives(rows)


def test_bounds_hold():
    import numpy as np
    rng = np.random.default_rng(6)
    v, q = rng.integers(-300, 300, (50, 30)).astype(float), rng.integers(-300, 300, (9, 30)).astype(float)
    for segments in H.LEVELS:
        (vm, vd), (qm, qd) = H.summaries(v, segments), H.summaries(q, segments)
        assert (np.abs(v @ q.T - vm @ qm.T) <= vd @ qd.T + 1e-6).all()
