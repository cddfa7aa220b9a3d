"""Resharding, WARC, URL rules, quality rules and the pipeline."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from qtrlens.llm import queries as Q
from qtrlens.llm import quality as QR
from qtrlens.llm import resharding as RS
from qtrlens.llm import substring_dedup as SD
from qtrlens.llm import url_filter as UF
from qtrlens.llm import warc as W
from qtrlens.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- resharding
def test_min_cost_flow():
    flow = RS.min_cost_flow([10, 0, 5], [5, 5, 5], lambda i, j: int(i != j))
    assert flow == {(0, 0): 5, (0, 1): 5, (2, 2): 5}
    flow = RS.min_cost_flow([6, 6], [4, 4, 4], lambda i, j: [[0, 5, 1], [2, 0, 9]][i][j])
    assert sum(flow.values()) == 12 and flow == {(0, 0): 2, (0, 2): 4, (1, 0): 2, (1, 1): 4}
    with pytest.raises(ValueError):
        RS.min_cost_flow([3], [2], lambda i, j: 0)


def test_resharding(spark, docs, rows):
    old = F.when(F.col("doc_id") % 3 == 0, F.lit(2)).otherwise(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)))
    out = RS.resharded(spark, docs, old, shards=4, blocks_per_shard=64).collect()
    assert Counter((r["row"].doc_id, r["row"].text) for r in out) == Counter(rows)
    assert all(r["row"]["odd name"] == "q" for r in out)
    size, slots = defaultdict(int), defaultdict(list)
    for r in out:
        assert r.size == len((r["row"].text or "").encode()) + 1
        size[r["shard"]] += r.size
        slots[r["shard"]].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    total = sum(size.values())
    biggest = max(r.size for r in out)
    assert all(size[s] <= max(total / 4 * 1.1, biggest) for s in range(4))
    # fewest bytes: no more is moved than the old shards hold too much
    before = defaultdict(int)
    for r in out:
        before[r.old_shard] += r.size
    moved = sum(r.size for r in out if r.old_shard != r["shard"])
    least = sum(max(0, before[s] - size[s]) for s in range(4))
    assert moved == least


def test_untouched_shards_keep_their_files(spark):
    df = spark.createDataFrame([(i, "x" * 9) for i in range(40)], "doc_id long, text string")
    old = (F.col("doc_id") % 4).cast("int")
    path = scratch_path(spark, "t-none")
    assert RS.rewrite_affected(RS.assign(df, old, shards=4), path) == []
    assert RS.resharded(spark, df, old, shards=4).count() == 40
    assert RS.reshard(df.limit(0), F.lit(0), shards=4).collect() == []
    # two shards exchange nothing with the other two
    skew = F.when(F.col("doc_id") < 15, F.lit(0)).when(F.col("doc_id") < 20, F.lit(1)).otherwise(F.lit(2) + F.col("doc_id") % 2)
    assigned = RS.assign(df, skew.cast("int"), shards=4)
    assert RS.rewrite_affected(assigned, path) == [0, 1]
    out = RS.resharded(spark, df, skew.cast("int"), shards=4).collect()
    assert sorted(r["row"].doc_id for r in out) == list(range(40))
    assert all(r["shard"] == r.old_shard for r in out if r.old_shard > 1)


# ---------------------------------------------------------------------- WARC
PAGES = [(1, "http://a/1", "x" * 1500), (2, None, "x" * 1500), (3, "http://a/ 3\n", "é" * 600), (7, "u", "é" * 600),
         (5, "u", "short"), (6, "u", "short"), (8, "u", None), (None, "u", "x" * 1500), (9, "u", "x" * 1500),
         (9, "u", "x" * 1500), (10, "u", "WARC/1.0\r\n\r\n" * 100)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*p, "z", b"q") for p in PAGES],
                               "page_id long, url string, html string, payload string, digest binary")
    path = scratch_path(spark, "t-warc")
    W.write_archive(df, path)
    got = W.read_archive(spark, path).collect()
    best = {}
    for i, _, h in PAGES:
        raw = (h or "").encode()
        if len(raw) >= 1000 and i is not None:
            best[raw] = max(best.get(raw, i), i)
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = i is not None and len(raw) >= 1000 and i < best[raw]
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best[raw] if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {r.page_id: r.payload for r in got}[10] == PAGES[-1][2].encode()
    assert {r.url for r in got if r.page_id == 3} == {"http://a/%203%0A"}
    empty = scratch_path(spark, "t-warc0")
    W.write_archive(df.limit(0), empty)
    assert W.read_archive(spark, empty).collect() == []


@pytest.mark.parametrize("split", ["97", "1000", "128m"])
def test_warc_ranges_with_false_magic(spark, tmp_path, split):
    """Stored (uncompressed) members whose payloads contain the gzip magic,
    read in ranges of a few bytes: every record exactly once."""
    def stored_member(data):
        c = zlib.compressobj(0, zlib.DEFLATED, 31)
        return c.compress(data) + c.flush()
    path = tmp_path / "a"
    path.mkdir()
    want = {}
    for f in range(2):
        out = b""
        for k in range(12):
            i = 100 * f + k
            payload = (b"%d" % i + b"\x1f\x8b\x08" * (k % 4) + b"\x1f\x8b\x08\x00junk" * (k % 3) + b"y" * (37 * k)) * 2
            want[i] = payload
            member = stored_member(W.record_bytes(i, None, payload, None))
            out += member if k % 2 else gzip.compress(W.record_bytes(i, None, payload, None))
        (path / f"part-{f}").write_bytes(out)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = W.read_archive(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert Counter((r.page_id, bytes(r.payload)) for r in got) == Counter(want.items())


# ---------------------------------------------------------------------- URLs
def test_url_rules(spark):
    urls = ["http://EXAMPLE.org/es/1", "https://a.b.example.org/en/17?x", "http://example.org/en/27", "x.org/y", None, "",
            "ftp://x.org", "http://x.org/", "http://notcom/fr/", "http://m.com/fr/9#/de/", "http://m.com/de/", "://com/de/",
            "http://ÀB.com/de/x", "http://a.com?/de/", "http://com/de/", "a://b://com/de/", "http://.org/x", "http://x.org./"]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(None, "http://com/de/1", "r"), (3, "x.org/y", "r")],
                               "page_id long, url string, rule string")

    def judge(u):
        rest = (u or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(len(r), r, a) for a, r in Q.URL_RULES
                if (host == UF.split_rule(r)[0] or host.endswith("." + UF.split_rule(r)[0]))
                and path.startswith(UF.split_rule(r)[1])]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        return host, path, rule, verdict

    got = UF.filter_urls(df, Q.URL_RULES).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter(
        (r.page_id, *judge(r.url)) for r in df.collect())
    assert {r.rule for r in got} >= {None, "org/", "com/de/", "com/fr/", "example.org/es/", "example.org/en/1"}
    assert UF.filter_urls(df.limit(0), Q.URL_RULES).collect() == []
    assert {r.verdict for r in UF.filter_urls(df, []).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    keys = [f"k{i}" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    listed = keys[::7]
    c = UF.build_cascade(universe, listed, bits_per_key=1)
    assert len(c.levels) > 2 and {k for k in keys if k in c} == set(listed)


# ------------------------------------------------------------------- quality
def test_quality_rules(docs, rows, no_docs):
    got = QR.quality_rules(docs).collect()
    want = Counter()
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        hit = set()
        for k in range(len(w) - 4):
            if grams[tuple(w[k:k + 5])] > 1:
                hit |= set(range(k, k + 5))
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed)] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert QR.quality_rules(no_docs).collect() == []


def test_line_rules(spark):
    good = "One sentence that is long enough to count as text here.\nAnother line follows it, also quite normal.\n"
    docs = spark.createDataFrame([
        (1, good), (2, good + "Home | About | Contact | Login\n"), (3, "Home | About | Contact | Login | Help | More | And | On | So | Up"),
        (4, "BUY!! NOW!! THIS!! IS!! VERY!! GOOD!! FOR!! YOU!! AND!! ME!!"), (5, good + "We use cookies.\n"),
        (6, "w1### w2*** w3%%% w4&&& w5$$$ w6### w7*** w8%%% w9&&& w10$$$")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in QR.quality_rules(docs).collect()} == {1: True, 2: True, 3: False, 4: False, 5: True, 6: False}
    left = {r.doc_id: r.text for r in QR.keep_clean(docs).collect()}
    assert left == {1: good, 2: good, 5: good}


def test_keep_clean_keeps_columns(docs, no_docs):
    out = QR.keep_clean(docs)
    assert out.schema == docs.schema and {r["odd name"] for r in out.collect()} == {"q"}
    assert QR.keep_clean(no_docs).collect() == []


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages(spark, docs):
    """Each stage against what the ones before it kept."""
    import corpus_pipeline as CP
    from test_dedup import exact_truth, near_truth, substring_truth
    stage = dict(CP.STAGES)
    now, names = docs, docs.columns
    keep = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    after = CP.stored(stage["quality rules"](spark, now, ""), "t-p1")
    verdict = Counter((r.doc_id, r.kept) for r in QR.quality_rules(now).collect() if r.kept)
    assert Counter(i for i, _ in keep(after)) == Counter({i: n for (i, _), n in verdict.items()})
    assert after.columns == names

    now, after = after, CP.stored(stage["exact dedup"](spark, after, ""), "t-p2")
    truth = exact_truth(keep(now))
    assert Counter(i for i, _ in keep(after)) == Counter(k[0] for k, n in truth.items() if k[3] for _ in range(n))
    assert after.columns == names

    now, after = after, CP.stored(stage["near dedup"](spark, after, ""), "t-p3")
    order = sorted(keep(now), key=lambda r: (r[0] is None, r[0] or 0))       # places stand for the rows' ids
    near = near_truth([(k, t) for k, (_, t) in enumerate(order)], 5, 80)
    assert Counter(i for i, _ in keep(after)) == Counter(r[0] for k, r in enumerate(order) if near[k][2] or not near[k][0])
    assert after.columns == names

    now, after = after, CP.stored(stage["substring dedup"](spark, after, ""), "t-p4")
    got = Counter((i, hashlib.sha256(" ".join(WORD.findall(t)).encode()).hexdigest()) for i, t in keep(after))
    assert got == Counter({(k[0], k[3]): n for k, n in substring_truth(keep(now), 50).items()})
    assert after.columns == names

    packed = stage["packing"](spark, after, "").collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == Counter(i for i, _ in keep(after))


def test_stages_tell_namesakes_apart(spark):
    """Rows that repeat an id are judged by their own texts."""
    import corpus_pipeline as CP
    stage = dict(CP.STAGES)
    rnd = random.Random(9)
    word = lambda k: " ".join(f"w{rnd.randrange(5000)}" for _ in range(k))
    frame = lambda rows: spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, __id int")
    keep = lambda name, rows: sorted((r.doc_id, r.text) for r in stage[name](spark, frame(rows), "").collect())

    assert keep("exact dedup", [(1, "abc def ghi"), (2, "abc def ghi"), (2, "xyz def ghi"), (3, "xyz def ghi")]) == \
        [(1, "abc def ghi"), (2, "xyz def ghi")]
    clean, copy = word(80), word(80)
    assert keep("near dedup", [(1, copy), (2, copy), (2, clean), (3, word(9))])[:2] == sorted([(1, copy), (2, clean)])[:2]
    passage, own = word(60), word(90)
    rows = [(1, word(20) + " " + passage), (2, word(20) + " " + passage + " end"), (2, own), (2, "short")]
    left = keep("substring dedup", rows)
    assert left == sorted([rows[0], (2, rows[1][1].replace(passage + " ", "")), (2, own), (2, "short")])
    got = {(r.doc_id, r.n_words): r.n_removed for r in SD.substring_dedup(frame(rows)).collect()}
    assert got == {(1, 80): 0, (2, 81): 60, (2, 90): 0, (2, 1): 0}


def test_pipeline_of_an_empty_table(spark, no_docs):
    import corpus_pipeline as CP
    now = no_docs
    for name, stage in CP.STAGES:
        now = stage(spark, now, "")
    assert now.collect() == []
