"""The numbered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrlens.llm import bpe as BPE
from qtrlens.llm import chat as CHAT
from qtrlens.llm import exact_dedup as EXACT
from qtrlens.llm import hard_negatives as HARD
from qtrlens.llm import near_dedup as NEAR
from qtrlens.llm import packing as PACK
from qtrlens.llm import periodic as RUNS
from qtrlens.llm import quality as QUALITY
from qtrlens.llm import resharding as SHARD
from qtrlens.llm import simhash as SIM
from qtrlens.llm import substring_dedup as SUBSTR
from qtrlens.llm import url_filter as URLS
from qtrlens.llm import warc as WARC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EXACT.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SUBSTR.substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def old_shard_of(source, shards: int = SHARD.SHARDS):
    """The layout to be resharded: documents by their source."""
    return F.pmod(F.hash(F.coalesce(source, F.lit(""))), F.lit(shards))


def op3_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = SHARD.resharded(spark, docs, old_shard_of(F.col("source")))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "size",
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.lit("bytes").alias("law"),
                       "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                       "old_shard")


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NEAR.near_dedup(table(spark, sf_dir, "documents"), shingle=4)


def op5_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WARC.archive_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_automaton_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BPE.round_trip_digest(table(spark, sf_dir, "documents"), BPE.session_vocabulary(spark))


def op7_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PACK.pack(table(spark, sf_dir, "documents"), BPE.session_vocabulary(spark), with_ids=False)


def op8_chat_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
    path = BPE.session_vocabulary(spark)
    read = CHAT.read_chats(CHAT.format_chats(rows, path), path)
    turns = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select("conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# ---- fixed values: the URL rules of op9
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def op9_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return URLS.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUALITY.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def plant_period(doc_id: int | None, text: str | None) -> str | None:
    """The texts of op11: in one of ten documents (by the CRC-32 of its id) the
    words from some place on repeat."""
    h = zlib.crc32(str(doc_id).encode())
    words = (text or "").encode().split() if doc_id is not None and h % 10 == 0 else []
    if not words:
        return text
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    whole, rest = divmod(len(words) - a, p)
    cycle = words[a:a + p]
    return b" ".join(words[:a] + cycle * whole + cycle[:rest]).decode()


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = RUNS.periodic_runs(table(spark, sf_dir, "documents"), prepare=plant_period)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                                 (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), "collapsed_sha256")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIM.simhash_dedup(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return HARD.hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")))


_WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]"

_OP1 = rf"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_GAP}', '', 'g')) AS text_sha256,
                  length(coalesce(text, '')) AS n_points FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-n_points, doc_id)) AS keep_id FROM n GROUP BY ALL)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)"""

_OP5 = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
m AS (SELECT payload_digest, max(page_id) AS last_id FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id < m.last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < m.last_id THEN m.last_id END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes >= 1000"""

_OP2 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM w, unnest(range(1, len(w) - 48)) t(i)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first_doc FROM g),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM m, range(0, 50) r(k) WHERE doc_id > first_doc),
stay AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.pos) AS kept
         FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM w) x
         ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.pos = x.pos GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed,
       sha256(coalesce(stay.kept, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) n ON n.doc_id = w.doc_id
LEFT JOIN stay ON stay.doc_id = w.doc_id"""

_OP4 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
      FROM w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM w UNION SELECT reach.id, link.y FROM reach JOIN link ON link.x = reach.other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT id AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM least LEFT JOIN n ON n.doc_id = id"""

_OP8 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(regexp_replace(text, '(\\|<conversation>|</turn>|### (?:System|User|Assistant|Role):)', '\\\1', 'g')) AS esc,
             CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 END AS head FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(15 + sum(head + esc + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

_OP9 = r"""
WITH p AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                                THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) AS path
      FROM p),
r(verdict, rh, rp) AS (VALUES """ + ", ".join(
    f"('{a}', '{URLS.split_rule(r)[0]}', '{URLS.split_rule(r)[1]}')" for a, r in URL_RULES) + r"""),
m AS (SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule,
             arg_max(verdict, length(rh || rp)) AS verdict
      FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id"""

_OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS h FROM d, unnest(range(1, len(w) - 3)) t(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, h) AS n FROM g) x WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 5) r(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
j AS (SELECT doc_id, line, pos, length(regexp_replace(line, '{_GAP}', '', 'g')) AS chars,
             length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) + length(line) - length(replace(line, '!!', '')) AS bad,
             row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth
      FROM l WHERE regexp_matches(line, '{_WORD}')),
judged AS (SELECT doc_id, nth > 1 AS again, chars,
                  nth > 1 OR (bad > 0 AND 100 * bad > {QUALITY.MAX_SYMBOLS} * chars)
                  OR regexp_matches(line, '(?: [|»›>] .*){{2}}')
                  OR regexp_matches(lower(line), '{"|".join(QUALITY.BOILERPLATE)}') AS fails FROM j),
per AS (SELECT doc_id, count_if(again) AS dup, sum(CASE WHEN fails THEN chars ELSE 0 END) AS lost FROM judged GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '{_GAP}', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
      FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id LEFT JOIN per ON per.doc_id = d.doc_id),
f AS (SELECT *, n_words < {QUALITY.MIN_WORDS} OR 100 * n_repeat_words > {QUALITY.MAX_REPEAT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= {QUALITY.MAX_LOST} * word_chars AS kept FROM f"""

_OP11 = rf"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
                  xor(list_reduce(list_concat([4294967295], flatten(list_transform(
                      string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
                      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END),
                      4294967295) AS h FROM documents),
a AS (SELECT *, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM c),
d AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
                          THEN list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + g % 8)) END])
                          ELSE w END AS w FROM a),
t AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 5], ' ')) AS five FROM d, unnest(range(len(w) - 4)) u(i)),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i > x.i),
island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair),
stretch AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM island GROUP BY doc_id, q, island),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, pos FROM run, unnest(range(start + period, start + length)) u(pos)),
stay AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.pos) AS kept
         FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d) x
         ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.pos = x.pos GROUP BY x.doc_id),
per AS (SELECT doc_id, count(*) AS n_runs, min(ROW(-length, start, period)) AS top,
               string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM run GROUP BY doc_id)
SELECT d.doc_id, coalesce(per.n_runs, 0) AS n_runs, per.top[2] AS start, -per.top[1] AS length, per.top[3] AS period,
       1000 * -per.top[1] // per.top[3] AS exponent_milli, sha256(coalesce(per.lines, '')) AS runs_sha256,
       sha256(coalesce(stay.kept, '')) AS collapsed_sha256
FROM d LEFT JOIN per ON per.doc_id = d.doc_id LEFT JOIN stay ON stay.doc_id = d.doc_id"""

_OP13 = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
         ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5"""

QUERIES = {
    "op1_exact_dedup": (op1_exact_dedup, _OP1),
    "op2_anchor_dedup": (op2_anchor_dedup, _OP2),
    "op3_flow_resharding": (op3_flow_resharding, None),
    "op4_chosen_path": (op4_chosen_path, _OP4),
    "op5_warc_ranges": (op5_warc_ranges, _OP5),
    "op6_automaton_bpe": (op6_automaton_bpe, None),
    "op7_retrieval_packing": (op7_retrieval_packing, None),
    "op8_chat_assembly": (op8_chat_assembly, _OP8),
    "op9_url_cascade": (op9_url_cascade, _OP9),
    "op10_line_quality": (op10_line_quality, _OP10),
    "op11_periodic_runs": (op11_periodic_runs, _OP11),
    "op12_simhash": (op12_simhash, None),
    "op13_hard_negatives": (op13_hard_negatives, _OP13),
}
