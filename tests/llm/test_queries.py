"""The registered queries: against their SQL, or in shape where there is none
(the operators' own tests hold those against brute force)."""

import os
import sys

import duckdb
import pytest

from qtrlens.llm import queries as Q

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))
from oracle_check import digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    run, sql = Q.QUERIES[name]
    df = run(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    if sql:
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        assert digest(df.columns, rows)[1] == digest(cols, cur.fetchall())[1]
        return
    docs = {i: t for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}
    at = df.columns.index("doc_id")
    assert {r[at] for r in rows} == set(docs)
    if name.startswith("op12"):
        from test_similar import reference_simhash
        want = reference_simhash(list(docs.items()))
        cols = [df.columns.index(c) for c in ("doc_id", "fingerprint", "component_id")]
        assert sorted((tuple(r[c] for c in cols) for r in rows), key=str) == want
    if name.startswith("op3"):
        shard, size = (df.columns.index(c) for c in ("shard", "size"))
        per = {}
        for r in rows:
            per[r[shard]] = per.get(r[shard], 0) + r[size]
        assert len(rows) == len(docs) and sum(per.values()) == sum(len((t or "").encode()) + 1 for t in docs.values())
        assert max(per.values()) <= sum(per.values()) / 16 + max(r[size] for r in rows)
