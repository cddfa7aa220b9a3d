"""Upserts that rewrite only the partitions they touch."""

import pytest
from pyspark.sql import functions as F

from qtrlens.operators import text as TX
from qtrlens.session import scratch_path
from qtrlens.sources import versioned_index as VI

SCHEMA = "id string, vec array<double>, note string"


def entries(spark, rows):
    return spark.createDataFrame([(i, [float(v)], n) for i, v, n in rows], SCHEMA)


def rows(df):
    return sorted(((r.id, r.vec[0], r.note) for r in df.collect()), key=str)


def files(df):
    return {r.f for r in df.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_only_touched_partitions_change(spark):
    path = scratch_path(spark, "t-vindex")
    base = entries(spark, [(f"d{i}", i, "old") for i in range(200)])
    assert VI.save_versioned(base, path, parts=16) == 0
    before = {p: files(VI.load_versioned(spark, path, parts=[p])) for p in range(16)}
    one = entries(spark, [("d7", 70, "new"), ("d7", 71, "newer"), (None, 1, "no key")])
    assert VI.upsert_versioned(spark, path, one, order="note") == 1
    two = entries(spark, [("x", 5, "added"), (None, 2, "no key")])
    assert VI.upsert_versioned(spark, path, two) == 2
    want = TX.upsert_index(TX.upsert_index(base, one, order="note"), two)
    assert rows(VI.load_versioned(spark, path)) == rows(want)
    assert ("d7", 71.0, "newer") in rows(VI.load_versioned(spark, path, 1))
    assert rows(VI.load_versioned(spark, path, 0)) == rows(base)                 # earlier versions stay
    touched = {r.p for r in one.unionByName(two).select(VI._part("id", 16).alias("p")).distinct().collect()}
    after = {p: files(VI.load_versioned(spark, path, parts=[p])) for p in range(16)}
    assert len(touched) < 5 and {p for p in range(16) if after[p] != before[p]} == touched


def test_empty_and_missing(spark):
    path = scratch_path(spark, "t-vindex")
    with pytest.raises(ValueError):
        VI.load_versioned(spark, path)
    VI.save_versioned(entries(spark, []), path, parts=4)
    assert VI.load_versioned(spark, path).count() == 0
    assert VI.load_versioned(spark, path).schema.simpleString() == entries(spark, []).schema.simpleString()
    assert VI.upsert_versioned(spark, path, entries(spark, [])) == 1
    VI.upsert_versioned(spark, path, entries(spark, [("a", 1, None)]))
    assert rows(VI.load_versioned(spark, path)) == [("a", 1.0, None)]
    with pytest.raises(ValueError):
        VI.load_versioned(spark, path, 9)


def test_an_uncommitted_write_is_not_seen(spark):
    path = scratch_path(spark, "t-vindex")
    VI.save_versioned(entries(spark, [("a", 1, "x")]), path, parts=4)
    VI._write(entries(spark, [("a", 2, "lost"), ("b", 3, "lost")]), path, "id", 4)       # as if the job died here
    assert rows(VI.load_versioned(spark, path)) == [("a", 1.0, "x")]
    assert VI.upsert_versioned(spark, path, entries(spark, [("b", 4, "y")])) == 1
    assert rows(VI.load_versioned(spark, path)) == [("a", 1.0, "x"), ("b", 4.0, "y")]
