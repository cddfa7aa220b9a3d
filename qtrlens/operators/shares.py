"""A stated set of queries against all rows of a table, on Spark alone.

The entries are dealt evenly into shares of bounded size, every query row is
sent once to every share, and a task that holds a share's entries takes the
queries as they come, a block at a time. Both sides travel by one shuffle on
the share's number: the entries are read once whatever the number of queries,
no query passes the driver, and a task's memory is one share and one block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE_ROWS = 1 << 16       # entries a task holds at a time, at most
LEAST_ROWS = 1 << 11       # entries below which a share is not split further for the sake of parallel tasks
QUERY_BLOCK = 4096         # queries a task takes at a time


def share_count(entries: DataFrame, share_rows: int, least_rows: int) -> int:
    """Shares of a stored table: as many as its size asks for, or as keep the
    session's shuffle partitions busy."""
    n = entries.count()
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(n / share_rows), min(parts, math.ceil(n / least_rows)))


def struct_table(column, rows: tuple[int, int]) -> pa.Table:
    """Rows (from, number) of a struct column as a table."""
    part = column.slice(*rows)
    return pa.Table.from_arrays(part.flatten(), names=[f.name for f in part.type])


def _meet(scorer, block: int):
    def run(batches):
        share, entries, queries, size, score = None, [], [], 0, None

        def flush():
            nonlocal queries, size, score
            if entries and size:
                score = score or scorer(pa.concat_tables(entries).combine_chunks())
                yield from score(pa.concat_tables(queries).combine_chunks())
            queries, size = [], 0

        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
                if lo == hi:
                    continue
                if at[lo] != share:
                    yield from flush()
                    share, entries, score = at[lo], [], None
                if kind[lo] == 0:
                    entries.append(struct_table(batch.column(2), (lo, hi - lo)))
                    continue
                for a in range(lo, hi, block):
                    queries.append(struct_table(batch.column(3), (a, min(block, hi - a))))
                    size += len(queries[-1])
                    if size >= block:
                        yield from flush()
        yield from flush()
    return run


def meet_shares(entries: DataFrame, queries: DataFrame, scorer, schema, share_rows: int | None = None,
                block: int | None = None, least_rows: int | None = None, lanes: int = 1) -> DataFrame:
    """What ``scorer(entries)(queries)`` yields (Arrow batches of ``schema``)
    for every share of ``entries`` and block of ``queries``; ``scorer`` gets
    Arrow tables with the columns of the two frames and is made once for each
    share and lane. ``entries`` should be a stored table: its rows are counted
    first. With ``lanes`` the queries are dealt into so many lanes, each with
    a copy of the entries: fewer, larger shares then give fewer rows per query
    and still keep as many tasks busy."""
    n = share_count(entries, share_rows or SHARE_ROWS, least_rows or LEAST_ROWS)
    e, q = F.struct(*entries.columns), F.struct(*queries.columns)
    etype, qtype = entries.select(e).schema[0].dataType, queries.select(q).schema[0].dataType
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    turn = lambda k: F.pmod(F.monotonically_increasing_id(), F.lit(k))
    target = (F.col("_s") * F.lit(lanes) + F.col("_l")).alias("_share")
    dealt = entries.select(turn(n).alias("_s"), e.alias("_e")).select("_s", every(lanes).alias("_l"), "_e").select(
        target, F.lit(0).alias("_kind"), "_e", F.lit(None).cast(qtype).alias("_q"))
    sent = queries.select(turn(lanes).alias("_l"), q.alias("_q")).select("_l", every(n).alias("_s"), "_q").select(
        target, F.lit(1).alias("_kind"), F.lit(None).cast(etype).alias("_e"), "_q")
    return (dealt.unionByName(sent).repartition(n * lanes, "_share").sortWithinPartitions("_share", "_kind")
            .mapInArrow(_meet(scorer, block or QUERY_BLOCK), schema))
