"""Sequential folds per key whose pieces run in parallel.

A fold that walks a key's rows in order seems to need one task per key. Here a
key is cut wherever range partitions end, and a piece whose start is not known
yet is described by its *transition*: a small table that says, for every state
the piece may begin in, in which state it ends. The steps are

1. range-partition by (key, order); in each partition all keys but the first
   begin there (or the first does, too, if nothing precedes it), so they are
   folded at once. The first key's piece may continue an earlier partition's,
   so its rows are passed on with its transition. One written table holds all
   three: results, transitions, rows passed on;
2. transitions are composed along the partitions, at most two narrow rows a
   partition, which gives the state each of those pieces begins in;
3. those pieces are folded from their states.

A key without any gap is thus spread over as many tasks as it has range
partitions. A task holds one partition's rows.

A ``machine`` does the fold on Arrow tables (columns: key, then the others):

* ``fresh``: the state ``(a, b)`` a key begins in; ``a`` and ``b`` are longs
  or None;
* ``fold(table, starts, state)``: rows and output columns of a table whose
  pieces begin at ``starts``, the first in ``state`` and the others fresh, and
  the state after the last: ``(indices, {name: values}, state)``;
* ``transition(table)``: the transition of a single piece, as bytes;
* ``step(transition, state)``: the state after a piece.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage

_DONE, _NOTE, _ROW = 0, 1, 2


def key_starts(key) -> np.ndarray:
    """Where the runs of equal keys begin (nulls are equal)."""
    if not len(key):
        return np.zeros(0, np.int64)
    whole = key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key
    at = whole.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])


def _batches(schema: pa.Schema, n: int, **cols):
    """Batches of ``n`` rows with the given columns and nulls for the rest."""
    if n:
        table = pa.Table.from_arrays(
            [cols[f.name].cast(f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)
        yield from table.to_batches(max_chunksize=1 << 14)


def _same(n: int, value, kind) -> pa.Array:
    return pa.array([value], kind).take(pa.array(np.zeros(n, np.int64)))


def _folded(table, out: pa.Schema, result, names, **more):
    """Results of a fold as batches: the picked rows' columns and the new ones."""
    indices, new, _ = result
    take = pa.array(indices, pa.int64())
    cols = {c: table[c].take(take) for c in names}
    cols |= {c: pa.array(v, out.field(c).type) for c, v in new.items()}
    return _batches(out, len(indices), _kind=_same(len(indices), _DONE, pa.int32()), **cols,
                    **{k: _same(len(indices), v, out.field(k).type) for k, v in more.items()})


def _first_pass(machine, out: pa.Schema, names: list[str]):
    def run(batches):
        table = [b for b in batches if len(b)]
        if not table:
            return
        table = pa.Table.from_batches(table).combine_chunks()
        part = TaskContext.get().partitionId()
        starts = key_starts(table.column(0))
        cut = int(starts[1]) if len(starts) > 1 else len(table)
        first, rest = table.slice(0, cut), table.slice(cut)
        note = {"_kind": pa.array([_NOTE], pa.int32()), "_p": pa.array([part], pa.int32())}
        yield from _batches(out, 1, **note, **{names[0]: first.column(0).slice(0, 1)},
                            _note=pa.array([machine.transition(first.combine_chunks())], pa.binary()))
        yield from _batches(out, cut, _kind=_same(cut, _ROW, pa.int32()), _p=_same(cut, part, pa.int32()),
                            **{c: first[c] for c in names})
        if len(rest):
            result = machine.fold(rest.combine_chunks(), starts[1:] - cut, machine.fresh)
            yield from _folded(rest, out, result, names, _p=part)
            a, b = result[2]
            yield from _batches(out, 1, **note, **{names[0]: table.column(0).slice(len(table) - 1, 1)},
                                _a=pa.array([a], pa.int64()), _b=pa.array([b], pa.int64()))
    return run


def _compose(machine):
    """Transitions sorted by (key, partition) to the states pieces begin in."""
    def run(batches):
        last, state = object(), machine.fresh
        for batch in batches:
            rows = []
            for key, part, note, a, b in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if key != last:
                    last, state = key, machine.fresh
                if note is None:
                    state = (a, b)
                else:
                    rows.append((part, *state))
                    state = machine.step(note, state)
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                                              pa.array(cols[2], pa.int64())], names=["_p", "_a", "_b"])
    return run


def _second_pass(machine, out: pa.Schema, names: list[str]):
    """Pieces, sorted by partition and order, each with its first state."""
    def run(batches):
        held, part = [], None

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            state = (table["_a"][0].as_py(), table["_b"][0].as_py())
            piece = table.select(names)
            yield from _folded(piece, out, machine.fold(piece, np.zeros(1, np.int64), state), names, _p=part)

        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1, [len(at)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                if held and at[lo] != part:
                    yield from flush()
                    held = []
                part = int(at[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from flush()
    return run


def fold_pieces(df: DataFrame, order: Sequence[str], machine, new: Sequence[T.StructField], name: str = "pieces"):
    """Fold ``df`` (first column: the key) in the order of ``order`` per key.
    Returns ``(results, passed)``: the rows the fold picks with its new
    columns and ``_p``, the range partition they came from, and the rows of
    the pieces that begin a partition (key, the other columns, ``_p``)."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    schema = T.StructType([T.StructField("_kind", T.IntegerType()), T.StructField("_p", T.IntegerType()), *df.schema.fields,
                           *new, T.StructField("_note", T.BinaryType()), T.StructField("_a", T.LongType()),
                           T.StructField("_b", T.LongType())])
    for f in schema.fields:
        f.nullable = True
    out = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    by = [F.col(c) for c in (names[0], *order)]
    first = cut_lineage(df.repartitionByRange(n, *by).sortWithinPartitions(*by)
                        .mapInArrow(_first_pass(machine, out, names), schema), spark, name)
    notes = first.where(F.col("_kind") == _NOTE).select(F.col(names[0]).alias("key"), "_p", "_note", "_a", "_b")
    states = (notes.repartition("key").sortWithinPartitions("key", "_p", F.col("_note").isNull())
              .mapInArrow(_compose(machine), "_p int, _a long, _b long"))
    passed = first.where(F.col("_kind") == _ROW).select("_p", *names)
    again = (passed.join(states, "_p").select("_p", *names, "_a", "_b").repartition(n, "_p")
             .sortWithinPartitions("_p", *order).mapInArrow(_second_pass(machine, out, names), schema))
    cols = ["_p", *names, *[f.name for f in new]]
    results = first.where(F.col("_kind") == _DONE).select(*cols).unionByName(again.select(*cols))
    return results, passed
