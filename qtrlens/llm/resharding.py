"""Resharding by minimum-cost flow.

Documents lie in old shards of known sizes; the new shards have capacities.
Each old shard is divided into blocks of documents, Spark sums the blocks'
sizes, and the driver solves a transport problem between old and new shards -
a byte that stays costs nothing, one that moves costs one (or what ``cost``
says) - by successive shortest paths over at most ``shards**2`` arcs. Whole
blocks, largest first, then fill the arcs' amounts. Only the shards that gain
or lose a block are written anew.

What reaches the driver is one row per block: ``shards * blocks_per_shard``
at most (16,384 at the defaults), whatever the size of the data.

Defined results: a null text has size 1 (no bytes, plus one) and CRC 0. Null
ids lie in old shard 0. Rows that repeat an id share a block; each gets a slot
of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qtrlens.session import scratch_path

SHARDS = 16
BLOCKS_PER_SHARD = 1024


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Amounts ``{(old, new): bytes}`` that empty every supply within the
    capacities at least total cost (successive shortest paths with
    potentials; costs must not be negative)."""
    n, m = len(supply), len(capacity)
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    price = [0] * (n + m)
    for src in range(n):
        while left[src] > 0:
            dist, back = {src: 0}, {}
            heap, done = [(0, src)], set()
            while heap:
                d, x = heapq.heappop(heap)
                if x in done:
                    continue
                done.add(x)
                arcs = ([(n + j, cost(x, j)) for j in range(m)] if x < n else
                        [(i, -cost(i, x - n)) for i in range(n) if flow.get((i, x - n), 0) > 0])
                for y, c in arcs:
                    nd = d + c + price[x] - price[y]
                    if nd < dist.get(y, float("inf")):
                        dist[y], back[y] = nd, x
                        heapq.heappush(heap, (nd, y))
            ends = [(dist[n + j] + price[n + j] - price[src], j) for j in range(m) if room[j] > 0 and n + j in dist]
            if not ends:
                raise ValueError("capacities are smaller than the supplies")
            last = min(ends)[1]
            far = max(dist.values())
            for x in range(n + m):
                price[x] += dist.get(x, far)
            path, y = [], n + last
            while y != src:
                path.append((back[y], y))
                y = back[y]
            amount = min([left[src], room[last], *(flow[(b, a - n)] for a, b in path if a >= n)])
            for a, b in path:
                key, step = ((a, b - n), amount) if a < n else ((b, a - n), -amount)
                flow[key] = flow.get(key, 0) + step
            left[src] -= amount
            room[last] -= amount
    return {k: v for k, v in flow.items() if v}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def block_plan(blocks: list[tuple[int, int, int, int]], shards: int, capacity=None, cost=None):
    """``blocks``: (old shard, block, bytes, rows). Returns rows (old shard,
    block, new shard, first slot) and the flow they follow."""
    supply = [0] * shards
    for old, _, size, _ in blocks:
        supply[old] += size
    capacity = capacity or equal_capacities(sum(supply), shards)
    cost = cost or (lambda i, j: int(i != j))
    flow = min_cost_flow(supply, capacity, cost)
    want = {k: v for k, v in flow.items()}
    placed = []
    for old, block, size, rows in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        arcs = [(want[k] - size, -k[1], k) for k in want if k[0] == old]
        key = max(arcs)[2]                       # where most is still wanted
        want[key] -= size
        placed.append((old, block, key[1], rows))
    slots = [0] * shards
    out = []
    for old, block, new, rows in sorted(placed):
        out.append((old, block, new, slots[new]))
        slots[new] += rows
    return out, flow


def assign(docs: DataFrame, old_shard, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
           blocks_per_shard: int = BLOCKS_PER_SHARD, capacity=None, cost=None) -> DataFrame:
    """Documents (all columns, as struct ``row``) with ``old_shard, block,
    size, shard`` and the block's ``first_slot``."""
    spark = docs.sparkSession
    doc_id = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0).cast("long"))
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + F.lit(1)
    held = docs.select(F.struct("*").alias("row"), old_shard.cast("int").alias("old_shard"),
                       F.pmod(F.xxhash64(doc_id), F.lit(blocks_per_shard)).cast("int").alias("block"),
                       size.alias("size"), doc_id.alias("order_id"))
    # the block table needs ids and lengths only
    sizes = held.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    blocks = [(r.old_shard, r.block, r.bytes, r.n) for r in sizes.collect()]   # bounded: shards * blocks_per_shard
    plan, _ = block_plan(blocks, shards, capacity, cost)
    table = spark.createDataFrame(plan, "old_shard int, block int, shard int, first_slot long")
    return held.join(F.broadcast(table), ["old_shard", "block"])               # bounded by the same product


def with_slots(assigned: DataFrame, text_col: str = "text") -> DataFrame:
    """Place of every document in its shard: its block's first slot plus its
    position in the block (a block goes to one shard as a whole)."""
    inside = W.partitionBy("old_shard", "block").orderBy("order_id", "size", F.col("row").getField(text_col))
    return assigned.select("row", "old_shard", "block", "size", "shard",
                           (F.col("first_slot") + F.row_number().over(inside) - F.lit(1)).alias("slot"))


def reshard(docs: DataFrame, old_shard, text_col: str = "text", **options) -> DataFrame:
    """``row`` (all columns of ``docs``) with ``old_shard, block, size, shard,
    slot``: shards near equal in bytes (or as ``capacity`` says), fewest bytes
    moved. ``old_shard`` is a column expression giving 0..shards-1."""
    return with_slots(assign(docs, old_shard, text_col=text_col, **options), text_col)


def affected_shards(assigned: DataFrame) -> list[int]:
    """Shards that gain or lose a document."""
    moved = assigned.where("shard <> old_shard").select("shard", "old_shard").distinct().collect()  # <= shards**2 rows
    return sorted({x for r in moved for x in (r.shard, r.old_shard)})


def rewrite_affected(assigned: DataFrame, path: str, text_col: str = "text") -> list[int]:
    """Write the affected shards, one folder per shard, and return their
    numbers; untouched shards keep their files."""
    affected = affected_shards(assigned)
    if affected:
        with_slots(assigned.where(F.col("shard").isin(affected)), text_col).write.mode("overwrite") \
            .partitionBy("shard").parquet(path)
    return affected


def resharded(spark: SparkSession, docs: DataFrame, old_shard, text_col: str = "text", shards: int = SHARDS,
              **options) -> DataFrame:
    """Reshard, rewrite the affected shards in the shared folder, and return
    all rows: rewritten ones from their new files, the rest from the old."""
    assigned = assign(docs, old_shard, text_col=text_col, shards=shards, **options)
    path = scratch_path(spark, "op3-shards")
    affected = rewrite_affected(assigned, path, text_col)
    kept = with_slots(assigned.where(~F.col("shard").isin(affected)) if affected else assigned, text_col)
    if not affected:
        return kept
    fresh = spark.read.schema(kept.schema).parquet(path).select(*kept.columns)
    return fresh if len(affected) == shards else fresh.unionByName(kept)
