"""Sets of ids as bitmaps that merge (A7, U2, ST2 without the id rows).

An id is one bit of the 32,768-bit bitmap of its bucket, so a set is one row of
4 KB per bucket that holds any of its ids, and sets from any split of the input
merge by OR. Counts are exact. Ids must be whole numbers, and close together to
be small: ``id_numbers`` gives other ids consecutive numbers, kept in a stored
dictionary that later loads extend.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.chunks import global_row_index
from .revenue import GEO_KEYS, drop_null_keys, money_sum, with_quarter

BITS = 32768                    # bits of Spark's bitmaps


def id_numbers(ids: DataFrame, id_col: str, known: DataFrame | None = None) -> DataFrame:
    """Dictionary ``(id_col, no)``: the distinct ids of ``ids`` numbered from
    1 in their order; with ``known``, an earlier dictionary, its numbers stay
    and new ids follow its last. A null id has no number."""
    new = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    first = F.lit(1).cast("long")
    if known is not None:
        new = new.join(known, id_col, "left_anti")
        first = F.lit((known.agg(F.max("no")).first()[0] or 0) + 1).cast("long")
    numbered = global_row_index(new, [id_col], out="_at").select(id_col, (F.col("_at") + first).alias("no"))
    return numbered if known is None else known.select(id_col, "no").unionByName(numbered)


def id_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str, *amounts) -> DataFrame:
    """One row ``(keys, bucket, bitmap)`` per group and bucket of ids, with
    ``amounts`` (aggregates) beside them. Rows without an id are in a row of
    their own, with a null bucket and no bit set."""
    no = F.col(id_col).cast("long")
    return df.groupBy(*keys, F.bitmap_bucket_number(no).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("bitmap"), *amounts)


def merge_bitmaps(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets that agree in ``keys``: ``(keys, bucket, bitmap)``."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_ids(sets: DataFrame, keys: Sequence[str], out: str = "ids") -> DataFrame:
    """Ids per group of merged sets (one bitmap per group and bucket)."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(out))


def ids_of(sets: DataFrame, out: str) -> DataFrame:
    """The ids of merged sets, a row each beside the other columns. Only bytes
    with a bit set are opened."""
    rest = [c for c in sets.columns if c not in ("bucket", "bitmap")]
    places = F.expr("filter(sequence(1, octet_length(bitmap)), i -> substr(bitmap, i, 1) <> X'00')")
    at = sets.where(F.col("bucket").isNotNull()).select(*rest, "bucket", "bitmap", F.explode(places).alias("_i"))
    byte = F.conv(F.hex(F.substring("bitmap", F.col("_i"), 1)), 16, 10).cast("int")
    bits = at.select(*rest, "bucket", "_i", byte.alias("_b")).select(
        *rest, "bucket", "_i", "_b", F.explode(F.array(*[F.lit(k) for k in range(8)])).alias("_k"))
    place = (F.col("_i") - 1) * 8 + F.col("_k")
    number = (F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * F.lit(BITS).cast("long") + place + 1)
               .otherwise(F.col("bucket") * F.lit(BITS).cast("long") - place))
    return bits.where(F.expr("(shiftright(_b, _k) & 1) = 1")).select(*rest, number.cast("long").alias(out))


def partial_bitmaps(chunk: DataFrame, client_col: str = "ClientID", load_col: str | None = None) -> DataFrame:
    """A7 (first half) without client rows: per ``(load, Quarter, Region,
    Country)`` and bucket of clients the revenue and the clients' bitmap."""
    df = drop_null_keys(with_quarter(chunk), GEO_KEYS)
    return id_bitmaps(df, [*([load_col] if load_col else []), *GEO_KEYS], client_col, F.sum("Revenue").alias("Revenue"))


def merge_partial_bitmaps(partials: DataFrame) -> DataFrame:
    """The partials of all loads merged: ``TotalRevenue`` adds,
    ``NumClients`` counts the union of the bitmaps."""
    merged = partials.groupBy(*GEO_KEYS, "bucket").agg(
        F.sum("Revenue").alias("Revenue"), F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy(*GEO_KEYS).agg(money_sum("Revenue").alias("TotalRevenue"), F.sum("n").alias("NumClients"))


def overlap_counts(sets: DataFrame, pairs: DataFrame, period: str = "Quarter") -> DataFrame:
    """How the sets of paired periods overlap: ``(prev_quarter, curr_quarter,
    lost, new, retained)`` for every row of ``pairs``, by counting the union of
    the two sets; ``sets`` has one bitmap per period and bucket."""
    p = pairs.select("prev_quarter", "curr_quarter")
    sides = [p.join(sets.where(F.col("bucket").isNotNull()).withColumnRenamed(period, col), col).select(
        "prev_quarter", "curr_quarter", "bucket", "bitmap", F.lit(col).alias("side")) for col in p.columns]
    size = lambda col: F.sum(F.when(F.col("side") == col, F.bitmap_count("bitmap")).otherwise(0))
    per = sides[0].unionByName(sides[1]).groupBy("prev_quarter", "curr_quarter", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("either"), size("prev_quarter").alias("before"),
        size("curr_quarter").alias("after"))
    total = per.groupBy("prev_quarter", "curr_quarter").agg(*(F.sum(c).alias(c) for c in ("either", "before", "after")))
    n = {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("either", "before", "after")}
    return p.join(total, ["prev_quarter", "curr_quarter"], "left").select(
        "prev_quarter", "curr_quarter", (n["either"] - n["after"]).alias("lost"), (n["either"] - n["before"]).alias("new"),
        (n["before"] + n["after"] - n["either"]).alias("retained"))


def stream_client_bitmaps(stream: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """ST2 with bitmaps as state: one entry of 4 KB per quarter, region,
    country and bucket of clients instead of one per client. ``count_ids`` over
    the latest rows gives the running number of distinct clients."""
    s = drop_null_keys(with_quarter(stream), [*GEO_KEYS, client_col])
    return id_bitmaps(s, GEO_KEYS, client_col)
