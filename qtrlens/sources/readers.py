"""Revenue feed readers and header repair.

Text files are read with every field as a string (no type inference); types
come from the coercion rules, and rows that cannot be repaired go to a
rejects table instead of failing the whole job (or fail it, in strict mode).
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMBER_TEXT, coerce_revenue, parse_date
from ..schemas import FEED_MONEY, WIDE_OUTPUT_COLUMNS

# ---------------------------------------------------------------- fixed values
# Client column aliases, tried in this order after header clean-up.
CLIENT_ALIASES = ["ClientID", "ClientId", "Client ID", "Customer Name", "Client Name", "CustomerName", "ClientName"]
# A header is a date when it looks like 2024-01-31 or 2024/01/31, with or
# without a time of day (spreadsheets write their date headers as timestamps).
DATE_HEADER = r"^\d{4}[-/]\d{2}[-/]\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
# Known long-layout columns, in output order.
KNOWN_COLUMNS = ["ClientID", "Region", "Country", "Date", "Revenue"]
CORRUPT = "_corrupt"
# -----------------------------------------------------------------------------


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim headers and drop spaces and hyphens; ``ClientId`` → ``ClientID``.
    Only metadata changes. Raises when two headers collide after clean-up."""
    new = [c.strip().replace(" ", "").replace("-", "") for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({c for c in new if new.count(c) > 1})
        raise ValueError(f"headers collide after clean-up: {dup}")
    out = df.toDF(*new)
    if "ClientID" not in new and "ClientId" in new:
        out = out.withColumnRenamed("ClientId", "ClientID")
    return out


def resolve_client_column(df: DataFrame, target: str = "ClientID") -> DataFrame:
    """Rename the first known alias (or else the first column whose name
    starts with ``client``) to ``target``. No-op when ``target`` exists."""
    cols = df.columns
    if target in cols:
        return df
    for a in CLIENT_ALIASES:
        if a in cols:
            return df.withColumnRenamed(a, target)
    starts = [c for c in cols if c.lower().startswith("client")]
    return df.withColumnRenamed(starts[0], target) if starts else df


def select_known(df: DataFrame, known: Sequence[str] = KNOWN_COLUMNS) -> DataFrame:
    """Keep the known columns that are present, in the fixed order."""
    return df.select(*[F.col(f"`{c}`") for c in known if c in df.columns])


def detect_date_columns(columns: Sequence[str]) -> list[str]:
    """Headers that are dates (metadata only)."""
    return [c for c in columns if re.match(DATE_HEADER, c)]


def money(c) -> F.Column:
    """Revenue text → ``FEED_MONEY`` by the P3 rule, parsed straight to
    decimal so nothing is rounded. Non-number text → 0; a number that does not
    fit exactly (infinite, too large, more decimals than the type has) → null,
    which ``coerce_feed`` rejects."""
    col = F.col(c) if isinstance(c, str) else c
    s = F.trim(col.cast("string"))
    v = s.try_cast(FEED_MONEY)
    plain = ~s.rlike("[eE]")
    finer = s.try_cast("decimal(38,28)")       # shows decimals lost by an exponent form
    lost = F.when(plain, s.rlike(r"\.\d{%d}\d*[1-9]" % FEED_MONEY.scale)).otherwise(
        F.coalesce(finer != v.try_cast("decimal(38,28)"), F.lit(False)))
    return F.when(s.rlike(NUMBER_TEXT), F.when(~lost, v)).otherwise(F.lit(0).cast(FEED_MONEY))


def coerce_feed(df: DataFrame, on_bad_date: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``Date`` → date and ``Revenue`` → ``FEED_MONEY``. A row that a
    reader could not parse (``_corrupt`` set) is rejected as it is.

    Returns ``(good, rejects)``; rejects carry ``reason``. With
    ``on_bad_date='strict'`` a bad or missing date fails the job instead.
    """
    d = parse_date("Date")
    if on_bad_date == "strict":
        d = F.when(d.isNull(), F.raise_error(F.concat(F.lit("bad date: "),
                                                       F.coalesce(F.col("Date").cast("string"), F.lit("null")))
                                              )).otherwise(d)
    elif on_bad_date != "quarantine":
        raise ValueError("on_bad_date must be 'quarantine' or 'strict'")
    typed = df.withColumn("_date", d).withColumn("_rev", money("Revenue"))
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    reason = (F.when(corrupt, F.lit("malformed row"))
               .when(F.col("_date").isNull(), F.lit("bad date"))
               .when(F.col("_rev").isNull(), F.lit("revenue out of range")))
    typed = typed.withColumn("_reason", reason)
    good = (typed.where(F.col("_reason").isNull())
                 .withColumn("Date", F.col("_date")).withColumn("Revenue", F.col("_rev"))
                 .drop("_date", "_rev", "_reason", CORRUPT))
    rejects = typed.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason").drop("_date", "_rev")
    return good, rejects


def prepare_feed(df: DataFrame, on_bad_date: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """An in-memory table goes through the same repair as a file."""
    return coerce_feed(resolve_client_column(normalize_columns(df)), on_bad_date)


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of a CSV folder by their header line. Tasks pass on the first
    line of each file; what the driver gets is one row per file, as many as
    Spark's own file listing holds."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"),
                                         F.col("_metadata.file_block_start").alias("start"))

    def first_lines(batches):
        seen = None
        for batch in batches:
            for value, file, start in zip(*(batch.column(k) for k in range(3))):
                at = (file.as_py(), start.as_py())
                if at != seen:
                    seen = at
                    if at[1] == 0:
                        yield pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([value.as_py()])],
                                                         names=["path", "header"])

    out: dict[str, list[str]] = {}
    for r in lines.mapInArrow(first_lines, "path string, header string").collect():
        out.setdefault(r.header, []).append(r.path)
    return out


def read_revenue_csv(spark: SparkSession, path: str, on_bad_date: str = "quarantine",
                     repair_headers: bool = True, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Long CSV files with a header. Every field is read as text (no
    inference), then repaired and typed. Returns ``(good, rejects)``.

    Columns are taken by each file's own header, so files of one folder may
    order them differently. Quoted fields may hold line breaks and doubled
    quotes; ``multi_line=False`` reads files without such line breaks in
    splits. A row with missing or surplus fields is a reject."""
    raw = None
    for header, files in sorted(csv_headers(spark, path).items()):
        names = next(csv.reader([header.lstrip("\ufeff")]))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(CORRUPT, T.StringType())])
        part = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
                .option("quote", '"').option("escape", '"').csv(files))
        if repair_headers:
            part = resolve_client_column(normalize_columns(part))
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    if raw is None:
        raw = spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.StringType()) for c in [*KNOWN_COLUMNS, CORRUPT]]))
    return coerce_feed(raw, on_bad_date)


def read_revenue_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: a long table already in parquet passes through unchanged."""
    return spark.read.parquet(path)


def normalize_wide(df: DataFrame) -> DataFrame:
    """One column per date → one row per (customer, date).

    Date headers are found by name; the measures are cast to text first so
    mixed column types unpivot together, then every value goes through the
    revenue rule (bad or missing → 0). The customer column is renamed to
    ``Client ID``, and only the known output columns are kept, in order.
    A table with no date headers is returned unchanged.
    """
    date_cols = detect_date_columns(df.columns)
    if not date_cols:
        return df
    ids = [c for c in df.columns if c not in date_cols]
    as_text = df.select(*[F.col(f"`{c}`") for c in ids],
                        *[F.col(f"`{c}`").cast("string").alias(c) for c in date_cols])
    long = as_text.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in date_cols],
                           "Date", "Revenue")
    cols = long.columns
    if "Client ID" not in cols:
        for alias in ("Customer Name", "Client Name"):
            if alias in cols:
                long = long.withColumnRenamed(alias, "Client ID")
                break
    long = (long.withColumn("Date", F.to_date(F.regexp_replace(F.substring("Date", 1, 10), "/", "-"), "yyyy-MM-dd"))
                .withColumn("Revenue", coerce_revenue("Revenue")))
    return select_known(long, WIDE_OUTPUT_COLUMNS)
