"""Scalar column functions (P3–P18). All are built-in expressions, so they stay
inside whole-stage codegen; none goes through a Python worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Text that is a number for the revenue rule: optional sign, digits with an
# optional fraction and exponent, or inf/infinity. Java's "1d"/"1f" suffixes,
# thousands separators and hex are not numbers under this rule.
NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
# Accepted date layouts, tried in this order.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd"]
# Word characters for tokenising: letters, digits (any script) and underscore.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
TRUNCATE_AT = 120
ELLIPSIS = "..."
CHARS_PER_TOKEN = 4
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_revenue(c, keep_inf: bool = False) -> Column:
    """Text or number → double; anything that is not a number → 0.0.

    NaN and null become 0. Infinite values become 0 too unless ``keep_inf``.
    """
    c = _c(c)
    s = F.trim(c.cast("string"))
    v = F.when(s.rlike(NUMBER_TEXT), s.try_cast("double"))
    v = F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))
    if not keep_inf:
        v = F.when(F.abs(v) == F.lit(float("inf")), F.lit(0.0)).otherwise(v)
    return v


def parse_date(c) -> Column:
    """String in one of DATE_FORMATS, or a date/timestamp → date; else null."""
    c = _c(c)
    s = F.trim(c.cast("string"))
    tries = [F.try_to_date(s, f) for f in DATE_FORMATS]
    # a full timestamp text keeps its calendar day
    tries.append(F.try_to_timestamp(s).cast("date"))
    return F.coalesce(*tries)


def quarter_label(d) -> Column:
    """P5: ``YYYYQn``; sorts chronologically as a string for years 1000–9999."""
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def quarter_of_year_label(d) -> Column:
    """``Qn`` with the year dropped (seasonal view)."""
    d = _c(d)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def estimate_tokens(text) -> Column:
    """P10: ``max(1, len(text) // 4)``; ``length`` counts code points."""
    t = _c(text)
    return F.greatest(F.lit(1), F.floor(F.length(t) / CHARS_PER_TOKEN).cast("int"))


def truncate_text(text, limit: int = TRUNCATE_AT) -> Column:
    """First ``limit`` characters plus ``...`` when longer."""
    t = _c(text)
    return F.when(F.length(t) > limit,
                  F.concat(F.substring(t, 1, limit), F.lit(ELLIPSIS))).otherwise(t)


def tokenize(text) -> Column:
    """Lower-cased word tokens, in order of appearance."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_PATTERN), 0)


def hash_bucket(token, dim: int) -> Column:
    """``int(md5(token), 16) % dim`` without leaving the JVM.

    For a power of two up to 65536 the low hex digits decide the remainder.
    Otherwise the 32 hex digits are folded left to right modulo ``dim``.
    """
    h = F.md5(_c(token))
    if dim & (dim - 1) == 0 and dim <= 65536:
        return (F.conv(F.substring(h, 29, 4), 16, 10).cast("int") % F.lit(dim)).cast("int")
    digits = F.transform(F.split(h, ""), lambda ch: F.conv(ch, 16, 10).cast("long"))
    folded = F.aggregate(digits, F.lit(0).cast("long"),
                         lambda acc, x: (acc * 16 + x) % F.lit(dim))
    return folded.cast("int")


def content_key(*cols) -> Column:
    """SHA-256 over the fields joined by ``|``; null is spelled out."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("<null>")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)


def pair_label(prev, curr, sep: str = "->") -> Column:
    """``prev->curr`` (or ``prev_to_curr`` with ``sep='_to_'``)."""
    return F.concat(_c(prev), F.lit(sep), _c(curr))


def compress_record(df: DataFrame) -> DataFrame:
    """Keep scalars; a list becomes its length; a struct or map becomes
    per-field list length, or the field's type name for non-list fields."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if isinstance(dt, T.ArrayType):
            out.append(F.size(c).alias(f.name))
        elif isinstance(dt, T.StructType):
            sub = []
            for sf in dt.fields:
                sc = c.getField(sf.name)
                if isinstance(sf.dataType, T.ArrayType):
                    sub.append(F.size(sc).cast("string").alias(sf.name))
                else:
                    sub.append(F.lit(sf.dataType.simpleString()).alias(sf.name))
            out.append(F.struct(*sub).alias(f.name))
        elif isinstance(dt, T.MapType):
            if isinstance(dt.valueType, T.ArrayType):
                out.append(F.transform_values(c, lambda k, v: F.size(v).cast("string")).alias(f.name))
            else:
                name = dt.valueType.simpleString()
                out.append(F.transform_values(c, lambda k, v: F.lit(name)).alias(f.name))
        else:
            out.append(c.alias(f.name))
    return df.select(*out)


def summary_to_json(step, summary) -> Column:
    """``{"step": ..., "summary": ...}`` as JSON text."""
    return F.to_json(F.struct(_c(step).alias("step"), _c(summary).alias("summary")))


def normalize_vector(vec) -> Column:
    """Non-finite entries → 0, then unit length; a zero or non-finite
    norm leaves the (cleaned) vector unchanged."""
    v = F.transform(_c(vec), lambda x: F.when(
        F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))) | x.isNull(),
        F.lit(0.0)).otherwise(x.cast("double")))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    safe = F.when(F.isnan(norm) | (norm == F.lit(float("inf"))) | (norm == 0), F.lit(1.0)).otherwise(norm)
    return F.transform(v, lambda x: x / safe)
