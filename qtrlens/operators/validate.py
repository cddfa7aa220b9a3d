"""Validation and reporting (V1–V7).

Checks are computed as aggregates in one pass over their inputs. Two global
totals are combined by a tagged union and one conditional aggregate, never by
a cross join. Check results are a long table ``(check, ok)`` so any number of
checks can be combined with ``unionByName``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .churn import CORE, churn_predicates, period_compare

# ---------------------------------------------------------------- fixed values
MSG_TOTALS_MATCH = "Totals match"
MSG_TOTALS_MISMATCH = "Total mismatch"
MSG_CHURN_SANE = "Churn report sane"
MSG_CHURN_NEGATIVE = "Negative revenue in churn report"
ACTION_RETRY = ("retry_aggregation", "sum mismatch")
ACTION_RECOMPUTE = ("recompute_churn", "reconciliation failed")
ACTION_ACCEPT = ("accept", "all checks passed")
ABS_TOL = 1e-6
# -----------------------------------------------------------------------------


def _two_totals(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> tuple[DataFrame, bool]:
    """One row ``(a_total, b_total)`` from one pass over a tagged union, and
    whether both are exact.

    Decimal columns are summed and compared as they are. A floating-point
    column is summed as ``decimal(38,6)``, so that the total does not depend
    on the order of summation."""
    kinds = [df.schema[c].dataType for df, c in ((a, a_col), (b, b_col))]
    exact = all(isinstance(k, (T.DecimalType, T.LongType, T.IntegerType)) for k in kinds)
    typ = T.DecimalType(38, max([k.scale for k in kinds if isinstance(k, T.DecimalType)], default=0)) if exact \
        else T.DecimalType(38, 6)
    u = (a.select(F.col(a_col).cast(typ).alias("v"), F.lit(0).alias("side"))
          .unionByName(b.select(F.col(b_col).cast(typ).alias("v"), F.lit(1).alias("side"))))
    return u.agg(*[F.coalesce(F.sum(F.when(F.col("side") == k, F.col("v"))), F.lit(0)).alias(n)
                   for k, n in ((0, "a_total"), (1, "b_total"))]), exact


def _equal(exact: bool) -> Column:
    """Decimals must agree to the last digit; totals of floating-point input
    within the absolute tolerance."""
    gap = F.abs(F.col("a_total") - F.col("b_total"))
    return gap == 0 if exact else gap <= F.lit(ABS_TOL).cast("decimal(38,6)")


def totals_match(input_df: DataFrame, agg_df: DataFrame, input_col: str = "Revenue",
                 agg_col: str = "TotalRevenue") -> DataFrame:
    """V1: ``(ok, input_total, agg_total, message)``. The input total is over
    every input row, so rows an aggregate dropped (null keys) show up here."""
    t, exact = _two_totals(input_df, input_col, agg_df, agg_col)
    ok = _equal(exact)
    msg = F.when(ok, F.lit(MSG_TOTALS_MATCH)).otherwise(F.concat(
        F.lit(MSG_TOTALS_MISMATCH + ": input="), F.col("a_total").cast("string"),
        F.lit(" agg="), F.col("b_total").cast("string")))
    return t.select(ok.alias("ok"), F.col("a_total").cast("double").alias("input_total"),
                    F.col("b_total").cast("double").alias("agg_total"), msg.alias("message"))


def validate_quarterly(original_df: DataFrame, quarterly_df: DataFrame) -> DataFrame:
    """V2: ``(ok, total_original, total_aggregated, difference)``."""
    t, exact = _two_totals(original_df, "Revenue", quarterly_df, "TotalRevenue")
    return t.select(_equal(exact).alias("ok"),
                    F.col("a_total").cast("double").alias("total_original"),
                    F.col("b_total").cast("double").alias("total_aggregated"),
                    (F.col("a_total") - F.col("b_total")).cast("double").alias("difference"))


def churn_sane(counts: DataFrame) -> DataFrame:
    """V3: one row ``(ok, message)`` — no pair has a negative loss or gain."""
    good = (F.col("revenue_loss") >= 0) & (F.col("revenue_gain") >= 0)
    ok = F.coalesce(F.bool_and(good), F.lit(True))
    return counts.agg(ok.alias("ok")).select(
        "ok", F.when(F.col("ok"), F.lit(MSG_CHURN_SANE)).otherwise(F.lit(MSG_CHURN_NEGATIVE)).alias("message"))


def churn_reconciles(df: DataFrame, client_col: str = "ClientID") -> DataFrame:
    """V4: per pair, clients active in either quarter against lost + new +
    retained under the core rule. A client with prev > 0 and curr < 0 is in
    none of the three, so the pair does not reconcile."""
    al = period_compare(df, client_col)
    lost, new = churn_predicates(CORE)
    p, c = F.col("prev_revenue"), F.col("curr_revenue")
    g = al.groupBy("prev_quarter", "curr_quarter").agg(
        F.count_if((p > 0) | (c > 0)).alias("total_clients"),
        (F.count_if(lost) + F.count_if(new) + F.count_if((p > 0) & (c > 0))).alias("computed"))
    return g.select("prev_quarter", "curr_quarter", "total_clients",
                    (F.col("total_clients") == F.col("computed")).alias("reconciles"))


def check_result(name: str, checks: DataFrame, ok_col: str = "ok") -> DataFrame:
    """Fold a check's rows into one ``(check, ok)`` row; no rows means ok."""
    return checks.agg(F.coalesce(F.bool_and(F.col(ok_col)), F.lit(True)).alias("ok")).select(
        F.lit(name).alias("check"), "ok")


def validation_actions(checks: DataFrame) -> DataFrame:
    """V5: ``(action, reason)`` rows from a ``(check, ok)`` table with checks
    named ``quarterly`` and ``churn``; a missing check counts as passed."""
    flags = checks.agg(
        F.coalesce(F.bool_and(F.when(F.col("check") == "quarterly", F.col("ok"))), F.lit(True)).alias("q_ok"),
        F.coalesce(F.bool_and(F.when(F.col("check") == "churn", F.col("ok"))), F.lit(True)).alias("c_ok"))

    def act(pair):
        return F.struct(F.lit(pair[0]).alias("action"), F.lit(pair[1]).alias("reason"))

    acts = F.filter(F.array(F.when(~F.col("q_ok"), act(ACTION_RETRY)),
                            F.when(~F.col("c_ok"), act(ACTION_RECOMPUTE))), lambda x: x.isNotNull())
    acts = F.when(F.size(acts) == 0, F.array(act(ACTION_ACCEPT))).otherwise(acts)
    return flags.select(F.explode(acts).alias("a")).select("a.action", "a.reason")


def check_output_contract(df: DataFrame, contract: T.StructType) -> list[tuple[str, str]]:
    """V6: compare ``df.schema`` with a contract. Returns ``(field, problem)``
    pairs for missing fields and type mismatches — schema metadata only, so
    nothing is computed on the data."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in contract.fields:
        if f.name not in have:
            out.append((f.name, "missing"))
        elif not _compatible(have[f.name], f.dataType):
            out.append((f.name, f"type {have[f.name].simpleString()} is not {f.dataType.simpleString()}"))
    return out


def _compatible(got: T.DataType, want: T.DataType) -> bool:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(want, (T.DoubleType, T.FloatType)):
        return isinstance(got, num)  # JSON "number"
    if isinstance(want, integral):
        return isinstance(got, integral)  # JSON "integer"
    return type(got) is type(want)


# Row model (fixed values): the five fields every revenue row must carry.
ROW_RULES = ["ClientID", "Region", "Country", "Date", "Revenue"]


def check_row_contract(df: DataFrame) -> DataFrame:
    """V7: add ``violations array<string>`` listing every broken rule: a
    required text field null or blank, a date that does not parse, revenue
    text that is not a number, or a number that the feed's money type cannot
    hold exactly (infinite, too large, too many decimals). What has no Date or
    out-of-range violation is what ``coerce_feed`` accepts."""
    from ..functions.columns import NUMBER_TEXT, parse_date
    from ..sources.readers import money

    checks = []
    for c in ["ClientID", "Region", "Country"]:
        bad = F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
        checks.append(F.when(bad, F.lit(f"{c}:required")))
    checks.append(F.when(parse_date("Date").isNull(), F.lit("Date:invalid")))
    rev_txt = F.trim(F.col("Revenue").cast("string"))
    checks.append(F.when(rev_txt.isNull() | ~rev_txt.rlike(NUMBER_TEXT), F.lit("Revenue:not_a_number")))
    checks.append(F.when(money("Revenue").isNull(), F.lit("Revenue:out_of_range")))
    v = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn("violations", v)


def contract_violations(tables: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """V6 as a table: ``(table, field, problem)`` for every output checked
    against its contract (schema metadata only)."""
    rows = [(name, field, problem) for name, (df, contract) in tables.items()
            for field, problem in check_output_contract(df, contract)]
    spark = next(iter(tables.values()))[0].sparkSession
    return spark.createDataFrame(rows, "table string, field string, problem string")


# Bundle contract (fixed values): what a section's entry must be, and the
# fields a churn entry must have.
SECTION_SHAPES = {"quarterly": "array", "pivot": "object", "validations": "object", "churn_report": "object", "plan": "object"}
CHURN_FIELDS = {"revenue_loss": "number", "revenue_gain": "number", "lost_customers": "integer", "new_customers": "integer"}


def _json_type(v):
    """JSON type name of a VARIANT (null where there is none)."""
    kind = F.schema_of_variant(v)
    return (F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "BIGINT", "integer")
            .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "number").when(kind == "STRING", "string")
            .when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null"))


def bundle_violations(bundle: DataFrame) -> DataFrame:
    """V6: an exported bundle (``section, key, json``) held against its
    contract, one row per violation: ``(section, key, field, problem)``. Each
    entry's text is parsed once as VARIANT. A text that is no JSON, an entry
    of the wrong shape, a churn field that is missing or of the wrong type
    (an integer is a number too), and a required section without any entry
    (null key) are violations; an unknown section is not."""
    parsed = bundle.select("section", "key", F.expr("try_parse_json(json)").alias("v"))
    shape = F.create_map(*[F.lit(x) for p in SECTION_SHAPES.items() for x in p])[F.col("section")]
    is_object = _json_type(F.col("v")) == "object"
    broken = [F.when(F.col("v").isNull(), F.struct(F.lit(None).cast("string").alias("field"), F.lit("not JSON").alias("problem"))),
              F.when(_json_type(F.col("v")) != shape, F.struct(F.lit(None).cast("string").alias("field"),
                                                              F.concat(F.lit("not an "), shape).alias("problem")))]
    for field, want in CHURN_FIELDS.items():
        got = _json_type(F.variant_get("v", f"$.{field}", "variant"))
        fits = got.isin("integer", "number") if want == "number" else got == "integer"
        problem = F.when(got.isNull(), "missing").when(~fits, f"not {'a' if want == 'number' else 'an'} {want}")
        broken.append(F.when((F.col("section") == "churn_report") & is_object & problem.isNotNull(),
                             F.struct(F.lit(field).alias("field"), problem.alias("problem"))))
    found = parsed.select("section", "key", F.explode(F.filter(F.array(*broken), lambda x: x.isNotNull())).alias("x")) \
        .select("section", "key", "x.field", "x.problem")
    from ..schemas import BUNDLE_REQUIRED
    spark = bundle.sparkSession
    wanted = spark.createDataFrame([(x,) for x in BUNDLE_REQUIRED], "section string")
    none = F.lit(None).cast("string")
    absent = wanted.join(bundle.select("section").distinct(), "section", "left_anti").select(
        "section", none.alias("key"), none.alias("field"), F.lit("section is missing").alias("problem"))
    return found.unionByName(absent)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V7: (valid rows, quarantined rows with their violations)."""
    checked = check_row_contract(df)
    return (checked.where(F.size("violations") == 0).drop("violations"),
            checked.where(F.size("violations") > 0))
