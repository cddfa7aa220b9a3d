"""Explicit schemas and output contracts. Nothing here is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Order prices of the table store (two decimals by that schema).
MONEY = T.DecimalType(18, 2)
# Revenue read from text: 28 digits before and 10 after the point; a number
# that does not fit exactly is rejected, never rounded.
FEED_MONEY = T.DecimalType(38, 10)

# Long revenue feed after coercion.
REVENUE = T.StructType([
    T.StructField("ClientID", T.StringType()),
    T.StructField("Region", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Revenue", FEED_MONEY),
])

# Column order of the long layout produced from a wide sheet (fixed values).
WIDE_OUTPUT_COLUMNS = ["Client ID", "Country", "Region", "Date", "Revenue"]

# Churn record, count form (one row per consecutive pair).
CHURN_COUNTS = T.StructType([
    T.StructField("prev_quarter", T.StringType()),
    T.StructField("curr_quarter", T.StringType()),
    T.StructField("lost_customers", T.LongType()),
    T.StructField("new_customers", T.LongType()),
    T.StructField("revenue_loss", T.DoubleType()),
    T.StructField("revenue_gain", T.DoubleType()),
    T.StructField("total_prev_revenue", T.DoubleType()),
    T.StructField("total_curr_revenue", T.DoubleType()),
])

# Sections an output bundle must have (fixed values).
BUNDLE_REQUIRED = ["plan", "quarterly", "pivot", "churn_report", "validations"]

# Vector index entry.
INDEX_ENTRY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("vec", T.ArrayType(T.DoubleType())),
    T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
])
