"""Declared schemas of the stored tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY = T.StructType([
    T.StructField("entity_id", T.LongType(), False),
    T.StructField("external_id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2), False),
    T.StructField("released", T.DateType()),
    T.StructField("maker", T.StringType()),
    T.StructField("publisher", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType(), False),
    T.StructField("updated_at", T.TimestampNTZType(), False),
])

CATEGORY = T.StructType([
    T.StructField("category_id", T.LongType(), False),
    T.StructField("category_name", T.StringType(), False),
])

BRIDGE = T.StructType([
    T.StructField("entity_id", T.LongType(), False),
    T.StructField("category_id", T.LongType(), False),
])

SNAPSHOT = T.StructType([
    T.StructField("snapshot_id", T.LongType(), False),
    T.StructField("entity_id", T.LongType(), False),
    T.StructField("current_count", T.LongType(), False),
    T.StructField("peak_count", T.LongType(), False),
    T.StructField("total_ratings", T.LongType(), False),
    T.StructField("recorded_at", T.TimestampNTZType(), False),
])

RATING = T.StructType([
    T.StructField("rating_id", T.LongType(), False),
    T.StructField("entity_id", T.LongType(), False),
    T.StructField("positive", T.LongType(), False),
    T.StructField("negative", T.LongType(), False),
    T.StructField("positive_pct", T.DecimalType(5, 2), False),
    T.StructField("label", T.StringType()),
])

# One row per statement.
AUDIT = T.StructType([
    T.StructField("audit_id", T.LongType(), False),
    T.StructField("database_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("logged_at", T.TimestampNTZType(), False),
    T.StructField("user_name", T.StringType(), False),
    T.StructField("rows_before", T.LongType(), False),
    T.StructField("rows_after", T.LongType(), False),
    T.StructField("changed_fields", T.StringType()),
])

# One row per row that a statement touched.
AUDIT_ROW = T.StructType([
    T.StructField("audit_id", T.LongType(), False),
    T.StructField("database_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("logged_at", T.TimestampNTZType(), False),
    T.StructField("user_name", T.StringType(), False),
    T.StructField("row_key", T.StringType(), False),
    T.StructField("operation", T.StringType(), False),
    T.StructField("before_row", T.StringType()),
    T.StructField("after_row", T.StringType()),
    T.StructField("changed_fields", T.StringType()),
])

# A bad document may not tell which item it is about.
QUARANTINE = T.StructType([
    T.StructField("external_id", T.LongType()),
    T.StructField("polled_at", T.TimestampNTZType(), False),
    T.StructField("reasons", T.StringType(), False),
])

# One raw answer of a feed, as the fetcher leaves it in the landing folder.
LANDED = T.StructType([
    T.StructField("polled_at", T.TimestampNTZType(), False),
    T.StructField("feed", T.StringType(), False),
    T.StructField("external_id", T.LongType()),
    T.StructField("body", T.StringType(), False),
])

# The rating labels that may be stored.
RATING_LABELS = (
    "Overwhelmingly Positive",
    "Very Positive",
    "Positive",
    "Mostly Positive",
    "Mixed",
    "Mostly Negative",
    "Negative",
    "Very Negative",
    "Overwhelmingly Negative",
)
