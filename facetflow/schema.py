"""The listing record: one fixed set of columns shared by every vendor."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical listing columns, in order, with their Spark types.
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("vendor", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("sku_or_stock", T.StringType()),
        T.StructField("date_seen", T.DateType()),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("carat", T.DoubleType()),
        T.StructField("fancy_color_primary", T.StringType()),
        T.StructField("fancy_color_modifier", T.StringType()),
        T.StructField("intensity", T.StringType()),
        T.StructField("clarity", T.StringType()),
        T.StructField("shape", T.StringType()),
        T.StructField("polish", T.StringType()),
        T.StructField("symmetry", T.StringType()),
        T.StructField("fluorescence", T.StringType()),
        T.StructField("length_mm", T.DoubleType()),
        T.StructField("width_mm", T.DoubleType()),
        T.StructField("depth_mm", T.DoubleType()),
        T.StructField("table_pct", T.DoubleType()),
        T.StructField("depth_pct", T.DoubleType()),
        T.StructField("girdle", T.StringType()),
        T.StructField("culet", T.StringType()),
        T.StructField("l_w_ratio", T.DoubleType()),
        T.StructField("measurements", T.StringType()),
        T.StructField("cert_lab", T.StringType()),
        T.StructField("cert_number", T.StringType()),
        T.StructField("is_natural", T.BooleanType()),
        T.StructField("is_lab_grown", T.BooleanType()),
        T.StructField("in_stock", T.BooleanType()),
    ]
)

LISTING_COLUMNS = LISTING_SCHEMA.fieldNames()

NUMERIC_COLUMNS = [f.name for f in LISTING_SCHEMA if isinstance(f.dataType, T.DoubleType)]
BOOLEAN_COLUMNS = [f.name for f in LISTING_SCHEMA if isinstance(f.dataType, T.BooleanType)]
TITLE_CASE_COLUMNS = ["intensity", "shape"]
UPPER_CASE_COLUMNS = ["clarity", "cert_lab"]

HISTORY_SCHEMA = T.StructType(
    LISTING_SCHEMA.fields
    + [
        T.StructField("feed", T.StringType()),
        T.StructField("listing_key", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)

TEXT_LISTING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in LISTING_COLUMNS])
