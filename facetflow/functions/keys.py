"""Identity keys of a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetflow.functions.text import blank_to_null

# Bucket widths of the geometry key.
CARAT_STEP = 0.01
LENGTH_STEP = 0.02

GEOMETRY_COLUMNS = ["carat", "length_mm", "width_mm", "depth_mm"]


def certificate_digits(c: Column) -> Column:
    """All digits of the certificate text if there are 6 to 12, else ""."""
    digits = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits).between(6, 12), digits).otherwise(F.lit(""))


def listing_key(df: DataFrame) -> Column:
    """``CERT:lab:digits``, else ``SKU:vendor:sku``, else ``URL:vendor:url``."""

    def text(name):
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    digits = certificate_digits(text("cert_number"))
    lab = F.coalesce(F.upper(blank_to_null(text("cert_lab"))), F.lit("UNK"))
    vendor = F.coalesce(text("vendor"), F.lit("UNK"))
    sku = blank_to_null(text("sku_or_stock"))
    return (
        F.when(digits != "", F.concat(F.lit("CERT:"), lab, F.lit(":"), digits))
        .when(sku.isNotNull(), F.concat(F.lit("SKU:"), vendor, F.lit(":"), sku))
        .otherwise(
            F.concat(
                F.lit("URL:"), vendor, F.lit(":"), F.coalesce(text("source_url"), F.lit(""))
            )
        )
    )


def dedupe_certificate(cert_lab: Column, cert_number: Column) -> Column:
    """``lab|digits`` from the first run of 6 to 10 digits; null when there is none."""
    digits = F.regexp_extract(cert_number, "([0-9]{6,10})", 1)
    lab = F.when(cert_lab.isin("", "NAN"), None).otherwise(cert_lab)
    key = F.concat(F.coalesce(lab, F.lit("UNK")), F.lit("|"), digits)
    return F.when(F.length(digits) > 0, key)


def step_bucket(c: Column, step: float) -> Column:
    """Index of the nearest step, halves to even."""
    return F.rint(c / F.lit(step)).cast("long")


def geometry_buckets() -> dict[str, Column]:
    return {
        "carat_step": step_bucket(F.col("carat"), CARAT_STEP),
        "length_step": step_bucket(F.col("length_mm"), LENGTH_STEP),
        "width_step": step_bucket(F.col("width_mm"), LENGTH_STEP),
        "depth_step": step_bucket(F.col("depth_mm"), LENGTH_STEP),
    }
