"""Completeness and quality of a batch of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetflow.functions.text import blank_to_null, guarded_ratio

# Columns a usable listing must have.
REQUIRED = ["price_usd", "carat", "intensity", "clarity", "shape", "vendor", "source_url"]


def _share(flag: Column) -> Column:
    return F.coalesce(F.avg(flag.cast("int")), F.lit(0.0))


def quality_report(df: DataFrame) -> DataFrame:
    """One nested row: rows, rows per vendor, completeness, joint parse rate, gaps.

    Counts are taken per vendor in one scan and added up; only the vendor table
    is gathered into the map.
    """
    present = {c: F.count(c).alias(f"_has_{c}") for c in REQUIRED}
    both = F.col("price_usd").isNotNull() & F.col("carat").isNotNull()
    per_vendor = df.groupBy(F.coalesce("vendor", F.lit("Unknown")).alias("_vendor")).agg(
        F.count("*").alias("_n"), F.count_if(both).alias("_both"), *present.values()
    )
    rows = F.coalesce(F.sum("_n"), F.lit(0))

    def rate(name):
        return guarded_ratio(F.sum(name), F.sum("_n"))

    return per_vendor.agg(
        rows.alias("row_count"),
        F.map_from_entries(F.collect_list(F.struct("_vendor", "_n"))).alias("vendor_counts"),
        F.struct(*[rate(f"_has_{c}").alias(c) for c in REQUIRED]).alias("required_completeness"),
        rate("_both").alias("joint_parse_rate"),
        (rows - F.coalesce(F.sum("_has_price_usd"), F.lit(0))).alias("missing_price_rows"),
        (rows - F.coalesce(F.sum("_has_carat"), F.lit(0))).alias("missing_carat_rows"),
    )


def vendor_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce("vendor", F.lit("Unknown")).alias("vendor")).agg(
        F.count("*").alias("rows")
    )


def quality_measures(df: DataFrame) -> list[Column]:
    """Row count and the four rates of a batch; a missing column counts as all null."""

    def has(name, present):
        return _share(present) if name in df.columns else F.lit(0.0)

    price = has("price_usd", F.col("price_usd").isNotNull())
    carat = has("carat", F.col("carat").isNotNull())
    if "cert_number" in df.columns:
        cert = _share(blank_to_null(F.col("cert_number")).isNotNull())
    else:
        cert = F.lit(0.0)
    return [
        F.count("*").alias("rows"),
        price.alias("price_present_rate"),
        carat.alias("carat_present_rate"),
        ((price + carat) / 2).alias("mean_parse_rate"),
        cert.alias("cert_present_rate"),
    ]


def summarize_batch(df: DataFrame) -> DataFrame:
    """One row: the rates of a whole batch, zeros when it is empty."""
    return df.agg(*quality_measures(df))


def summarize_feeds(batch: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """The rates per feed; feeds that were requested but sent nothing get zeros."""
    per_feed = batch.groupBy("feed").agg(*quality_measures(batch))
    if requested is None:
        return per_feed
    joined = requested.select("feed").distinct().join(per_feed, "feed", "left")
    return joined.na.fill(0).na.fill(0.0)


def weighted_quality(per_feed: DataFrame) -> DataFrame:
    """Certificate and parse rates of the feeds, weighted by their rows."""

    def weighted(rate):
        return guarded_ratio(F.sum(F.col("rows") * F.col(rate)), F.sum("rows"))

    return per_feed.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        weighted("cert_present_rate").alias("weighted_cert_present_rate"),
        weighted("mean_parse_rate").alias("weighted_parse_success_rate"),
    )


def named_vendors(batch: DataFrame) -> DataFrame:
    """Rows per vendor, blank and null vendors left out."""
    if "vendor" not in batch.columns:
        return batch.select(F.lit("").alias("vendor")).where("false").groupBy("vendor").agg(
            F.count("*").alias("rows")
        )
    vendor = blank_to_null(F.col("vendor"))
    return batch.where(vendor.isNotNull()).groupBy(vendor.alias("vendor")).agg(
        F.count("*").alias("rows")
    )


def active_vendors(batch: DataFrame) -> DataFrame:
    return named_vendors(batch).agg(F.count("*").alias("active_vendor_count"))


def largest(name: str, rows: str) -> Column:
    """Name with the most rows; the first in order among equals."""
    return F.min_by(name, F.struct(-F.col(rows), F.col(name)))


def dominant_vendor(batch: DataFrame) -> DataFrame:
    """One row: the largest vendor and its share, null and 0.0 for no vendor."""
    return named_vendors(batch).agg(
        largest("vendor", "rows").alias("dominant_vendor"),
        guarded_ratio(F.max("rows"), F.sum("rows")).alias("dominant_vendor_share"),
    )
