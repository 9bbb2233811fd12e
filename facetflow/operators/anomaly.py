"""Price anomalies: the latest price of a listing against its own history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.functions import text
from facetflow.operators.quantiles import group_quantiles, listed_quantiles
from facetflow.session import write_out

# Default thresholds.
Z_THRESHOLD = 2.5
MIN_POINTS = 5
DROP_SHARE = 0.2

# Points of a listing that one task may hold; only the plan depends on it.
LISTED = 10_000


def valid_history(history: DataFrame) -> DataFrame:
    """Rows with a numeric price, a listing key and a time."""
    df = history
    if not isinstance(df.schema["price_usd"].dataType, T.NumericType):
        df = df.withColumn("price_usd", text.to_number(F.col("price_usd")))
    else:
        price = F.col("price_usd").cast("double")
        df = df.withColumn("price_usd", F.when(~F.isnan(price), price))
    if isinstance(df.schema["scraped_at"].dataType, T.StringType):
        df = df.withColumn("scraped_at", F.col("scraped_at").try_cast("timestamp"))
    return df.dropna(subset=["price_usd", "listing_key", "scraped_at"])


def price_stats(history: DataFrame) -> DataFrame:
    """Count, exact median and sample deviation of the price per listing."""
    rows = valid_history(history)
    stats = rows.groupBy("listing_key").agg(
        F.count("*").alias("count"), F.stddev_samp("price_usd").alias("std")
    )
    medians = group_quantiles(rows, ["listing_key"], "price_usd", 0.5)
    return stats.join(medians.withColumnRenamed("quantile", "median"), "listing_key")


def _order() -> list[Column]:
    """Undervalued listings first, then by deviation."""
    return [F.desc("is_potentially_undervalued"), F.asc_nulls_last("z_score"), F.asc("listing_key")]


def detect_mispriced(
    history: DataFrame,
    z_threshold: float = Z_THRESHOLD,
    min_points: int = MIN_POINTS,
    drop_share: float = DROP_SHARE,
    ordered: bool = True,
    written: bool = False,
) -> DataFrame:
    """Every listing with enough points: its latest row, statistics and flags.

    The latest row, count and deviation of a listing are constant-size partial
    aggregates and the exact median comes from counts (see ``quantiles``), so no
    task ever holds the points of a hot listing. With ``written`` the listings
    with enough points are written at once and medians sought for them alone:
    up to ``LISTED`` points from their sorted list, beyond that from counts.
    """
    rows = valid_history(history)
    carried = [c for c in rows.columns if c != "listing_key"]
    ties = [F.col(c) for c in ("source_url", "vendor", "run_id") if c in rows.columns]
    newest = F.struct("scraped_at", *ties, "price_usd", F.xxhash64(*carried))
    summary = {
        "count": F.count("*"),
        "std": F.stddev_samp("price_usd"),
        "_latest": F.max_by(F.struct(*carried), newest),
    }
    grouped = rows.groupBy("listing_key").agg(*[c.alias(n) for n, c in summary.items()])
    grouped = grouped.where(F.col("count") >= min_points)
    if written:
        grouped = write_out(grouped, "listings")
        medians = _medians(rows, grouped)
    else:
        medians = group_quantiles(rows, ["listing_key"], "price_usd", 0.5)
    grouped = grouped.join(medians.withColumnRenamed("quantile", "median"), "listing_key")

    price = F.col("price_usd")
    out = grouped.select("listing_key", "_latest.*", "count", "median", "std")
    out = out.withColumns(
        {
            "z_score": (price - F.col("median")) / F.nullif(F.col("std"), F.lit(0.0)),
            "drop_pct_vs_median": (F.col("median") - price)
            / F.nullif(F.col("median"), F.lit(0.0)),
        }
    )
    out = out.withColumns(
        {
            "is_mispriced": F.coalesce(F.abs("z_score") >= z_threshold, F.lit(False)),
            "is_potentially_undervalued": F.coalesce(
                F.col("drop_pct_vs_median") >= drop_share, F.lit(False)
            ),
        }
    )
    return in_order(out) if ordered else out


def in_order(mispriced: DataFrame) -> DataFrame:
    return mispriced.orderBy(*_order())


def _medians(rows: DataFrame, grouped: DataFrame) -> DataFrame:
    """``listing_key, quantile``: the median price of the listings in ``grouped``.

    Hot listings are written, so that Spark knows how few they are and takes
    their rows out before any row is shuffled by its listing.
    """
    points = rows.select("listing_key", "price_usd")
    hot = write_out(grouped.where(F.col("count") > LISTED).select("listing_key"), "hot")
    few = points.join(hot, "listing_key", "left_anti").join(grouped.select("listing_key"), "listing_key", "left_semi")
    medians = listed_quantiles(few, ["listing_key"], "price_usd", 0.5)
    if hot.isEmpty():
        return medians
    many = points.join(hot, "listing_key", "left_semi")
    return medians.unionByName(group_quantiles(many, ["listing_key"], "price_usd", 0.5))


def ranked(mispriced: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of the report with their ``rank`` from 1."""
    first = mispriced.orderBy(*_order()).limit(top)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*_order())).cast("long"))


def flag_counts(mispriced: DataFrame) -> DataFrame:
    """Listings examined, and how many carry each flag."""
    return mispriced.agg(
        F.count("*").alias("examined"),
        F.count_if("is_mispriced").alias("mispriced"),
        F.count_if("is_potentially_undervalued").alias("undervalued"),
    )
