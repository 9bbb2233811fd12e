"""Metrics over the run history: growth, coverage, diversity.

Every table here has one row per run. Run ids are UTC times in text, so their
order is the order of the runs. Windows without a partition run over these
run tables only, never over listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetflow.functions.text import blank_to_null, guarded_ratio
from facetflow.operators.quality import largest

def _in_order():
    return Window.orderBy("run_id")


EXPANSION = [
    "baseline_run_id",
    "current_unique_listings",
    "baseline_unique_listings",
    "listing_coverage_multiple",
    "current_unique_certs",
    "baseline_unique_certs",
    "cert_coverage_multiple",
]


def run_rows(history: DataFrame) -> DataFrame:
    return (
        history.where(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(F.count("*").alias("current_rows"))
    )


def run_growth(history: DataFrame) -> DataFrame:
    """Rows of every run against the run before it."""
    return with_growth(run_rows(history))


def with_growth(runs: DataFrame) -> DataFrame:
    """Add the previous run and the change to a table of ``run_id, current_rows``."""
    before = F.lag("current_rows").over(_in_order())
    delta = F.col("current_rows") - F.col("previous_rows")
    first = F.when(F.col("current_rows") > 0, 1.0).otherwise(0.0)
    return runs.withColumns(
        {
            "previous_run_id": F.lag("run_id").over(_in_order()),
            "previous_rows": F.coalesce(before, F.lit(0)),
        }
    ).withColumns(
        {
            "delta_rows": delta,
            "delta_pct": F.coalesce(F.try_divide(delta, F.nullif("previous_rows", F.lit(0))), first),
        }
    )


def growth_of(history: DataFrame, run_id: str) -> DataFrame:
    """One row for one run id, which need not be in the history."""
    this = F.col("run_id") == run_id
    earlier = F.col("run_id") < run_id
    one = run_rows(history).agg(
        F.max(F.when(earlier, F.col("run_id"))).alias("previous_run_id"),
        F.coalesce(F.max_by("current_rows", F.when(earlier, F.col("run_id"))), F.lit(0)).alias(
            "previous_rows"
        ),
        F.coalesce(F.max(F.when(this, F.col("current_rows"))), F.lit(0)).alias("current_rows"),
    )
    delta = F.col("current_rows") - F.col("previous_rows")
    first = F.when(F.col("current_rows") > 0, 1.0).otherwise(0.0)
    return one.select(
        F.lit(run_id).alias("run_id"),
        "previous_run_id",
        "previous_rows",
        "current_rows",
        delta.alias("delta_rows"),
        F.coalesce(F.try_divide(delta, F.nullif("previous_rows", F.lit(0))), first).alias(
            "delta_pct"
        ),
    )


def run_coverage(history: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct listings and certificates per run.

    Exact counting first groups by run *and* value, so a run that holds a third
    of the rows is spread over all tasks before it is counted.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    columns = history.columns
    no_value = F.lit(0).cast("long")
    listings = distinct(F.col("listing_key")) if "listing_key" in columns else no_value
    certs = (
        distinct(blank_to_null(F.col("cert_number"))) if "cert_number" in columns else no_value
    )
    return (
        history.where(F.col("run_id").isNotNull())
        .groupBy("run_id")
        .agg(
            listings.alias("current_unique_listings"),
            certs.alias("current_unique_certs"),
        )
    )


def run_expansion(history: DataFrame, approximate: bool = False) -> DataFrame:
    """Coverage of every run over that of the first run."""
    first = {
        "baseline_run_id": F.first("run_id").over(_in_order()),
        "baseline_unique_listings": F.first("current_unique_listings").over(_in_order()),
        "baseline_unique_certs": F.first("current_unique_certs").over(_in_order()),
    }
    return run_coverage(history, approximate).withColumns(first).withColumns(_multiples())


def _multiples():
    return {
        "listing_coverage_multiple": guarded_ratio(
            F.col("current_unique_listings"), F.col("baseline_unique_listings")
        ),
        "cert_coverage_multiple": guarded_ratio(
            F.col("current_unique_certs"), F.col("baseline_unique_certs")
        ),
    }


def expansion_of(history: DataFrame, run_id: str, approximate: bool = False) -> DataFrame:
    """One row for one run id; reads only that run and the first one."""
    first = history.agg(F.min("run_id")).first()[0]
    wanted = [r for r in {first, run_id} if r is not None]
    per_run = run_coverage(history.where(F.col("run_id").isin(wanted)), approximate)

    def of(run, name):
        return F.coalesce(F.max(F.when(F.col("run_id") == run, F.col(name))), F.lit(0))

    return per_run.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(first).cast("string").alias("baseline_run_id"),
        of(run_id, "current_unique_listings").alias("current_unique_listings"),
        of(first, "current_unique_listings").alias("baseline_unique_listings"),
        of(run_id, "current_unique_certs").alias("current_unique_certs"),
        of(first, "current_unique_certs").alias("baseline_unique_certs"),
    ).withColumns(_multiples())


def run_diversity(history: DataFrame) -> DataFrame:
    """Per run: rows, active vendors, the dominant vendor and the weighted rates.

    Weighting the rates of the feeds by their rows gives the rate over all rows
    of the run, so one small table of run and vendor carries every measure.
    """
    vendor = blank_to_null(F.col("vendor"))
    per_vendor = (
        history.where(F.col("run_id").isNotNull())
        .groupBy("run_id", vendor.alias("vendor"))
        .agg(
            F.count("*").alias("_n"),
            F.count("price_usd").alias("_priced"),
            _count_if_present(history, "carat"),
            F.count(blank_to_null(F.col("cert_number"))).alias("_certified"),
        )
    )
    named = F.col("vendor").isNotNull()
    named_rows = F.when(named, F.col("_n"))
    parsed = (F.sum("_priced") + F.sum("_weighed")) / 2
    return (
        per_vendor.withColumn("_named", named_rows)
        .groupBy("run_id")
        .agg(
            F.sum("_n").alias("current_rows"),
            F.count("vendor").alias("active_vendor_count"),
            largest("vendor", "_named").alias("dominant_vendor"),
            guarded_ratio(F.max("_named"), F.sum("_named")).alias("dominant_vendor_share"),
            guarded_ratio(F.sum("_certified"), F.sum("_n")).alias("weighted_cert_present_rate"),
            guarded_ratio(parsed, F.sum("_n")).alias("weighted_parse_success_rate"),
        )
    )


def _count_if_present(history: DataFrame, name: str):
    counted = F.count(name) if name in history.columns else F.lit(0).cast("long")
    return counted.alias("_weighed")
