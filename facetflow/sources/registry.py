"""The list of sources and the rule on how many must be active."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetflow.operators.gates import GateFailed

# Known sources, whether they are read, and why not.
SOURCES = [
    ("BlueNile", "table", True, ""),
    ("Leibish", "label", True, ""),
    ("JamesAllen", "empty", False, "Blocked by bot protection / CAPTCHA"),
    ("Ritani", "empty", False, "No natural yellow inventory"),
]
MIN_ACTIVE_SOURCES = 3

REGISTRY_SCHEMA = "name string, layout string, active boolean, reason string"


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, REGISTRY_SCHEMA)


def active_sources(sources: DataFrame) -> DataFrame:
    return sources.where("active")


def source_policy(sources: DataFrame, minimum: int = MIN_ACTIVE_SOURCES) -> DataFrame:
    """One row: active and known sources, and whether enough are active."""
    return sources.agg(
        F.count("*").alias("known_sources"),
        F.count_if("active").alias("active_sources"),
        F.lit(minimum).cast("long").alias("required_sources"),
        (F.count_if("active") >= minimum).alias("passes"),
    )


def enforce_source_policy(sources: DataFrame, minimum: int = MIN_ACTIVE_SOURCES) -> None:
    row = source_policy(sources, minimum).first()
    if not row["passes"]:
        raise GateFailed(
            "failed_source_policy", f"{row['active_sources']} active sources, {minimum} required"
        )
