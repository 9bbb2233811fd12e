"""Merge feeds into one clean table with a quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from facetflow.operators.dedupe import dedupe
from facetflow.operators.quality import quality_report
from facetflow.session import small_pieces
from facetflow.sources import registry
from facetflow.sources.readers import read_present
from facetflow.sources.writers import write_clean, write_report


def merge_and_clean(
    spark: SparkSession,
    inputs: list[str],
    clean_path: str,
    report_path: str | None = None,
    csv_path: str | None = None,
    sources: DataFrame | None = None,
    missing_geometry: str = "merge",
) -> DataFrame:
    """Read, standardise, deduplicate and write; returns the quality report.

    Rows before and after are counted by the job that writes the table. With
    ``sources`` the source policy is enforced first.
    """
    if sources is not None:
        registry.enforce_source_policy(sources)
    before, after = Observation(), Observation()
    merged = read_present(spark, inputs).observe(before, F.count("*").alias("rows"))
    clean = dedupe(merged, missing_geometry).observe(after, F.count("*").alias("rows"))
    with small_pieces(spark):
        write_clean(clean, clean_path, csv_path)
    counts = {"rows_read": before.get["rows"], "rows_kept": after.get["rows"]}
    report = quality_report(spark.read.parquet(clean_path))
    report = report.withColumns({k: F.lit(v).cast("bigint") for k, v in counts.items()})
    if report_path:
        write_report(report, report_path)
        report = spark.read.schema(report.schema).json(report_path)
    return report
