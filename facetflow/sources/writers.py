"""Writers. Tables are Parquet; reports are one-row nested frames written as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetflow.functions.keys import listing_key
from facetflow.schema import HISTORY_SCHEMA, LISTING_COLUMNS
from facetflow.sources.readers import feed_folder

# The batch id of runs that are written whole; streamed batches count from 0.
WHOLE_RUN = -1

# Columns of the anomaly report.
ANOMALY_COLUMNS = [
    "vendor",
    "listing_key",
    "source_url",
    "price_usd",
    "median",
    "z_score",
    "drop_pct_vs_median",
    "is_potentially_undervalued",
    "scraped_at",
]


def stamp(batch: DataFrame, run_id: str, scraped_at) -> DataFrame:
    """Add the listing key, the run and one time for the whole batch.

    The time is an argument, so that running a run again gives the same rows.
    """
    feed = F.col("feed") if "feed" in batch.columns else F.col("vendor")
    return batch.withColumns(
        {
            "feed": feed,
            "listing_key": listing_key(batch),
            "scraped_at": F.lit(scraped_at).cast("timestamp"),
            "run_id": F.lit(run_id),
        }
    ).select(*HISTORY_SCHEMA.fieldNames())


def append_history(batch: DataFrame, path: str, run_id: str | None = None) -> None:
    """Write the run partitions of a stamped batch; a repeated run replaces itself.

    With ``run_id`` everything the history has of that run goes first, so a
    repeated run may also come back empty. Without it the runs in the batch are
    written, and others are not touched. The layout is that of streamed batches.
    """
    rows = batch.withColumn("batch_id", F.lit(WHOLE_RUN))
    if run_id is None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_id", "batch_id").parquet(path)
        return
    own = rows.where(F.col("run_id") == run_id).drop("run_id")
    writer = own.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("batch_id").parquet(f"{path}/run_id={run_id}")


def write_batch(listings: DataFrame, raw_path: str, feed: str) -> None:
    """One feed of a run: the canonical columns under ``feed=<folder of the name>``."""
    listings.select(*LISTING_COLUMNS).write.mode("overwrite").parquet(f"{raw_path}/feed={feed_folder(feed)}")


def write_clean(listings: DataFrame, path: str, csv_path: str | None = None) -> None:
    listings.write.mode("overwrite").parquet(path)
    if csv_path:
        copy = listings.sparkSession.read.parquet(path)
        copy.write.mode("overwrite").option("header", True).option("escape", '"').csv(csv_path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_log(log: DataFrame, path: str) -> None:
    """The extraction log, one JSON line per listing."""
    log.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_anomalies(mispriced: DataFrame, path: str) -> None:
    """The report columns that exist, with a header even when there is no row."""
    present = [c for c in ANOMALY_COLUMNS if c in mispriced.columns]
    mispriced.select(*present).write.mode("overwrite").option("header", True).csv(path)


def write_attribution(attribution: DataFrame, path: str) -> None:
    """The columns of a model by importance, ``rank`` from 1; one row per column, so one window orders them."""
    order = Window.orderBy(F.col("mean_abs_contribution").desc(), "feature")
    ranked = attribution.withColumn("rank", F.row_number().over(order)).orderBy("rank")
    ranked.write.mode("overwrite").option("header", True).csv(path)
