"""One run: take in the feeds, extend the history, measure, judge."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from facetflow.operators import anomaly, gates, quality, runs
from facetflow.session import cut, write_out
from facetflow.sources import readers, writers
from facetflow.sources.readers import Skipped


def collect_feeds(
    spark: SparkSession, tokens: list[str], raw_path: str, import_folder: str
) -> tuple[DataFrame, list[Skipped]]:
    """Standardised rows of all requested feeds.

    ``import:<alias>`` reads a partner file; any other token must be a batch
    that a harvest wrote under ``feed=<token>``.
    """
    feeds = {}
    for token in tokens:
        own = import_folder if readers.import_alias(token) is not None else f"{raw_path}/feed={readers.feed_folder(token)}/*.parquet"
        feeds[token] = own
    rows, skipped = readers.read_run(spark, feeds)
    if rows is None:
        rows = readers.header_only(spark).withColumn("feed", F.lit(""))
    return rows, skipped


def run(
    spark: SparkSession,
    batch: DataFrame,
    run_id: str,
    scraped_at,
    history_path: str,
    output: str,
    tokens: list[str] | None = None,
    skipped: list[Skipped] | None = None,
    limits: gates.Thresholds = gates.Thresholds(),
    required: gates.Required = gates.Required(),
    enforce: bool = True,
) -> DataFrame:
    """Append the batch, write anomalies and the summary, then enforce the gates.

    The batch is read back from its own history partition, so the feeds are
    parsed once. Returns the one-row summary as written.
    """
    writers.append_history(writers.stamp(batch, run_id, scraped_at), history_path, run_id)
    history = readers.read_history(spark, history_path)
    this_run = history.where(F.col("run_id") == run_id)

    flags = Observation()
    # Equal in these columns, rows give the same line of the report; the others decide nothing.
    priced = history.select("listing_key", "vendor", "source_url", "price_usd", "scraped_at", "run_id")
    found = write_out(anomaly.detect_mispriced(priced, ordered=False, written=True), "mispriced")
    found = anomaly.in_order(found).observe(
        flags,
        F.count("*").alias("examined"),
        F.count_if("is_mispriced").alias("mispriced"),
        F.count_if("is_potentially_undervalued").alias("undervalued"),
    )
    writers.write_anomalies(found, f"{output}/mispriced_candidates")

    summary = summarize(history, this_run, run_id, tokens, limits, required)
    outcome = [(s.feed, s.reason) for s in skipped or []]
    summary = summary.withColumns(
        {
            "mispriced": F.struct(*[F.lit(v).alias(k) for k, v in flags.get.items()]),
            "skipped_feeds": F.array(
                *[F.struct(F.lit(f).alias("feed"), F.lit(r).alias("reason")) for f, r in outcome]
            ).cast("array<struct<feed:string,reason:string>>"),
            "feed_outcomes": _outcomes(tokens or [], outcome),
            "output_dir": F.lit(output),
            "history_path": F.lit(history_path),
        }
    )
    summary = cut(summary)
    writers.write_report(summary, f"{output}/run_summary")
    if enforce:
        gates.enforce(summary)
    return summary


def _outcomes(tokens: list[str], skipped: list[tuple[str, str]]) -> Column:
    """``feed, status, rows`` of every requested feed, from the quality of the feeds."""
    reasons = dict(skipped)
    parts = []
    for token in tokens:
        rows = F.coalesce(F.col("feed_quality")[token]["rows"], F.lit(0)).cast("long")
        status = F.lit(reasons[token]) if token in reasons else F.when(rows > 0, readers.READ).otherwise(readers.EMPTY)
        parts.append(F.struct(F.lit(token).alias("feed"), status.alias("status"), rows.alias("rows")))
    return F.array(*parts).cast("array<struct<feed:string,status:string,rows:bigint>>")


def summarize(
    history: DataFrame,
    this_run: DataFrame,
    run_id: str,
    tokens: list[str] | None,
    limits: gates.Thresholds,
    required: gates.Required,
) -> DataFrame:
    """All metrics of one run as one nested row, joined on the run id."""
    spark = history.sparkSession
    requested = None
    if tokens:
        requested = spark.createDataFrame([(t,) for t in tokens], "feed string")
    per_feed = quality.summarize_feeds(this_run, requested)
    measures = [c for c in per_feed.columns if c != "feed"]
    feeds = per_feed.agg(
        F.map_from_entries(F.collect_list(F.struct("feed", F.struct(*measures)))).alias(
            "feed_quality"
        )
    )
    vendors = quality.named_vendors(this_run).agg(
        F.map_from_entries(F.collect_list(F.struct("vendor", "rows"))).alias("vendor_distribution")
    )
    rows = history.groupBy("run_id").count()
    sizes = rows.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("history_rows"))
    one = runs.growth_of(history, run_id)
    for part in (feeds, vendors, sizes):
        one = one.join(part.withColumn("run_id", F.lit(run_id)), "run_id", "left")
    one = one.join(runs.expansion_of(history, run_id), "run_id", "left")
    one = one.join(runs.run_diversity(this_run).drop("current_rows"), "run_id", "left")
    one = one.na.fill(0, ["active_vendor_count"]).na.fill(
        0.0, ["dominant_vendor_share", "weighted_cert_present_rate", "weighted_parse_success_rate"]
    )
    growth = ["previous_run_id", "previous_rows", "current_rows", "delta_rows", "delta_pct"]
    expansion = [c for c in runs.EXPANSION if c in one.columns]

    def target(**values):
        return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])

    return one.select(
        "run_id",
        F.array(*[F.lit(t) for t in tokens or []]).cast("array<string>").alias("feeds"),
        "feed_quality",
        F.col("current_rows").alias("batch_rows"),
        "history_rows",
        F.struct(*growth).alias("growth_metrics"),
        F.struct(*expansion).alias("expansion_metrics"),
        "active_vendor_count",
        target(min_new_rows=limits.min_new_rows, require_growth=required.growth).alias(
            "growth_target"
        ),
        target(
            min_active_vendors=limits.min_active_vendors,
            require_min_active_vendors=required.min_active_vendors,
        ).alias("source_target"),
        target(
            min_coverage_multiple=limits.min_coverage_multiple,
            require_coverage_multiple=required.coverage,
        ).alias("coverage_target"),
        gates.phase_progress(limits).alias("phase_progress"),
        gates.exit_evaluation(limits, ("vendor_distribution",)).alias("phase12_exit"),
        target(**asdict(limits)).alias("thresholds"),
        gates.status(limits, required).alias("status"),
    )
