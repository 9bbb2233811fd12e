"""Named queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetflow import sampledata, schema
from facetflow.functions import features, keys, text
from facetflow.operators import (
    anomaly,
    assemble,
    baseline,
    dedupe,
    gates,
    model,
    normalize,
    pages,
    policy,
    quality,
    runs,
    specs,
    splits,
    titles,
    validation,
)
from facetflow.plans import harvest, merge, run_cycle, train
from facetflow.session import PIECE, write_out
from facetflow.session import scratch_path as _scratch
from facetflow.sources import readers, registry, writers
from facetflow.streaming import ingest

#: Added before rounding sums of multiples of an eighth, so that halves go one way in any engine.
NUDGE = 0.000003
#: How text feeds of whole tables are written: their words repeat, so the text is far larger than what it says.
PACKED = "gzip"
Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2024-02-01"
TIE = ["source_url"]
RERUN = "20240115T000000Z"
LIMITS = gates.Thresholds(min_new_rows=0, min_coverage_multiple=1.0, max_vendor_share=0.25)
REQUIRED = gates.Required(growth=True, min_active_vendors=True, coverage=True, exit=True)


def _plain(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """Dates as text and doubles rounded, so that two engines can be compared.

    Without ``digits`` doubles stay as they are: read values and single
    divisions are the same in any engine.
    """
    out = []
    for field in df.schema:
        c = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("date").cast("string")
        elif kind == "double" and digits is not None:
            c = F.round(c, digits)
        elif kind == "int":
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(sampledata.listings(spark, sf_dir), keep=["feed"])


def training_rows(spark: SparkSession, sf_dir: str, written: bool = True) -> DataFrame:
    """Model rows of the priced listings; written once where several passes follow."""
    rows = train.training_rows(normalize.normalize(sampledata.priced_listings(spark, sf_dir)))
    return write_out(rows, "training") if written else rows


# --- standardising, identity, deduplication


def normalize_listings(spark, sf_dir):
    return _plain(normalized(spark, sf_dir).select(*schema.LISTING_COLUMNS), None)


def import_feed_vendor_fill(spark, sf_dir):
    raw = sampledata.listings(spark, sf_dir).withColumn(
        "vendor", F.expr("case when table_pct = 51 then null when table_pct = 52 then '  ' else concat(' ', vendor) end")
    )
    return normalize.fill_vendor(raw, "partner").select("source_url", "vendor")


def listing_keys(spark, sf_dir):
    rows = normalized(spark, sf_dir)
    return rows.select(
        "source_url",
        keys.certificate_digits(F.col("cert_number")).alias("certificate"),
        keys.listing_key(rows).alias("listing_key"),
    )


def dedupe_keys(spark, sf_dir):
    rows, names = dedupe.with_dedupe_key(normalized(spark, sf_dir))
    return rows.select("source_url", *[F.col(n).alias(f"key{n}") for n in names])


def dedupe_listings(spark, sf_dir):
    return _plain(dedupe.dedupe(normalize.normalize(sampledata.listings(spark, sf_dir))), None)


def dedupe_keep_incomplete(spark, sf_dir):
    rows = normalize.normalize(sampledata.listings(spark, sf_dir))
    kept = dedupe.dedupe(rows, missing_geometry="keep")
    return _plain(kept.select("source_url", "date_seen", "carat", "length_mm"), None)


# --- quality, runs, gates


def quality_report(spark, sf_dir):
    report = quality.quality_report(normalized(spark, sf_dir))
    flat = report.select(
        "row_count",
        "required_completeness.*",
        "joint_parse_rate",
        "missing_price_rows",
        "missing_carat_rows",
        F.size("vendor_counts").cast("bigint").alias("vendors"),
    )
    return _plain(flat)


def vendor_counts(spark, sf_dir):
    return quality.vendor_counts(normalized(spark, sf_dir))


def feed_summary(spark, sf_dir):
    requested = sampledata.table(spark, sf_dir, "region").select(F.lower("r_name").alias("feed"))
    silent = sampledata.table(spark, sf_dir, "region").select(
        F.concat(F.lit("import:"), F.lower("r_name")).alias("feed")
    )
    return _plain(quality.summarize_feeds(normalized(spark, sf_dir), requested.union(silent)))


def batch_summary(spark, sf_dir):
    return _plain(quality.summarize_batch(normalized(spark, sf_dir)))


def weighted_quality(spark, sf_dir):
    return _plain(quality.weighted_quality(quality.summarize_feeds(normalized(spark, sf_dir))))


def active_vendors(spark, sf_dir):
    return quality.active_vendors(normalized(spark, sf_dir))


def dominant_vendor(spark, sf_dir):
    return _plain(quality.dominant_vendor(normalized(spark, sf_dir)))


def run_growth(spark, sf_dir):
    return _plain(runs.run_growth(sampledata.history(spark, sf_dir)))


def run_expansion(spark, sf_dir):
    return _plain(runs.run_expansion(sampledata.history(spark, sf_dir)))


def latest_run_growth(spark, sf_dir):
    history = sampledata.history(spark, sf_dir)
    return _plain(runs.growth_of(history, _last_run(history)))


def latest_run_expansion(spark, sf_dir):
    history = sampledata.history(spark, sf_dir)
    return _plain(runs.expansion_of(history, _last_run(history)))


def _last_run(history: DataFrame) -> str:
    return history.agg(F.max("run_id")).first()[0]


def run_diversity(spark, sf_dir):
    return _plain(runs.run_diversity(sampledata.history(spark, sf_dir)))


def gate_status(spark, sf_dir):
    judged = gates.gate_status(sampledata.history(spark, sf_dir), LIMITS, REQUIRED)
    return judged.select("run_id", "status")


def exit_checks(spark, sf_dir):
    metrics = gates.run_metrics(sampledata.history(spark, sf_dir))
    judged = metrics.select("run_id", gates.exit_evaluation(LIMITS).alias("exit"))
    return judged.select("run_id", "exit.ready", "exit.checks.*")


def phase_progress(spark, sf_dir):
    metrics = gates.run_metrics(sampledata.history(spark, sf_dir))
    judged = metrics.select("run_id", gates.phase_progress(LIMITS).alias("phase"))
    return judged.select(
        "run_id",
        F.col("phase.phase_1_acquisition_hardening.ready").alias("sources_ready"),
        F.col("phase.phase_2_dataset_defensibility.ready").alias("coverage_ready"),
    )


def source_policy(spark, sf_dir):
    return registry.source_policy(sampledata.sources(spark, sf_dir))


# --- anomalies


def run_ids(spark, sf_dir):
    events = sampledata.table(spark, sf_dir, "events")
    return events.groupBy(text.run_id_of(F.col("ts").cast("timestamp")).alias("run_id")).agg(
        F.count("*").alias("rows")
    )


def mispriced(spark, sf_dir):
    return _plain(anomaly.detect_mispriced(sampledata.history(spark, sf_dir)).drop("carat"))


def price_stats(spark, sf_dir):
    return _plain(anomaly.price_stats(sampledata.history(spark, sf_dir)))


def mispriced_ranking(spark, sf_dir):
    """The head of the anomaly report, in its order."""
    return _plain(anomaly.ranked(anomaly.detect_mispriced(sampledata.history(spark, sf_dir)), 100).select("rank", "listing_key"))


def training_gates(spark, sf_dir):
    """The gates before and after validation, on the listings' quality and the stored models."""
    report = quality.quality_report(normalize.normalize(sampledata.priced_listings(spark, sf_dir)))
    cv = _revalidated(spark, sf_dir).cv
    return _plain(gates.training_quality(report).unionByName(gates.improvement(cv)))


def flag_counts(spark, sf_dir):
    found = anomaly.detect_mispriced(sampledata.history(spark, sf_dir), ordered=False)
    return anomaly.flag_counts(found)


# --- text extraction


def _parsed_title(spark, sf_dir, column, parse):
    parsed = sampledata.titles(spark, sf_dir).select("source_url", parse(F.col(column)).alias("t"))
    return parsed.select("source_url", "t.*")


def title_parse_table(spark, sf_dir):
    return _parsed_title(spark, sf_dir, "table_title", titles.parse_table_title)


def title_parse_label(spark, sf_dir):
    return _parsed_title(spark, sf_dir, "label_title", titles.parse_label_title)


def _parsed_specs(spark, sf_dir, column, parse, wanted):
    parsed = sampledata.spec_lines(spark, sf_dir).select(
        "source_url", parse(F.col(column)).alias("m")
    )
    values = [specs.spec(F.col("m"), k).alias(k) for k in wanted]
    return parsed.select("source_url", *values, F.size("m").cast("bigint").alias("parsed_keys"))


def spec_parse_table(spark, sf_dir):
    wanted = ["stock", "shape", "clarity", "carat", "polish", "table_pct", "measurements"]
    return _parsed_specs(spark, sf_dir, "table_lines", specs.parse_table_specs, wanted)


def spec_parse_label(spark, sf_dir):
    wanted = ["carat", "shape", "color", "modifier", "table_pct", "measurements"]
    return _parsed_specs(spark, sf_dir, "label_lines", specs.parse_label_specs, wanted)


def spec_parse_wrapped(spark, sf_dir):
    """Entries that go on in a second line of text."""
    rows = sampledata.listings(spark, sf_dir)
    parsed = rows.select("source_url", specs.parse_label_specs(F.expr(sampledata.WRAPPED_LINES)).alias("m"))
    wanted = ["carat", "shape", "table_pct", "depth_pct", "girdle", "polish"]
    return parsed.select("source_url", *[specs.spec(F.col("m"), k).alias(k) for k in wanted])


def measurements(spark, sf_dir):
    rows = sampledata.measure_texts(spark, sf_dir)
    parsed = rows.select("source_url", text.parse_measurements(F.col("measures")).alias("m"))
    ratio = text.l_w_ratio(F.col("m.length_mm"), F.col("m.width_mm"))
    return parsed.select("source_url", "m.*", ratio.alias("l_w_ratio"))


def modifier_words(spark, sf_dir):
    """Modifiers as vendors write them, those that say none emptied."""
    word = F.expr(sampledata.MODIFIERS)
    return sampledata.listings(spark, sf_dir).select("source_url", word.alias("word"), text.clean_modifier(word).alias("modifier"))


def price_text(spark, sf_dir):
    rows = sampledata.measure_texts(spark, sf_dir)
    return rows.select("source_url", text.parse_price(F.col("price_text")).alias("price_usd"))


def url_keys(spark, sf_dir):
    """Slugs and stock numbers from product addresses and from page addresses."""
    products = sampledata.listings(spark, sf_dir).select("source_url")
    stored = sampledata.table(spark, sf_dir, "pages").select(F.col("url").alias("source_url"))
    urls = products.unionByName(stored)
    slug, stock = text.slug_from_url(F.col("source_url")), text.stock_from_url(F.col("source_url"))
    return urls.select(
        "source_url",
        F.when(slug.startswith("lb_"), "lb_").otherwise(slug).alias("slug"),
        F.when(stock.startswith("bn_"), "bn_").otherwise(stock).alias("stock"),
    )


# --- pages


def page_links(spark, sf_dir):
    stored = sampledata.table(spark, sf_dir, "pages")
    return pages.product_links(stored, ["page_id"], "/", "(?i)e", absolute=False)


def page_links_absolute(spark, sf_dir):
    stored = sampledata.table(spark, sf_dir, "pages")
    return pages.product_links(stored, ["page_id"], "/", "(?i)th")


def page_headings(spark, sf_dir):
    return pages.first_heading(sampledata.table(spark, sf_dir, "pages"), ["page_id"], "h1")


def page_blocks(spark, sf_dir):
    blocks = pages.tag_texts(sampledata.table(spark, sf_dir, "pages"), "p", ["page_id"])
    return blocks.groupBy("page_id").agg(
        F.count("*").alias("blocks"),
        F.sum(F.length("text")).cast("bigint").alias("characters"),
    )


def page_block_counts(spark, sf_dir):
    blocks = pages.tag_texts(sampledata.table(spark, sf_dir, "pages"), "p", ["page_id"])
    return blocks.groupBy("page_id").agg(F.count("*").alias("blocks"))


def first_links(spark, sf_dir):
    """The start of the frontier over all stored pages."""
    stored = sampledata.table(spark, sf_dir, "pages")
    links = pages.product_links(stored, ["page_id"], "/", "(?i)[a-z]", absolute=False)
    return pages.frontier(links, ["page_id"], limit=50)


def page_sequence(spark, sf_dir):
    stored = sampledata.list_pages(spark, sf_dir)
    links = pages.product_links(stored, ["site", "page_no"], "/", "(?i)ch", absolute=False)
    links = write_out(links, "links")
    return pages.pages_in_sequence(stored.select("site", "page_no"), links)


def page_sequence_limited(spark, sf_dir):
    stored = sampledata.list_pages(spark, sf_dir)
    links = pages.product_links(stored, ["site", "page_no"], "/", "(?i)[a-z]", absolute=False)
    links = write_out(links, "links")
    return pages.pages_in_sequence(stored.select("site", "page_no"), links, max_links=20)


def card_frontier(spark, sf_dir):
    lists, _ = sampledata.table_pages(spark, sf_dir)
    return pages.frontier(pages.page_cards(lists), ["url", "position"]).select(
        "href", "title", "price"
    )


def assembled_table(spark, sf_dir):
    lists, details = sampledata.table_pages(spark, sf_dir)
    return _plain(harvest.harvest_table(lists, details, AS_OF).select(*schema.LISTING_COLUMNS), None)


def assembled_label(spark, sf_dir):
    lists, details = sampledata.label_pages(spark, sf_dir)
    return _plain(harvest.harvest_label(lists, details, AS_OF), None)


def extraction_log(spark, sf_dir):
    lists, details = sampledata.table_pages(spark, sf_dir)
    log = assemble.extraction_log(harvest.harvest_table(lists, details, AS_OF))
    return log.select(
        "vendor",
        "listing_key",
        "source_url",
        "parse_ok",
        F.array_join("parsed_fields", ",").alias("parsed_fields"),
    )


# --- model


def model_features(spark, sf_dir):
    rows = normalize.normalize(sampledata.priced_listings(spark, sf_dir))
    table = _plain(features.feature_table(rows), None)
    return table.withColumn("log_price", F.round("log_price", 6))


def model_row_counts(spark, sf_dir):
    return features.model_row_counts(
        normalize.normalize(sampledata.priced_listings(spark, sf_dir))
    )


def feature_contract(spark, sf_dir):
    """Every column of the model and whether its coefficient is bound to rise."""
    design = model.fit_design(training_rows(spark, sf_dir, written=False))
    return spark.createDataFrame(
        list(zip(design.columns, design.monotone)), "feature string, monotone boolean"
    )


def encoded_levels(spark, sf_dir):
    """Rows per indicator of the one-hot encoding."""
    rows = training_rows(spark, sf_dir)
    design = model.fit_design(rows)
    codes = [
        F.struct(F.lit(g).alias("feature"), c.alias("code"), model.or_missing(F.col(g)).alias("level"))
        for g, c in zip(model.CATEGORICAL, design.codes())
    ]
    each = rows.select(F.inline(F.array(*codes)))
    return each.groupBy("feature", F.col("code").cast("bigint").alias("code"), "level").agg(
        F.count("*").alias("rows")
    )


def category_levels(spark, sf_dir):
    return model.category_levels(normalized(spark, sf_dir))


def vendor_folds(spark, sf_dir):
    return _plain(splits.vendor_folds(training_rows(spark, sf_dir, written=False)))


def group_count(spark, sf_dir):
    return splits.group_count(training_rows(spark, sf_dir, written=False))


def bucket_medians(spark, sf_dir):
    fitted = baseline.fit_baseline(training_rows(spark, sf_dir))
    return _plain(fitted.buckets)


def baseline_cv(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    folds = splits.vendor_folds(rows)
    with_fold = rows.join(folds, "vendor")
    scored = baseline.predict_baseline(with_fold, baseline.fit_baseline(with_fold, "fold"))
    per_fold = scored.groupBy("vendor").agg(
        F.count("*").alias("rows"),
        baseline.mean_absolute("baseline_log_price").alias("baseline_mae_log"),
    )
    return _plain(per_fold)


def vendor_holdout_baseline(spark, sf_dir):
    return _plain(validation.vendor_holdout_baseline(training_rows(spark, sf_dir)))


def time_holdout_split(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    cut_at = splits.time_cut(rows, TIE)
    late = splits.with_time_split(rows, cut_at, TIE)
    return late.groupBy("is_late").agg(
        F.count("*").alias("rows"),
        F.min("date_seen").cast("string").alias("first_date"),
        F.max("date_seen").cast("string").alias("last_date"),
        F.min("source_url").alias("first_url"),
    )


def time_holdout_baseline(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    cut_at = splits.time_cut(rows, TIE)
    late = splits.with_time_split(rows, cut_at, TIE)
    return _plain(validation.time_holdout(late, cut_at, None))


def gram_matrix(spark, sf_dir):
    """All cells of the cross products per vendor that are not zero, one per row."""
    used = ["vendor", *features.CATEGORICAL, *features.NUMERIC, "log_price"]
    rows = write_out(training_rows(spark, sf_dir, written=False).select(*used), "training")
    design = model.fit_design(rows)
    cells = model.cross_products(rows, design, ["vendor"])
    names = F.lit([*design.columns, "log_price"])
    rounded = F.round(F.col("value") + NUDGE, 2)
    return cells.where(rounded != 0).select(
        "vendor", F.get(names, F.col("i")).alias("left_term"), F.get(names, F.col("j")).alias("right_term"), rounded.alias("value")
    )


def stored_coefficient(feature: str) -> float:
    """The rule of the stored coefficients: by the length of the column's name, above zero for the weight."""
    if feature == "intercept":
        return 6.0
    if feature.startswith("carat_"):
        return (len(feature) % 5 + 1) / 10
    return (len(feature) * 7 % 11 - 5) / 100


def stored_models(rows: DataFrame, design: model.Design) -> validation.Stored:
    """A family of models written as a table and read back: of all rows, each fold, the early rows and each vendor.

    They differ in the intercept, by the fold, the length of the vendor's name
    or a constant.
    """
    spark = rows.sparkSession
    known = spark.createDataFrame([(c, stored_coefficient(c)) for c in design.columns], "feature string, coefficient double")
    vendors = rows.select("vendor", "fold").distinct()
    none = F.lit("")
    splits_of = [
        spark.range(1).select(F.lit("whole").alias("split"), none.alias("part"), F.lit(0.0).alias("shift")),
        spark.range(1).select(F.lit("early"), none, F.lit(0.05)),
        vendors.select(F.lit("fold"), F.col("fold").cast("string"), F.col("fold") / 50).distinct(),
        vendors.select(F.lit("vendor"), "vendor", F.length("vendor") / 50),
    ]
    parts = reduce(DataFrame.union, splits_of)
    columns = F.explode(F.lit(design.columns)).alias("feature")
    table = parts.select("split", "part", "shift", columns).join(known, "feature")
    value = F.col("coefficient") + F.when(F.col("feature") == "intercept", F.col("shift")).otherwise(0.0)
    table = write_out(table.select("split", "part", "feature", value.alias("coefficient")), "coefficients")
    means, n = model.column_means(rows, design)
    return validation.Stored(design, table, tuple(means), n)


def _revalidated(spark, sf_dir) -> train.Validation:
    """The stored models judged on the training rows."""
    return train.validate(training_rows(spark, sf_dir), tie=TIE, stored=stored_models)


def _validated(spark, sf_dir) -> train.Validation:
    """Models trained on the training rows of every split, judged on the rows they did not see."""
    return train.validate(training_rows(spark, sf_dir), tie=TIE)


def cv_metrics(spark, sf_dir):
    return _plain(_validated(spark, sf_dir).per_fold)


def cv_summary(spark, sf_dir):
    return _plain(_revalidated(spark, sf_dir).cv)


def vendor_holdout(spark, sf_dir):
    return _plain(_validated(spark, sf_dir).vendor_holdout)


def time_holdout(spark, sf_dir):
    return _plain(_revalidated(spark, sf_dir).time_holdout)


def attribution(spark, sf_dir):
    """How far every column of the stored model moves predictions, with its rank as written."""
    checked = _revalidated(spark, sf_dir)
    path = _scratch(spark, "attribution")
    writers.write_attribution(model.attribution(checked.rows, checked.sums.whole), path)
    written = spark.read.option("header", True).csv(path)
    size = text.to_number(F.col("mean_abs_contribution"))
    return _plain(written.select("feature", size.alias("mean_abs_contribution"), F.col("rank").cast("bigint").alias("rank")))


def metrics_record(spark, sf_dir):
    """The metrics report of the stored models as written, read back."""
    checked = _revalidated(spark, sf_dir)
    path = _scratch(spark, "metrics")
    record = train.metrics_record(checked, checked.cv, checked.sums.whole)
    writers.write_report(record, path)
    written = spark.read.schema(record.schema).json(path)
    return _plain(
        written.select(
            "n_samples",
            "n_groups",
            "feature_count",
            "status",
            "cv_mae_improvement_vs_baseline",
            F.array_join("vendor_holdout.vendor", ",").alias("vendors"),
            "time_holdout.cutoff_date",
        )
    )


def two_stage_model(spark, sf_dir):
    """Mean absolute out-of-fold error of the linear model and with trees on top."""
    both = train.validate(training_rows(spark, sf_dir), tie=TIE).boosted(whole=False).out_of_fold()
    return both.groupBy("vendor").agg(
        baseline.mean_absolute("linear_log_price").alias("linear_mae_log"),
        baseline.mean_absolute("predicted_log_price").alias("two_stage_mae_log"),
    )


def _fitted(rows: DataFrame) -> model.Model:
    design = model.fit_design(rows)
    return model.fit(model.collect_cells(model.cross_products(rows, design, []), design), design)


def model_contract(spark, sf_dir):
    """The fitted model as published, read back, with the conditions of its fit per column."""
    rows = training_rows(spark, sf_dir)
    path = _scratch(spark, "model")
    model.model_table(spark, _fitted(rows)).write.parquet(path)
    table = spark.read.parquet(path)
    judged = model.optimality(rows, model.load_model(table)).drop("monotone")
    return table.join(judged, "feature").select(
        F.col("position").cast("bigint").alias("position"), "feature", "monotone", "not_negative", "stationary", "complementary"
    )


def scored(spark, sf_dir):
    """Prices of the stored model with bands from its out-of-fold errors."""
    checked = _revalidated(spark, sf_dir)
    fitted = checked.sums.whole
    bands = policy.error_bands(checked.errors(fitted)).first()
    listings = normalize.normalize(sampledata.priced_listings(spark, sf_dir))
    wanted = ["missing_count", "reject", "predicted_price", "price_low", "price_high"]
    out = policy.score(listings, fitted, policy.Policy(bands["p75"], bands["p90"]))
    return _plain(out.select("source_url", *wanted), 2)


def reject_rule(spark, sf_dir):
    listings = normalize.normalize(sampledata.priced_listings(spark, sf_dir))
    missing = features.sparse_count()
    return listings.select(
        "source_url",
        missing.cast("bigint").alias("missing_count"),
        (missing >= policy.REJECT_MISSING).alias("reject"),
    )


def uncertainty_policy(spark, sf_dir):
    """The policy over the out-of-fold errors of the stored models."""
    checked = _revalidated(spark, sf_dir)
    _, report = policy.uncertainty_policy(checked.rows, checked.errors(checked.sums.whole))
    flat = report.select(
        F.col("reject_if_missing_feature_count_ge").alias("reject_missing"),
        F.col("high_uncertainty_abs_log_error_threshold").alias("high_error"),
        F.col("medium_uncertainty_abs_log_error_threshold").alias("medium_error"),
        F.col("sparse_feature_missing_distribution.p50").alias("missing_p50"),
        F.col("sparse_feature_missing_distribution.p90").alias("missing_p90"),
    )
    return _plain(flat)


# --- sources, sinks and whole programs, written to the shared folder and read back


def csv_scan(spark, sf_dir):
    folder = _scratch(spark, "feeds")
    raw = sampledata.listings(spark, sf_dir).drop("feed")
    raw.write.option("header", True).option("escape", '"').csv(f"{folder}/one.csv")
    absent = f"{folder}/absent.csv"
    return _plain(readers.read_present(spark, [f"{folder}/one.csv", absent]), None)


def csv_quoted_breaks(spark, sf_dir):
    """A CSV feed with line breaks, quotes and commas inside its values, read without being told."""
    folder = _scratch(spark, "feeds")
    raw = sampledata.listings(spark, sf_dir).drop("feed").withColumn("girdle", F.expr(sampledata.QUOTED))
    raw.write.option("header", True).option("escape", '"').csv(f"{folder}/one.csv")
    return _plain(readers.read_present(spark, [f"{folder}/one.csv"]).select("source_url", "carat", "girdle", "culet", "cert_number"), None)


def merged_inputs(spark, sf_dir):
    """Two feeds of different formats and columns, and one that is absent, as one table."""
    folder = _scratch(spark, "feeds")
    raw = sampledata.listings(spark, sf_dir).drop("feed")
    odd = F.col("table_pct") % 2 == 1
    raw.where(odd).drop("culet").write.option("header", True).option("escape", '"').option("compression", PACKED).csv(f"{folder}/one.csv")
    raw.where(~odd).select(*reversed(raw.columns)).write.option("compression", PACKED).json(f"{folder}/two.json")
    return _plain(readers.read_present(spark, [f"{folder}/{n}" for n in ("one.csv", "absent.parquet", "two.json")]), None)


def run_feeds(spark, sf_dir):
    """What became of every feed of a run: read, absent, without rows, of an unknown format, a partner's file."""
    folder = _scratch(spark, "feeds")
    raw = write_out(sampledata.listings(spark, sf_dir), "listings")  # every region reads them

    def of(region):
        return raw.where(F.col("feed") == region).drop("feed")

    of("africa").write.option("header", True).option("escape", '"').option("compression", PACKED).csv(f"{folder}/africa.csv")
    of("asia").write.option("compression", PACKED).json(f"{folder}/asia.json")
    of("europe").write.parquet(f"{folder}/europe.parquet")
    of("america").drop("vendor").write.option("header", True).option("escape", '"').option("compression", PACKED).csv(f"{folder}/partner.csv")
    readers.header_only(spark).write.parquet(f"{folder}/placeholder.parquet")
    feeds = {r: f"{folder}/{r}.{kind}" for r, kind in (("africa", "csv"), ("asia", "json"), ("europe", "parquet"), ("placeholder", "parquet"), ("absent", "csv"), ("table", "xml"))}
    rows, skipped = readers.read_run(spark, feeds | {"import:partner": folder, "import:nobody": folder})
    vendors = rows.groupBy("feed").agg(F.min("vendor").alias("first_vendor"))
    return readers.feed_outcomes(spark, rows, skipped).join(vendors, "feed", "left")


def harvest_batch(spark, sf_dir):
    """Stored pages harvested into a feed's batch, read back."""
    done = _harvested(spark, sf_dir)
    return _plain(spark.read.parquet(done.batch_path).select(*schema.LISTING_COLUMNS), None)


def harvest_log(spark, sf_dir):
    """The extraction log that the same harvest writes, read back."""
    done = _harvested(spark, sf_dir)
    log = spark.read.json(done.log_path)
    return log.select("vendor", "listing_key", "source_url", "parse_ok", F.array_join("parsed_fields", ",").alias("parsed_fields"))


def harvest_counts(spark, sf_dir):
    """A harvested batch and a header-only source through the run metrics, with the counts of the harvest."""
    done = _harvested(spark, sf_dir)
    batch = spark.read.parquet(done.batch_path).withColumn("feed", F.lit("table"))
    silent = readers.header_only(spark).withColumn("feed", F.lit("placeholder"))
    requested = spark.createDataFrame([("table",), ("placeholder",)], "feed string")
    measured = quality.summarize_feeds(batch.unionByName(silent), requested)
    parsed = F.when(F.col("feed") == "table", done.parsed).otherwise(0)
    return _plain(measured.withColumn("parsed", parsed.cast("bigint")))


def _harvested(spark, sf_dir) -> harvest.Harvest:
    folder = _scratch(spark, "stored")
    lists, details = sampledata.table_pages(spark, sf_dir)
    lists.write.parquet(f"{folder}/lists")
    details.write.parquet(f"{folder}/details")
    return harvest.harvest(spark, f"{folder}/lists", f"{folder}/details", "table", AS_OF, f"{folder}/raw", "table")


def import_scan(spark, sf_dir):
    folder = _scratch(spark, "imports")
    raw = sampledata.listings(spark, sf_dir).withColumn(
        "vendor", F.when(F.col("table_pct") != 51, F.col("vendor"))
    )
    raw.drop("feed").write.option("header", True).option("escape", '"').csv(f"{folder}/partner.csv")
    return quality.vendor_counts(readers.read_import(spark, "partner", folder))


def anomaly_report(spark, sf_dir):
    """The anomaly report as written, read back."""
    path = _scratch(spark, "anomalies")
    writers.write_anomalies(anomaly.detect_mispriced(sampledata.history(spark, sf_dir)), path)
    written = spark.read.option("header", True).csv(path)
    numbers = [text.to_number(F.col(c)).alias(c) for c in ("price_usd", "median", "z_score")]
    flag = F.col("is_potentially_undervalued").try_cast("boolean")
    return _plain(
        written.select("vendor", "listing_key", *numbers, flag.alias("is_potentially_undervalued"))
    )


def json_scan(spark, sf_dir):
    folder = _scratch(spark, "feeds")
    sampledata.listings(spark, sf_dir).drop("feed").write.option("compression", PACKED).json(f"{folder}/one.json")
    return _plain(readers.read_present(spark, [f"{folder}/one.json"]), None)


def _aligned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = sampledata.history(spark, sf_dir)
    return history.select(
        *[
            F.col(f.name) if f.name in history.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.HISTORY_SCHEMA
        ]
    )


def history_rerun_empty(spark, sf_dir):
    """Every run, then one of them again without rows: it is gone."""
    path = _scratch(spark, "history")
    writers.append_history(_aligned_history(spark, sf_dir), path)
    writers.append_history(_aligned_history(spark, sf_dir).where("false"), path, RERUN)
    return readers.read_history(spark, path).groupBy("run_id").agg(F.count("*").alias("rows"))


def history_batch_then_stream(spark, sf_dir):
    """Earlier runs by batch, the others through the stream, into one history."""
    path = _scratch(spark, "history")
    writers.append_history(_aligned_history(spark, sf_dir).where(F.col("run_id") <= RERUN), path)
    files = spark.readStream.schema(sampledata.table(spark, sf_dir, "events").schema)
    arriving = files.option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    ingest.ingest_stream(
        arriving, lambda rows: sampledata.history_of(rows).where(F.col("run_id") > RERUN), path, _scratch(spark, "progress")
    )
    return readers.read_history(spark, path).groupBy("run_id").agg(F.count("*").alias("rows"))


def history_roundtrip(spark, sf_dir):
    """Append every run twice; the second time changes nothing."""
    path = _scratch(spark, "history")
    aligned = _aligned_history(spark, sf_dir)
    writers.append_history(aligned, path)
    writers.append_history(aligned.where("run_id > '20240115'"), path)
    return _plain(runs.run_growth(readers.read_history(spark, path)))


def history_stream(spark, sf_dir):
    """The same history through the stream."""
    path = _scratch(spark, "history")
    layout = sampledata.table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(layout).option("pathGlobFilter", "events*.parquet")
    arriving = files.parquet(sf_dir)
    ingest.ingest_stream(arriving, sampledata.history_of, path, _scratch(spark, "progress"))
    return _plain(runs.run_growth(readers.read_history(spark, path)))


def merge_clean(spark, sf_dir):
    folder = _scratch(spark, "clean")
    raw = sampledata.listings(spark, sf_dir).drop("feed")
    raw.write.option("parquet.block.size", PIECE).parquet(f"{folder}/feed.parquet")
    report = merge.merge_and_clean(
        spark, [f"{folder}/feed.parquet"], f"{folder}/clean", f"{folder}/quality"
    )
    return _plain(
        report.select(
            "rows_read", "rows_kept", "row_count", "joint_parse_rate", F.col("required_completeness.carat")
        )
    )


def run_summary(spark, sf_dir):
    """A whole run over the listings as one feed per region."""
    listings = sampledata.listings(spark, sf_dir)
    summary = run_cycle.run(
        spark,
        normalize.normalize(listings, keep=["feed"]),
        run_id="20240201T000000Z",
        scraped_at="2024-02-01 00:00:00",
        history_path=_scratch(spark, "history"),
        output=_scratch(spark, "run"),
    )
    flat = summary.select(
        "run_id",
        "batch_rows",
        "history_rows",
        "mispriced.examined",
        "growth_metrics.delta_rows",
        "active_vendor_count",
        F.col("phase12_exit.metrics.dominant_vendor").alias("dominant_vendor"),
        "status",
    )
    return _plain(flat)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        normalize_listings,
        import_feed_vendor_fill,
        listing_keys,
        dedupe_keys,
        dedupe_listings,
        dedupe_keep_incomplete,
        quality_report,
        vendor_counts,
        feed_summary,
        batch_summary,
        weighted_quality,
        active_vendors,
        dominant_vendor,
        run_growth,
        run_expansion,
        latest_run_growth,
        latest_run_expansion,
        run_diversity,
        gate_status,
        exit_checks,
        phase_progress,
        source_policy,
        run_ids,
        mispriced,
        price_stats,
        mispriced_ranking,
        flag_counts,
        title_parse_table,
        title_parse_label,
        spec_parse_table,
        spec_parse_label,
        spec_parse_wrapped,
        measurements,
        modifier_words,
        price_text,
        url_keys,
        page_links,
        page_links_absolute,
        page_headings,
        page_blocks,
        page_block_counts,
        first_links,
        page_sequence,
        page_sequence_limited,
        card_frontier,
        assembled_table,
        assembled_label,
        extraction_log,
        model_features,
        model_row_counts,
        feature_contract,
        encoded_levels,
        category_levels,
        vendor_folds,
        group_count,
        bucket_medians,
        baseline_cv,
        vendor_holdout_baseline,
        time_holdout_split,
        time_holdout_baseline,
        gram_matrix,
        cv_metrics,
        cv_summary,
        vendor_holdout,
        time_holdout,
        attribution,
        metrics_record,
        training_gates,
        two_stage_model,
        model_contract,
        scored,
        reject_rule,
        uncertainty_policy,
        csv_scan,
        csv_quoted_breaks,
        merged_inputs,
        run_feeds,
        harvest_batch,
        harvest_log,
        harvest_counts,
        import_scan,
        anomaly_report,
        json_scan,
        history_roundtrip,
        history_rerun_empty,
        history_batch_then_stream,
        history_stream,
        merge_clean,
        run_summary,
    ]
}
