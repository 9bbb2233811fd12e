"""Fit, validate and publish the price model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetflow.functions.features import CATEGORICAL, NUMERIC, model_rows
from facetflow.operators import gates, model, policy, residual_trees, splits, validation
from facetflow.operators.joins import lookup_join
from facetflow.session import cut, write_out
from facetflow.sources.writers import write_attribution, write_report

# Columns that put rows of one date in order for the time holdout.
TIE = ["source_url", "vendor", "sku_or_stock"]


def training_rows(listings: DataFrame) -> DataFrame:
    """The columns training needs, of the rows it may use."""
    rows = model_rows(listings)
    return rows.select(
        splits.vendor_group(F.col("vendor")).alias("vendor"),
        "source_url",
        "sku_or_stock",
        "date_seen",
        *CATEGORICAL,
        *NUMERIC,
        "log_price",
    )


@dataclass(frozen=True)
class Validation:
    """Everything validation needs from the data; results are computed on demand."""

    rows: DataFrame
    design: model.Design
    sums: validation.Fits
    cut: splits.TimeCut | None
    folds: DataFrame

    @cached_property
    def n_groups(self) -> int:
        return self.folds.count()

    @cached_property
    def residuals(self) -> DataFrame:
        """Out-of-fold predictions, written once: several quantile passes read them."""
        return write_out(validation.out_of_fold(self.rows, self.sums), "residuals")

    def errors(self, fitted: model.Model) -> DataFrame:
        """The errors that bands are taken from; with one vendor, those of ``fitted`` itself."""
        if self.n_groups < 2:
            return self.rows.select(F.abs(F.col("log_price") - fitted.predict()).alias("abs_error"))
        return self.residuals

    def boosted(self, trees: int = residual_trees.TREES, whole: bool = True, **given) -> residual_trees.Boosted:
        """Trees on the residuals of every fold's model and, if wanted, of the model of all rows."""
        models = self.sums.fold_models() if self.n_groups >= 2 else []
        if whole or not models:
            models = [*models, (residual_trees.WHOLE, self.sums.whole)]
        return residual_trees.boost(self.rows, models, trees, **given)

    @cached_property
    def per_fold(self) -> DataFrame:
        return validation.fold_metrics(self.residuals)

    @cached_property
    def cv(self) -> DataFrame:
        """Means over folds; one vendor cannot be cross-validated, which the status says."""
        skipped = self.n_groups < 2
        means = validation.cv_metrics(self.per_fold.where("false") if skipped else self.per_fold)
        return means.withColumn("status", F.lit("skipped_single_vendor" if skipped else "ok"))

    @cached_property
    def vendor_holdout(self) -> DataFrame:
        return validation.vendor_holdout(self.rows, self.sums)

    @cached_property
    def time_holdout(self) -> DataFrame | None:
        return validation.time_holdout(self.rows, self.cut, self.sums)


def validate(rows: DataFrame, tie: list[str] | None = None, stored: Callable | None = None) -> Validation:
    """One pass of cross products over the training rows serves every split.

    ``stored`` makes models from rows and design instead (see
    ``validation.Stored``), which are then validated without training.
    """
    tie = tie or TIE
    at = splits.time_cut(rows, tie)
    if at is None:
        rows = rows.withColumn("is_late", F.lit(None).cast("boolean"))
    else:
        rows = splits.with_time_split(rows, at, tie)
    folds = write_out(splits.vendor_folds(rows), "folds")
    rows = write_out(lookup_join(rows, folds, ["vendor"]), "split")
    design = model.fit_design(rows)
    fits = validation.collect_sums(rows, design) if stored is None else stored(rows, design)
    return Validation(rows, design, fits, at, folds)


@dataclass(frozen=True)
class Trained:
    model: model.Model
    policy: policy.Policy
    metrics: DataFrame
    policy_report: DataFrame
    attribution: DataFrame
    trees: residual_trees.Trees | None = None


def train(
    listings: DataFrame,
    quality_report: DataFrame | None,
    require_quality_report: bool = True,
    min_improvement: float = gates.MIN_IMPROVEMENT,
    trees: int = 0,
) -> Trained:
    """Gate on quality, validate, gate on improvement, fit on all rows.

    With ``trees``, that many are boosted on the residuals; the metrics then have
    the out-of-fold error of both stages, and the bands are taken from it.
    """
    if require_quality_report:
        gates.enforce_training_quality(quality_report)
    checked = validate(write_out(training_rows(listings), "training"))
    cv = cut(checked.cv)
    if cv.first()["status"] == "ok":
        gates.enforce_gate(gates.improvement(cv, min_improvement))
    fitted = checked.sums.whole
    errors, second = checked.errors(fitted), None
    record = metrics_record(checked, cv, fitted)
    if trees:
        second = checked.boosted(trees)
        if checked.n_groups >= 2:
            errors = second.out_of_fold()
            per_fold = errors.groupBy("fold").agg(F.avg("abs_error").alias("_error"))
            mean = per_fold.agg(F.avg("_error").alias("two_stage_cv_mae_log_mean"))
            record = record.withColumn("two_stage_cv_mae_log_mean", mean.scalar())
    rules, report = policy.uncertainty_policy(checked.rows, errors)
    attributed = model.attribution(checked.rows, fitted)
    return Trained(fitted, rules, record, report, attributed, second and second.trees)


def metrics_record(checked: Validation, cv: DataFrame, fitted: model.Model) -> DataFrame:
    """One nested row: cross-validation, sizes and both holdouts."""
    record = cv.withColumns(
        {
            "n_samples": F.lit(fitted.rows).cast("bigint"),
            "n_groups": F.lit(checked.n_groups).cast("bigint"),
            "feature_count": F.lit(len(checked.design.columns)).cast("bigint"),
            "_one": F.lit(1),
        }
    )
    held = checked.vendor_holdout
    held = held.agg(F.sort_array(F.collect_list(F.struct(*held.columns))).alias("vendor_holdout"))
    record = record.join(held.withColumn("_one", F.lit(1)), "_one", "left")
    if checked.time_holdout is not None:
        late = checked.time_holdout
        late = late.select(F.struct(*late.columns).alias("time_holdout"), F.lit(1).alias("_one"))
        record = record.join(late, "_one", "left")
    return record.drop("_one")


def publish(spark: SparkSession, trained: Trained, out: str) -> None:
    """Write metrics, policy, attribution and the model table."""
    write_report(trained.metrics, f"{out}/metrics")
    write_report(trained.policy_report, f"{out}/uncertainty_policy")
    write_attribution(trained.attribution, f"{out}/attribution")
    table = model.model_table(spark, trained.model)
    table.write.mode("overwrite").parquet(f"{out}/model")
    if trained.trees is not None:
        residual_trees.tree_table(spark, trained.trees).write.mode("overwrite").parquet(f"{out}/trees")
