"""Pass or fail rules over metric tables of one row per run."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetflow.operators import runs


@dataclass(frozen=True)
class Thresholds:
    # Default acceptance thresholds.
    min_new_rows: int = 25
    min_active_vendors: int = 3
    min_coverage_multiple: float = 3.0
    max_vendor_share: float = 0.60
    min_weighted_cert_present_rate: float = 0.70
    min_weighted_parse_success_rate: float = 0.80


@dataclass(frozen=True)
class Required:
    """Which gates may fail a run; all are reported either way."""

    growth: bool = False
    min_active_vendors: bool = False
    coverage: bool = False
    exit: bool = False


# Status names, in order of precedence.
FAILED_GROWTH = "failed_growth_gate"
FAILED_SOURCES = "failed_source_gate"
FAILED_COVERAGE = "failed_coverage_gate"
FAILED_EXIT = "failed_phase12_exit_gate"
PASSED = "ok"

# Quality gates before and after training.
MIN_JOINT_PARSE_RATE = 0.9
MIN_IMPROVEMENT = 0.0


class GateFailed(RuntimeError):
    def __init__(self, status: str, detail: str):
        super().__init__(f"{status}: {detail}")
        self.status = status


def run_metrics(history: DataFrame) -> DataFrame:
    """Growth, coverage and diversity of every run, joined on the run id."""
    diversity = runs.run_diversity(history)
    growth = runs.with_growth(diversity)
    return growth.join(runs.run_expansion(history), "run_id")


def growth_check(limits: Thresholds) -> Column:
    return F.col("delta_rows") >= limits.min_new_rows


def checks(limits: Thresholds) -> dict[str, Column]:
    """The six exit checks over the columns of ``run_metrics``."""
    return {
        "min_active_vendors": F.col("active_vendor_count") >= limits.min_active_vendors,
        "min_listing_coverage_multiple": F.col("listing_coverage_multiple")
        >= limits.min_coverage_multiple,
        "min_cert_coverage_multiple": F.col("cert_coverage_multiple")
        >= limits.min_coverage_multiple,
        "max_dominant_vendor_share": F.col("dominant_vendor_share") <= limits.max_vendor_share,
        "min_weighted_cert_present_rate": F.col("weighted_cert_present_rate")
        >= limits.min_weighted_cert_present_rate,
        "min_weighted_parse_success_rate": F.col("weighted_parse_success_rate")
        >= limits.min_weighted_parse_success_rate,
    }


def all_of(conditions) -> Column:
    combined = F.lit(True)
    for condition in conditions:
        combined = combined & condition
    return combined


def phase_progress(limits: Thresholds) -> Column:
    """Two readiness structs that do not depend on each other."""
    rules = checks(limits)
    diverse = rules["min_active_vendors"]
    listings = rules["min_listing_coverage_multiple"]
    certs = rules["min_cert_coverage_multiple"]
    return F.struct(
        F.struct(
            diverse.alias("ready"),
            F.struct(
                F.col("active_vendor_count"),
                F.lit(limits.min_active_vendors).alias("min_active_vendors"),
                diverse.alias("meets_source_diversity"),
            ).alias("checks"),
        ).alias("phase_1_acquisition_hardening"),
        F.struct(
            (listings & certs).alias("ready"),
            F.struct(
                F.col("listing_coverage_multiple"),
                F.col("cert_coverage_multiple"),
                F.lit(limits.min_coverage_multiple).alias("min_coverage_multiple"),
                listings.alias("meets_listing_coverage"),
                certs.alias("meets_cert_coverage"),
            ).alias("checks"),
        ).alias("phase_2_dataset_defensibility"),
    )


EXIT_METRICS = [
    "active_vendor_count",
    "listing_coverage_multiple",
    "cert_coverage_multiple",
    "dominant_vendor",
    "dominant_vendor_share",
    "weighted_cert_present_rate",
    "weighted_parse_success_rate",
]


def exit_evaluation(limits: Thresholds, extra_metrics: tuple[str, ...] = ()) -> Column:
    """``struct(ready, checks, metrics, thresholds)`` of the exit gate."""
    rules = checks(limits)
    used = {k: v for k, v in asdict(limits).items() if k != "min_new_rows"}
    return F.struct(
        all_of(rules.values()).alias("ready"),
        F.struct(*[rule.alias(name) for name, rule in rules.items()]).alias("checks"),
        F.struct(*EXIT_METRICS, *extra_metrics).alias("metrics"),
        F.struct(*[F.lit(v).alias(k) for k, v in used.items()]).alias("thresholds"),
    )


def status(limits: Thresholds, required: Required) -> Column:
    """First required gate that fails, in the fixed order, else ``ok``."""
    rules = checks(limits)
    covered = rules["min_listing_coverage_multiple"] & rules["min_cert_coverage_multiple"]
    return (
        F.when(F.lit(required.growth) & ~growth_check(limits), FAILED_GROWTH)
        .when(F.lit(required.min_active_vendors) & ~rules["min_active_vendors"], FAILED_SOURCES)
        .when(F.lit(required.coverage) & ~covered, FAILED_COVERAGE)
        .when(F.lit(required.exit) & ~all_of(rules.values()), FAILED_EXIT)
        .otherwise(PASSED)
    )


def gate_status(
    history: DataFrame, limits: Thresholds = Thresholds(), required: Required = Required()
) -> DataFrame:
    """Metrics and status of every run."""
    return run_metrics(history).withColumn("status", status(limits, required))


def enforce(summary: DataFrame) -> None:
    """Raise if the (one-row) summary did not pass; call it after writing the summary."""
    row = summary.select("status", F.to_json(F.struct("*")).alias("detail")).first()
    if row is not None and row["status"] != PASSED:
        raise GateFailed(row["status"], row["detail"])


def training_quality(report: DataFrame, minimum: float = MIN_JOINT_PARSE_RATE) -> DataFrame:
    """``gate, value, minimum, passes`` of the gate before training."""
    return _outcome(report, "quality", F.coalesce("joint_parse_rate", F.lit(0.0)), minimum)


def improvement(cv: DataFrame, minimum: float = MIN_IMPROVEMENT) -> DataFrame:
    """``gate, value, minimum, passes``: the model must beat the median baseline by at least the minimum."""
    return _outcome(cv, "model", F.col("baseline_cv_mae_log_mean") - F.col("cv_mae_log_mean"), minimum)


def _outcome(row: DataFrame, gate: str, value: Column, minimum: float) -> DataFrame:
    return row.select(
        F.lit(gate).alias("gate"), value.alias("value"), F.lit(float(minimum)).alias("minimum"), (value >= minimum).alias("passes")
    )


def enforce_gate(outcome: DataFrame) -> None:
    """Raise if the gate did not pass, or there is nothing to judge."""
    row = outcome.first()
    if row is None or not row["passes"]:
        raise GateFailed(f"failed_{row['gate']}_gate" if row else "failed_quality_gate", f"{row['value']} < {row['minimum']}" if row else "no report")


def enforce_training_quality(report: DataFrame | None, minimum: float = MIN_JOINT_PARSE_RATE) -> None:
    """The report must exist and its joint parse rate must reach the minimum."""
    if report is None:
        raise GateFailed("failed_quality_gate", "no quality report")
    enforce_gate(training_quality(report, minimum))
