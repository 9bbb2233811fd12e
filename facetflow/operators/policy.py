"""When to trust a prediction: reject rule and error bands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetflow.functions.features import SPARSE_FIELDS, sparse_count
from facetflow.operators.model import Model
from facetflow.operators.quantiles import global_quantiles

# Reject threshold and the wording of the rule.
REJECT_MISSING = 4
POLICY_TEXT = (
    "Reject predictions when sparse-feature count >= threshold; otherwise attach uncertainty band."
)


@dataclass(frozen=True)
class Policy:
    medium_error: float
    high_error: float
    reject_missing: int = REJECT_MISSING


def error_bands(residuals: DataFrame, error: str = "abs_error") -> DataFrame:
    """One row: exact 75th and 90th percentile of the absolute errors."""
    return global_quantiles(residuals, error, [0.75, 0.9], ["p75", "p90"])


def missing_distribution(rows: DataFrame) -> DataFrame:
    """Median and 90th percentile of the missing counts, from nine counters."""
    counts = rows.groupBy(sparse_count().alias("missing")).count()
    picked = F.percentile("missing", F.array(F.lit(0.5), F.lit(0.9)), F.col("count"))
    return counts.agg(picked.alias("_p")).select(
        F.get("_p", F.lit(0)).alias("p50"), F.get("_p", F.lit(1)).alias("p90")
    )


def uncertainty_policy(rows: DataFrame, residuals: DataFrame) -> tuple[Policy, DataFrame]:
    """The policy, and its one-row report."""
    bands = error_bands(residuals).first()
    policy = Policy(bands["p75"], bands["p90"])
    report = missing_distribution(rows).select(
        F.array(*[F.lit(f) for f in SPARSE_FIELDS]).alias("sparse_feature_fields"),
        F.lit(policy.reject_missing).alias("reject_if_missing_feature_count_ge"),
        F.lit(policy.high_error).alias("high_uncertainty_abs_log_error_threshold"),
        F.lit(policy.medium_error).alias("medium_uncertainty_abs_log_error_threshold"),
        F.lit(POLICY_TEXT).alias("policy"),
        F.struct("p50", "p90").alias("sparse_feature_missing_distribution"),
    )
    return policy, report


def score(df: DataFrame, model: Model, policy: Policy) -> DataFrame:
    """Predicted price with its band; null where the policy rejects.

    One projection of built-in expressions.
    """
    scored = df.withColumns(
        {
            "missing_count": sparse_count(),
            "_log": F.when(F.col("carat") > 0, model.predict()),
        }
    ).withColumn("reject", F.col("missing_count") >= policy.reject_missing)
    kept = F.when(~F.col("reject"), F.col("_log"))
    return scored.withColumns(
        {
            "predicted_log_price": kept,
            "predicted_price": F.exp(kept),
            "price_low": F.exp(kept - policy.high_error),
            "price_high": F.exp(kept + policy.high_error),
            "price_low_medium": F.exp(kept - policy.medium_error),
            "price_high_medium": F.exp(kept + policy.medium_error),
        }
    ).drop("_log")
