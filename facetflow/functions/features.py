"""Feature expressions of the price model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Model columns, hinge knots, sentinel and bucket width.
CATEGORICAL = ["intensity", "clarity", "shape", "polish", "symmetry", "fluorescence", "cert_lab"]
NUMERIC = ["carat", "length_mm", "width_mm", "depth_mm", "table_pct", "depth_pct", "l_w_ratio"]
KNOTS = [1.0, 1.5, 2.0, 3.0, 4.0, 5.0]
MISSING = "<MISSING>"
BUCKET_WIDTH = 0.25

# Fields whose gaps make a prediction uncertain.
SPARSE_FIELDS = [
    "polish",
    "symmetry",
    "fluorescence",
    "table_pct",
    "depth_pct",
    "length_mm",
    "width_mm",
    "depth_mm",
]


def hinge_name(knot: float) -> str:
    return f"carat_over_{knot}".replace(".", "_")


FEATURES = CATEGORICAL + NUMERIC + ["carat_sq"] + [hinge_name(k) for k in KNOTS]


def with_hinges(df: DataFrame) -> DataFrame:
    carat = F.col("carat")
    hinges = {hinge_name(k): F.greatest(carat - k, F.lit(0.0)) for k in KNOTS}
    return df.withColumns({"carat_sq": carat * carat, **hinges})


def log_price(price: Column) -> Column:
    return F.ln(price)


def carat_bucket(carat: Column) -> Column:
    return F.rint(carat / BUCKET_WIDTH) * BUCKET_WIDTH


def or_missing(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def sparse_count() -> Column:
    total = F.lit(0)
    for name in SPARSE_FIELDS:
        total = total + F.col(name).isNull().cast("int")
    return total


def not_lab_grown(df: DataFrame) -> DataFrame:
    """Keeps rows whose flag is false or unknown."""
    return df.where(~F.col("is_lab_grown").eqNullSafe(F.lit(True)))


def model_rows(df: DataFrame) -> DataFrame:
    """Rows a model may learn from, with ``log_price``.

    Price and carat must be positive: the logarithm of either is a term.
    """
    kept = not_lab_grown(df).where((F.col("price_usd") > 0) & (F.col("carat") > 0))
    return kept.withColumn("log_price", log_price(F.col("price_usd")))


def model_row_counts(df: DataFrame) -> DataFrame:
    """One row: all rows, those a model may use, and why the others may not."""
    grown = F.col("is_lab_grown").eqNullSafe(F.lit(True))
    gap = F.col("price_usd").isNull() | F.col("carat").isNull()
    low = (F.col("price_usd") <= 0) | (F.col("carat") <= 0)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(grown).alias("lab_grown"),
        F.count_if(~grown & gap).alias("without_price_or_carat"),
        F.count_if(~grown & ~gap & low).alias("not_positive"),
        F.count_if(~grown & ~gap & ~low).alias("usable"),
    )


def feature_table(df: DataFrame) -> DataFrame:
    """The 7 categorical, 7 numeric, squared and hinge columns of every model row."""
    base = with_hinges(model_rows(df))
    filled = base.withColumns({c: or_missing(F.col(c)) for c in CATEGORICAL})
    carried = [c for c in ("vendor", "source_url", "date_seen") if c in df.columns]
    return filled.select(*carried, *FEATURES, "log_price")
