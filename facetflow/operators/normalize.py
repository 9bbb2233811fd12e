"""Standardise any feed into the listing record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow import schema
from facetflow.functions import text


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    return text.to_number(F.col(name))


def _date(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return text.to_date(F.col(name))


def _canonical(df: DataFrame, field: T.StructField) -> Column:
    name = field.name
    if name not in df.columns:
        return F.lit(None).cast(field.dataType)
    if name in schema.NUMERIC_COLUMNS:
        return _number(df, name)
    if name == "date_seen":
        return _date(df, name)
    if name in schema.BOOLEAN_COLUMNS:
        return F.col(name).try_cast("boolean")
    if name in schema.TITLE_CASE_COLUMNS:
        return text.title_case(text.blank_to_null(F.col(name)))
    if name in schema.UPPER_CASE_COLUMNS:
        return F.upper(text.blank_to_null(F.col(name)))
    return F.col(name).cast("string")


def normalize(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Exactly the canonical columns, in order and typed; ``keep`` adds others.

    Missing columns become nulls, values that do not parse become nulls, extra
    columns are dropped. One projection, no shuffle.
    """
    extra = [c for c in keep or [] if c in df.columns]
    columns = [_canonical(df, f).alias(f.name) for f in schema.LISTING_SCHEMA]
    return df.select(*columns, *extra)


def fill_vendor(df: DataFrame, alias: str) -> DataFrame:
    """Create the vendor column, or fill its null and blank values, with the alias."""
    if "vendor" not in df.columns:
        return df.withColumn("vendor", F.lit(alias))
    return df.withColumn("vendor", F.coalesce(text.blank_to_null(F.col("vendor")), F.lit(alias)))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union aligned by column name; columns absent from a frame become nulls."""
    if not frames:
        raise ValueError("no input to union")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
