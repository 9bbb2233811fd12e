"""Null-safe lookup joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", fixed: bool = False) -> DataFrame:
    """Null-safe equi-join of many rows with a lookup table.

    The table is broadcast only where its definition fixes its size (``fixed``);
    otherwise Spark goes by bytes, and adaptive execution splits skewed keys.
    """
    renamed = table
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
    matches = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    if fixed:
        renamed = F.broadcast(renamed)
    joined = rows.join(renamed, reduce(lambda a, b: a & b, matches), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"_right_{key}" for key in keys])
