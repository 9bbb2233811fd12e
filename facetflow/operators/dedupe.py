"""Identity resolution: one row per stone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetflow.functions.keys import GEOMETRY_COLUMNS, dedupe_certificate, geometry_buckets

_CERTIFICATE = "_certificate"
TIE_BREAK = ["vendor", "source_url", "sku_or_stock", "price_usd"]


def with_dedupe_key(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add the identity columns; returns the frame and their names.

    Certified rows are identified by laboratory and number alone, so their
    geometry columns are null; the others by rounded geometry and grades.
    """
    keyed = df.withColumn(
        _CERTIFICATE, dedupe_certificate(F.col("cert_lab"), F.col("cert_number"))
    )
    uncertified = F.col(_CERTIFICATE).isNull()
    parts = {f"_{name}": bucket for name, bucket in geometry_buckets().items()}
    parts |= {f"_{name}": F.col(name) for name in ("intensity", "clarity", "shape")}
    keyed = keyed.withColumns({n: F.when(uncertified, c) for n, c in parts.items()})
    return keyed, [_CERTIFICATE, *parts]


def dedupe(df: DataFrame, missing_geometry: str = "merge") -> DataFrame:
    """Latest row per identity.

    ``missing_geometry="merge"`` treats null geometry as equal, so uncertified
    rows whose known parts agree are one stone; ``"keep"`` leaves uncertified
    rows with any null measure alone.

    The rank filter is planned as a partial group limit before the shuffle:
    every task sends at most one row per identity, so an identity that holds a
    third of all rows costs one row per task. Date ties are settled by vendor,
    URL, stock number and price, then by every other column, so the result
    does not depend on input order.
    """
    if missing_geometry not in ("merge", "keep"):
        raise ValueError(f"missing_geometry must be merge or keep, not {missing_geometry!r}")
    columns = df.columns
    keyed, identity = with_dedupe_key(df)
    rest = [c for c in columns if c not in TIE_BREAK and c != "date_seen"]
    latest_first = [F.col("date_seen").desc_nulls_last()]
    latest_first += [F.col(c).asc_nulls_last() for c in TIE_BREAK + rest if c in columns]
    rank = F.row_number().over(Window.partitionBy(*identity).orderBy(*latest_first))
    if missing_geometry == "merge":
        return keyed.withColumn("_rank", rank).where("_rank = 1").select(*columns)

    incomplete = F.col(_CERTIFICATE).isNull() & (
        F.greatest(*[F.col(c).isNull().cast("int") for c in GEOMETRY_COLUMNS]) == 1
    )
    merged = keyed.where(~incomplete).withColumn("_rank", rank).where("_rank = 1")
    alone = keyed.where(incomplete)
    return merged.select(*columns).unionByName(alone.select(*columns))
