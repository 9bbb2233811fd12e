"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetflow.session import write_out


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (one node of its component, the same for all) for every node of ``edges`` (u, v).

    Every round draws new priorities, maps a node to the first of its neighbours
    or itself, and goes on with the edges between the images. About half of the
    nodes go, whatever the shape (along a chain, too); the maps are then read
    backwards. Rounds are written to the shared folder. Nothing but the question
    whether edges are left reaches the driver. Loops are allowed and keep their
    node; repeated edges count once; null ends are left out.
    """
    edges = write_out(edges.select("u", "v").dropna().distinct(), "edges")
    maps = []
    while not edges.isEmpty():

        def drawn(c: str, seed: int = len(maps)):
            return F.struct(F.xxhash64(F.lit(seed), c).alias("p"), F.col(c).alias("node"))

        both = edges.union(edges.select("v", "u"))
        nearest = both.groupBy("u").agg(F.min(drawn("v")).alias("near"))
        first = nearest.select(F.col("u").alias("node"), F.least("near", drawn("u")).getField("node").alias("root"))
        first = write_out(first, "contraction")
        maps.append(first)
        left = edges.join(first.select(F.col("node").alias("u"), F.col("root").alias("_u")), "u")
        moved = left.join(first.select(F.col("node").alias("v"), F.col("root").alias("_v")), "v")
        moved = moved.where("_u <> _v").select(F.least("_u", "_v").alias("u"), F.greatest("_u", "_v").alias("v"))
        edges = write_out(moved.distinct(), "edges")
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = maps.pop()
    while maps:
        later = out.select(F.col("node").alias("root"), F.col("root").alias("_later"))
        out = maps.pop().join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root"))
    return out
