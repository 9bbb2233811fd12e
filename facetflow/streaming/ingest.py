"""Extend the history as batches arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetflow.schema import HISTORY_SCHEMA


def ingest_stream(
    stream: DataFrame,
    to_history: Callable[[DataFrame], DataFrame],
    history_path: str,
    progress_path: str,
) -> None:
    """Take in everything that has arrived, then stop.

    ``to_history`` turns arriving rows into stamped history rows. The batch id
    is part of the written partition and a batch overwrites only its own
    partitions, so a batch that is repeated after a failure replaces itself.
    Land feeds as Parquet: a stream of CSV files maps columns by position.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        stamped = to_history(batch)
        aligned = stamped.select(
            *[
                F.col(f.name)
                if f.name in stamped.columns
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in HISTORY_SCHEMA
            ],
            F.lit(batch_id).alias("batch_id"),
        )
        writer = aligned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_id", "batch_id").parquet(history_path)

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
