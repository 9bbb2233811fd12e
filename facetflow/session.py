"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Pieces of files, in bytes, and row groups of tables that are read in such pieces.
PIECE = 8 << 20


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app_name: str = "facetflow"):
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is not None:
        return folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="facetflow-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write a small ``df`` to the shared checkpoint folder and go on from the copy.

    Reliable checkpoint: the copy survives the loss of any executor.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def write_out(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a large ``df`` to the shared folder as Parquet and read it back.

    Unlike a checkpoint, the copy can be read by column and filtered at the
    scan, which is what several passes over the same rows need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def small_pieces(spark: SparkSession) -> Iterator[None]:
    """Files are read in pieces of ``PIECE`` by the actions inside.

    For jobs whose tasks sort whole rows of what they read: packed columns grow
    many times over as rows, so a piece of the usual size does not fit a task.
    A Parquet file is cut between its row groups only.
    """
    name = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(PIECE))
    try:
        yield
    finally:
        spark.conf.set(name, usual)
