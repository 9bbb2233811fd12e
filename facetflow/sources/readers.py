"""Readers. Text sources are read as strings and aligned by column name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetflow.operators.normalize import fill_vendor, normalize, union_by_name
from facetflow.schema import HISTORY_SCHEMA, LISTING_SCHEMA, TEXT_LISTING_SCHEMA

IMPORT_PREFIX = "import:"


class SourceMissing(FileNotFoundError):
    pass


class SourceEmpty(ValueError):
    pass


class UnsupportedFormat(ValueError):
    pass


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a CSV file has records that go on in the next line.

    Quotes inside quotes are doubled, so a record that ends with its line has an
    even number of them; one pass over the lines, ended by the first odd one.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_table(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """CSV, JSON lines or Parquet by suffix.

    CSV columns are found by the file's own header, because a directory read
    with one schema maps columns by position. Only empty text is null: words
    such as ``None`` are grades here. Files with line breaks inside quotes are
    read whole, all others in pieces; ``multiline`` says which, unless it is
    None, and the file is looked through.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        whole = has_broken_lines(spark, path) if multiline is None else multiline
        reader = spark.read.option("header", True).option("inferSchema", False)
        reader = reader.option("quote", '"').option("escape", '"').option("multiLine", whole)
        return reader.csv(path)
    if suffix in ("json", "jsonl"):
        return spark.read.schema(TEXT_LISTING_SCHEMA).json(path)
    if suffix == "parquet":
        return spark.read.parquet(path)
    raise UnsupportedFormat(f"unsupported format: {path}")


def _try_read(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame | None:
    try:
        return read_table(spark, path, multiline)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_present(spark: SparkSession, paths: list[str], multiline: bool | None = None) -> DataFrame:
    """Union of the standardised inputs that exist; an error if none does."""
    frames = [f for f in (_try_read(spark, p, multiline) for p in paths) if f is not None]
    if not frames:
        raise SourceMissing(f"none of the inputs exists: {', '.join(paths)}")
    return union_by_name([normalize(f) for f in frames])


def feed_tokens(text: str) -> list[str]:
    """Comma-separated feed names, trimmed, in lower case, blanks removed."""
    return [t.strip().lower() for t in text.split(",") if t.strip()]


def import_alias(token: str) -> str | None:
    """Alias of an ``import:<alias>`` token, None for other tokens."""
    if not token.startswith(IMPORT_PREFIX):
        return None
    alias = token[len(IMPORT_PREFIX) :].strip()
    if not alias:
        raise ValueError("an import token needs an alias, as in import:partner")
    return alias


def feed_folder(token: str) -> str:
    """Folder-safe feed name; a colon is not allowed in Hadoop paths."""
    return token.replace(":", "_")


def read_import(spark: SparkSession, alias: str, folder: str, multiline: bool | None = None) -> DataFrame:
    """``<folder>/<alias>.csv`` with the vendor filled from the alias."""
    path = f"{folder}/{alias}.csv"
    feed = _try_read(spark, path, multiline)
    if feed is None:
        raise SourceMissing(f"import feed not found: {path}")
    if feed.isEmpty():
        raise SourceEmpty(f"import feed is empty: {path}")
    return fill_vendor(feed, alias)


def header_only(spark: SparkSession) -> DataFrame:
    """A feed with every column and no row."""
    return spark.createDataFrame([], LISTING_SCHEMA)


@dataclass(frozen=True)
class Skipped:
    feed: str
    reason: str


#: What may stop a feed without stopping its run.
ABSENT, EMPTY, UNSUPPORTED, UNREADABLE = "absent", "empty", "unsupported", "unreadable"
READ = "read"


def _reason(error: Exception) -> str:
    if isinstance(error, SourceMissing):
        return ABSENT
    if isinstance(error, SourceEmpty):
        return EMPTY
    if isinstance(error, UnsupportedFormat):
        return UNSUPPORTED
    if isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND":
        return ABSENT
    return UNREADABLE


def read_run(
    spark: SparkSession, feeds: dict[str, str], multiline: bool | None = None
) -> tuple[DataFrame | None, list[Skipped]]:
    """All feeds of a run with a ``feed`` column, and those that gave nothing.

    ``feeds`` maps a feed name to its path; an ``import:<alias>`` has the folder
    of its file. Feeds that are absent, empty, of an unknown format or without a
    readable schema do not stop the run; they are reported. Anything else, such
    as a store that can't be reached, does.
    """
    frames, skipped = [], []
    for feed, path in feeds.items():
        try:
            alias = import_alias(feed)
            frame = read_table(spark, path, multiline) if alias is None else read_import(spark, alias, path, multiline)
            if frame.isEmpty():
                raise SourceEmpty(feed)
        except (AnalysisException, ValueError, SourceMissing) as error:
            skipped.append(Skipped(feed, _reason(error)))
            continue
        frames.append(normalize(frame).withColumn("feed", F.lit(feed)))
    return (union_by_name(frames) if frames else None), skipped


def feed_outcomes(spark: SparkSession, rows: DataFrame | None, skipped: list[Skipped]) -> DataFrame:
    """``feed, status, rows`` of every feed of a run: what was read, and why others gave nothing."""
    none = spark.createDataFrame([(s.feed, s.reason, 0) for s in skipped], "feed string, status string, rows long")
    if rows is None:
        return none
    read = rows.groupBy("feed").agg(F.count("*").alias("rows"))
    return read.select("feed", F.lit(READ).alias("status"), "rows").unionByName(none)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The whole history; filters on ``run_id`` prune partitions."""
    try:
        return spark.read.schema(HISTORY_SCHEMA).parquet(path).select(*HISTORY_SCHEMA.fieldNames())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], HISTORY_SCHEMA)
        raise


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages: a table with at least ``url, html``."""
    return spark.read.parquet(path)
