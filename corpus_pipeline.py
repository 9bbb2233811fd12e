"""Documents judged, cleaned, deduplicated, decontaminated and packed by five of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetflow.llm import decontamination, line_dedup, packing, quality, queries, simhash
from facetflow.session import write_out


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that an earlier document or line has, short ones too; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs, fold_chars=1)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group; a row without an id only where all are.

    A row is a pair of id and text; rows that repeat both are one.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("digest"))
    keyed = docs.withColumn("_row", row)
    groups = simhash.near_duplicates(keyed, id_col="_row", shingle=3, radius=3)
    first = groups.where("_row = component_id").select(F.col("_row").alias("_kept")).distinct()
    kept = keyed.join(first, F.col("_row").eqNullSafe(F.col("_kept")), "left_semi")
    return kept.dropDuplicates(["_row"]).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    flagged = decontamination.flag(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.where(F.size("items") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences, with their ids."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("packing", pack),
]

#: Trained models, tokenizers and tilings are not for SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
