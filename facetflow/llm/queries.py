"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetflow.llm import (
    chat,
    dac,
    decontamination,
    license_scan,
    line_dedup,
    neighbours,
    packing,
    quality,
    repair,
    resharding,
    simhash,
    spelling,
    warc,
)
from facetflow.llm.oracles import ORACLES
from facetflow.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

SHARDS = 24
OLD_SHARDS = 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_warc(spark, sf_dir):
    path = scratch_path(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path).where("kind = 'record'")

    def number(column):
        return F.expr(f"try_cast(regexp_extract({column}, '<urn:page:(.*)>', 1) as bigint)")

    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


def op3_packing(spark, sf_dir):
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step"
    )


def op4_chat(spark, sf_dir):
    said = f"{chat.END}{chat.START}assistant ok"
    extra = spark.createDataFrame(
        [(-1, turn, role, said) for turn, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_chats(rows)).withColumnRenamed("conv", "conv_id")


def op5_neighbours(spark, sf_dir):
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    flagged = decontamination.flag(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return flagged.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.size("items") > 0).alias("contaminated"),
        F.array_join("items", ",").alias("items"),
        "coverage",
    )


def op9_resharding(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    placed = resharding.reshard(docs, F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS)), SHARDS)
    text = F.coalesce("row.text", F.lit(""))
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_line_dedup(spark, sf_dir):
    return line_dedup.report(_table(spark, sf_dir, "documents"), fold_chars=1)


def op11_spelling(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_dac(spark, sf_dir):
    path = scratch_path(spark, "ids")
    dac.write_ids(_table(spark, sf_dir, "documents"), tokenizer_path(), path)
    return dac.read_documents(spark, path, with_ids=False)


def op13_repair(spark, sf_dir):
    damaged = repair.damage(_table(spark, sf_dir, "conversations"))
    return repair.repair(damaged).withColumnRenamed("conv", "conv_id")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_warc": op2_warc,
    "op3_packing": op3_packing,
    "op4_chat": op4_chat,
    "op5_neighbours": op5_neighbours,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_resharding": op9_resharding,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling": op11_spelling,
    "op12_dac": op12_dac,
    "op13_repair": op13_repair,
}
