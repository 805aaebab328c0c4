"""The registered queries of the corpus operators: thin calls with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm import bpe, chat, cotraining, fingerprint, html, jaccard, packing, quality_rules, repair, repeats, resampling, sharding, sql, warc

#: Bytes of text in a shard of op3_sharding.
SHARD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of five-word shingle sets with a Jaccard similarity of 0.8 or more."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), 80, 5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 1024 tokens, each in the corpus's own mixture of sources."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, 1024, 128)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document; a shard holds at most 1 MiB of text."""
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores by a classifier that is co-trained on the labels, and whether it is kept."""
    docs = table(spark, sf_dir, "documents")
    return cotraining.scored(docs, cotraining.train(docs, table(spark, sf_dir, "labels")))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprint.edited(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and whether the adaptive rules keep it."""
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html.main_text(table(spark, sf_dir, "pages"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes covered by a 100-byte string that also starts earlier."""
    return repeats.removed(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from the output."""
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.segments(rows), dealt=True)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text encoded and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as seekable WARC bundles and read back from them."""
    folder = warc.write(table(spark, sf_dir, "pages"), 0)
    return warc.read(spark, folder).where("record_type in ('response', 'revisit')").select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule and repaired at the least cost."""
    rows = table(spark, sf_dir, "conversations")
    return repair.report(rows, repair.damaged(rows))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents, drawn by their likeness to the benchmark's n-grams."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_jaccard": op1_jaccard,
    "op2_packing": op2_packing,
    "op3_sharding": op3_sharding,
    "op4_cotraining": op4_cotraining,
    "op5_fingerprint": op5_fingerprint,
    "op6_quality_rules": op6_quality_rules,
    "op7_html": op7_html,
    "op8_repeats": op8_repeats,
    "op9_chat": op9_chat,
    "op10_bpe": op10_bpe,
    "op11_warc": op11_warc,
    "op12_repair": op12_repair,
    "op13_resampling": op13_resampling,
}

#: DuckDB SQL of those queries that SQL can express; tests hold the others against brute force or libraries.
ORACLE: dict[str, str] = {
    "op1_jaccard": sql.JACCARD,
    "op3_sharding": sql.sharding(SHARD_BYTES),
    "op6_quality_rules": sql.quality_rules(quality_rules.RATIOS, quality_rules.REACH, quality_rules.GAMMA, quality_rules.LEAST),
    "op9_chat": sql.chat(),
    "op11_warc": sql.warc(),
    "op12_repair": sql.repair(),
    "op13_resampling": sql.resampling(),
}
