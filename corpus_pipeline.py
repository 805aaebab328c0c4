"""Training-data pipeline over ``documents``: five stages, each one operator of ``costlake.llm``.

1. quality_rules: documents that the adaptive rules reject go.
2. quality_classifier: documents that the co-trained classifier rejects (low quality, toxic) go. It is fitted
   on a bounded sample of this stage's labelled documents.
3. near_duplicates: of each group of near copies, linked by a Jaccard similarity of 0.8 or more of
   five-word shingles, the document of the least id stays.
4. repeated_passages: bytes covered by a 100-byte string that also starts earlier in the corpus are cut out
   of the texts; every document stays, also one of which no text is left (then empty).
5. packing: what is left is packed into windows of 1024 tokens; a row for each piece.

Each stage works on all rows of the one before and returns whole rows; all but the last return the columns
of documents. Nulls, repeated rows and empty tables are handled as the operators say. Between the stages
``run`` writes tables to the shared folder, so that a lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from costlake.llm import cotraining, jaccard, packing, quality_rules, repeats
from costlake.llm.frames import stored


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and their group's adaptive thresholds."""
    return quality_rules.filtered(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on the labels of this stage's documents, takes for good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    return cotraining.filtered(docs, cotraining.train(docs, labels))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.representatives(docs)


def repeated_passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without bytes of strings that also start earlier."""
    return repeats.deduplicated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all windows."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("repeated_passages", repeated_passages_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
