"""The corpus pipeline: quality, toxicity, exact copies, near copies, packing.

Every stage takes (spark, docs, sf_dir), calls one training-data operator on all that the stage before
it kept, and returns a DataFrame, which :func:`run` writes as Parquet in the shared folder and reads
again as the next stage's documents.  All stages but the last return the columns of documents.  Nulls,
empty and repeated rows and extra columns are handled as each operator's docstring says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import staged
from tessera.llm.exact_dedup import drop_exact_copies
from tessera.llm.order_minhash import drop_near_copies
from tessera.llm.packing import pack_documents
from tessera.llm.quality import keep_quality
from tessera.llm.queries import read, tokenizer_path
from tessera.llm.toxicity import drop_toxic


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant, fitted on their labelled rows, rejects go."""
    return keep_quality(docs, read(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier calls toxic go."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest doc_id stays."""
    return drop_near_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized documents with their sequence and offset."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

# The classifiers, sketches and the tokenizer are not expressible in SQL; tests/llm compares the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
