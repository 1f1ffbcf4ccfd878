"""From raw documents to packed sequences: quality, exact duplicates, near duplicates, packing.

Each stage works on all that its predecessor kept and, but for the last, returns the columns of ``documents``. Stages are
written as Parquet and read again in between, so a lost executor costs one stage's tasks at most.

Defined results: null and empty texts are documents without words, which the quality stage judges like any other; rows that
repeat both id and text are one document after the exact stage; rows with a null id are told apart by their text, and their
near duplicates stay; columns of ``documents`` that are not used pass through all stages but the last; an empty table gives
an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowbench.llm import exact_dedup, near_dedup, packing, quality
from flowbench.session import write_through

TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    ratings = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grader = quality.fit_quality(docs, ratings, quality.grade_of(F.col("quality"), F.col("toxic")))
    return quality.grade_documents(docs, grader).filter("kept").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, up to white space, the one with the smallest id."""
    kept = exact_dedup.exact_dedup(docs).filter("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("__sha", F.sha2(exact_dedup.normalised("text").cast("binary"), 256))
    return keyed.dropDuplicates(["__id", "__sha"]).join(kept, ["__id", "__sha"], "left_semi").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words agree by 0.8 or more."""
    gone = near_dedup.near_dedup(docs, width=5, percent=80).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1,024 tokens that hold the sources in their shares of all tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).select("doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("packing", packing_stage)]

# The classifier, the signatures and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
