"""Documents to packed training sequences: quality rules, exact dedup, SimHash near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all but the last return the
columns of ``documents``. Null texts, empty tables, repeated rows and further columns are handled as the operators'
docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollhouse.llm import bin_packing, exact_dedup, paragraph_dedup, quality_rules, simhash
from tollhouse.llm.common import removed, shared_folder
from tollhouse.llm.queries import END_ID, SEQUENCE_TOKENS, tokenizer_path

#: No SQL: fingerprints, banding and packing can't be expressed. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality_rules.kept_rows(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.without_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in another document go from the text; the row stays, with the new length in n_chars."""
    shorter = paragraph_dedup.without_repeats(docs)
    return shorter.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else shorter


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and its place there."""
    return bin_packing.pack(docs, tokenizer_path(), END_ID, SEQUENCE_TOKENS)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("substring_dedup", substrings), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again, and goes from there
    once the next stage is written. What the last stage reads stays, as its rows are not computed yet."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return kept
        kept.write.parquet(f"{folder}/{i}-{name}")
        if i:
            removed(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
        docs = spark.read.schema(kept.schema).parquet(f"{folder}/{i}-{name}")
    return docs
