"""The corpus pipeline: quality classifier, exact dedup, near-duplicate join, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next one's
docs. All but the last return the columns of documents. Null texts are empty ones; an empty table stays empty. Rows
that repeat count each up to exact dedup, which keeps one; ties are broken as each operator's module says; texts of any length
are read whole; extra columns come along to the last stage but for names that it gives itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import bpe, exact_dedup, jaccard, mixing, quality
from tidewell.llm.common import materialize, release

#: SQL cannot express the classifier and BPE; tests/llm hold run() as a whole, and its stages, against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more on five-word shingles the smallest doc_id stays."""
    return jaccard.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mixed_documents(docs)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, token_ids, decoded of each row."""
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", byte_pairs),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
        release(before)  # the table of the stage before, once the next one is written
    return STAGES[-1][1](spark, docs, sf_dir)
