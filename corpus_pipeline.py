"""The corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs.  All but the last return the columns of documents as they came.
Stages work on whole tables: null or empty texts and null ids pass through (an empty text is not
toxic, is no copy, holds no benchmark item, has no words to mix and so ends at the mixing stage);
an empty table gives an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, ngram_join, token_blocks, toxicity
from tidemark.llm.common import materialise, read, with_rows
from tidemark.llm.queries import tokenizer_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts toxic go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, Jaccard similarity of 0.8 or more."""
    return ngram_join.keep_one(docs, 5, 80, 100)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item's five-word shingles go."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times."""
    rows, row = with_rows(docs)
    return mixing.repeat_rows(rows, row).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; the rows are read back from them."""
    return token_blocks.token_output(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources to target weights", source_mix),
    ("token-ID output", token_files),
]

#: The classifier, the prefix trees and the tokenizer have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return docs
