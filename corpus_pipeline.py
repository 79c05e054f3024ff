"""The corpus pipeline: rules, line dedup, near duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns rows; all but the last return
the columns of documents. Between stages rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeloom.llm import bpe, jaccard_join, line_dedup, quality_rules, source_mixing
from gaugeloom.llm.queries import table, tokenizer_path
from gaugeloom.scale import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that other documents keep."""
    return line_dedup.drop_lines(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return source_mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return bpe.token_digests(docs, tokenizer_path())


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", unique_lines),
    ("jaccard_join", distinct_documents),
    ("source_mixing", mixed_sources),
    ("bpe", tokens),
]

# The tokenizer and the hashed ratios are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
