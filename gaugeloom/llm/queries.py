"""Named queries of the text operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.llm import (
    bpe,
    fill_middle,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    phrase_dedup,
    quality_classifier,
    quality_rules,
    source_mixing,
    substring_dedup,
    token_alignment,
    url_filter,
)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary that is installed with the tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(table(spark, folder, "documents"), tokenizer_path())


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = quality_classifier.fit_or_constant(docs, labels.filter(fold != 1))
    return quality_classifier.score_documents(docs, model).select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.drop_repeated_bytes(table(spark, folder, "documents")).drop("kept")


def op4_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, folder, "documents"))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link_report(table(spark, folder, "documents"))


def op7_phrase_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_dedup.drop_repeated_phrases(table(spark, folder, "documents")).drop("kept")


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing.mix_report(table(spark, folder, "documents")).drop("copies")


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return token_alignment.link_report(table(spark, folder, "documents"), *paths)


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = language_id.fit(docs.filter(fold != 2))
    return language_id.predict(docs, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted"
    )


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.transform_digests(table(spark, folder, "documents"))


QUERIES = {
    function.__name__: function
    for function in (
        op1_bpe,
        op2_quality_classifier,
        op3_suffix_dedup,
        op4_winnowing,
        op5_line_dedup,
        op6_jaccard_join,
        op7_phrase_dedup,
        op8_source_mixing,
        op9_url_filter,
        op10_quality_rules,
        op11_token_alignment,
        op12_language_id,
        op13_fill_middle,
    )
}
