"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import (
    chat_format,
    hard_negatives,
    html_text,
    lm_score,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_model,
    quality_rules,
    substring_dedup,
    token_alignment,
    vector_join,
)
from tamis.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return packing.pack(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_model.classify(docs, labels)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ngram_join.Rule(words=4, percent=85)
    return ngram_join.groups(table(spark, sf_dir, "documents"), rule)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.collapse(table(spark, sf_dir, "conversations"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.cleaned(table(spark, sf_dir, "documents")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    vocabularies = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
    return token_alignment.summary(table(spark, sf_dir, "documents"), *vocabularies)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_pii": op3_pii,
    "op4_quality_model": op4_quality_model,
    "op5_lm_score": op5_lm_score,
    "op6_html_text": op6_html_text,
    "op7_vector_join": op7_vector_join,
    "op8_ngram_join": op8_ngram_join,
    "op9_quality_rules": op9_quality_rules,
    "op10_chat_format": op10_chat_format,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}
