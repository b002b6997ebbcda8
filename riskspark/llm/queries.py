"""Queries of this folder's operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import (conversations, decontaminate, embedding_dedup, mixing, oracle, quality_lm, quality_rules,
                           sentencepiece, simhash, spelling, substring, suffix, token_counts, toxicity)
from riskspark.llm.common import documents
from riskspark.sources.tables import read_table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(documents(spark, sf_dir, "doc_id", "text"), PIECE_MODEL)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.classify(documents(spark, sf_dir, "doc_id", "lang", "text"),
                               read_table(spark, sf_dir, "labels", ["doc_id", "quality"]),
                               folds=quality_lm.FOLDS, prior=quality_lm.PRIOR)


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])
    return found.select("row.doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    return quality_rules.verdicts(docs, ["doc_id"]).select(
        "row.doc_id", *quality_rules.MEASURES, "base_failed", "kept", "removed_words")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    return mixing.curriculum(docs, ["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target", "taken", "position", "position_again")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir, "doc_id", "text"), BYTE_VOCABULARY)


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])
    return found.select("row.doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256", "n_spans",
                        F.col("n_marks").alias("n_paths"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir, "doc_id", "text"),
                           read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return conversations.repair(conversations.damage(rows), rows)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(documents(spark, sf_dir, "doc_id", "text"),
                                        read_table(spark, sf_dir, "benchmark", ["item_id", "text"]), ["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir, "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_suffix_array": op3_suffix_array,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_token_counts": op8_token_counts,
    "op9_substring": op9_substring,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontamination": op12_decontamination,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op5_quality_rules": oracle.QUALITY_RULES,
    "op6_mixing": oracle.MIXING,
    "op12_decontamination": oracle.DECONTAMINATION,
    "op13_spelling_variants": oracle.SPELLING,
}
