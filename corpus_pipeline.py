"""A corpus pipeline: five operators, each over all that the stage before kept.

``STAGES`` are (name, function) with function(spark, docs, sf_dir) -> DataFrame.
Each result is written as Parquet and read again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import common
from riskspark.llm import mixing, quality_rules, queries, sentencepiece, simhash, suffix
from riskspark.llm.common import documents, materialize
from riskspark.plans.cache import delete_folder

#: The suffix-array stage removes strings of so many bytes: shorter than a passage of 50 words in any of the
#: languages, which has 259 bytes and more in the given tables.
REPEATED_BYTES = 240
REPEATED_ANCHOR = 60

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_LEFT: dict[str, list[str]] = {}


def stage(function: Stage) -> Stage:
    """A stage that first deletes the working files of the stage before it.

    Those are of no more use: by contract its result was written before this one starts.
    """
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _LEFT.pop(sf_dir, []):
            delete_folder(spark, path)
        before = len(common.SCRATCH)
        out = function(spark, docs, sf_dir)
        _LEFT[sf_dir] = common.SCRATCH[before:]
        return out
    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that too many documents of a host share leave the rest."""
    return quality_rules.clean(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.first_of_groups(docs)


@stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under repeated strings go; a character that loses some of its bytes goes whole.

    A document that had text and has none left goes too.
    """
    return suffix.cleaned(docs, window=REPEATED_BYTES, anchor=REPEATED_ANCHOR)


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them, in training order."""
    return mixing.mixed_documents(docs)


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document of the mix."""
    return sentencepiece.encode(docs, queries.PIECE_MODEL, keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("mixing", mixture),
    ("SentencePiece", tokens),
]

#: Fingerprints, hash-ordered cuts of texts and piece ids are beyond SQL; tests/llm/test_pipeline.py
#: holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = materialize(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
