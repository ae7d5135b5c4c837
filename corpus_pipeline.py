"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next one's documents. All but the last return the columns of the documents. What a stage has staged is deleted
when the next one begins, whose documents are written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lateline.llm import exact, jaccard, mixing, packing, quality
from lateline.llm.common import read
from lateline.sources.staging import discard, noted, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Smaller units than the operator's own: less memory in a long-lived executor, for more disk.
QUALITY_UNIT_BYTES = 8_000_000

#: What the last stage has staged.
_left: list[str] = []


def tidy(function: Stage) -> Stage:
    """The stage, which first deletes what the one before has staged: its result is written, as ``docs`` shows."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left)
        with noted() as paths:
            result = function(spark, docs, sf_dir)
        _left[:] = paths
        return result

    return run


@tidy
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of good text does not reject."""
    return quality.without_rejected(docs, read(spark, sf_dir, "labels"), unit_bytes=QUALITY_UNIT_BYTES)


@tidy
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.without_copies(docs)


@tidy
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: op2's fingerprints and their index, confirmed, then what they miss."""
    return jaccard.without_near_copies(docs, nameless=False)


@tidy
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


@tidy
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of a document in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: SQL expresses neither tokenizing nor fingerprints; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs, before = read(spark, sf_dir, "documents"), []
    for name, function in STAGES:
        with noted() as paths:
            result = function(spark, docs, sf_dir)
            inner = len(paths)
            docs = stage(result, name.replace("_", "-"))
        discard(spark, before)
        before = paths[inner:]
    return docs
