"""A training corpus from raw documents: good ones, in a known language, once each, mixed and packed.

Every stage's result is written before the next one starts, which removes what the one before left in working
folders. A null or empty text goes with the quality rules; rows that repeat an id are documents of their own
up to near-dedup, which keeps one of equal ones; rows without an id are kept. Ties are settled by id
or by a hash of it. An empty table gives no rows at any stage, and without labels the base rules alone
decide on quality.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import materialize, noted_work, remove_work
from . import language, mixing, packing, quality, simhash
from .common import table, tidy

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Words whose ids a packing process remembers: few, as executors come out of four stages with their heaps full.
REMEMBERED_WORDS = 100_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the learned rules keep."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that some language claims."""
    return language.understood_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return simhash.distinct_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: left out, in part, once or twice."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs, packing.tokenizer_path(), remembered=REMEMBERED_WORDS)


#: Working folders of the stage that ran last.
_left: list[str] = []


def _stage(function: Stage) -> Stage:
    """The stage, after removing what the one before it left behind: its result is written by now. What
    ``docs`` itself still reads, as it was not, stays."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tidy(spark)
        read = " ".join(docs.inputFiles())
        remove_work(spark, [path for path in _left if path.rsplit("/", 1)[1] not in read])
        with noted_work() as made:
            result = function(spark, docs, sf_dir)
        _left[:] = made
        return result

    run_stage.__doc__ = function.__doc__
    return run_stage


STAGES = [
    ("quality rules", _stage(quality_rules)),
    ("language id", _stage(language_id)),
    ("simhash near-dedup", _stage(near_dedup)),
    ("source mix", _stage(source_mix)),
    ("packing", _stage(packed_sequences)),
]

#: The language and packing stages can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each over the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialize(docs, f"pipeline-{k}")
    return docs
