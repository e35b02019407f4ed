"""Corpus pipeline: quality filter, toxicity filter, near-duplicates, benchmark
decontamination, packing. Every stage takes (spark, docs, sf_dir), its result
is written as Parquet and read again as the next stage's docs; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from cartwise.llm import common, decontam, packing, quality, simhash, toxicity
from cartwise.llm.queries import tokenizer_path


#: Folders that the latest stage has written between its steps.
_STEPS: list[str] = []


def stage(fn):
    """A stage begins by deleting the step folders of the one before, whose result
    has been written by then."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark, _STEPS)
        with common.noting(_STEPS):
            return fn(spark, docs, sf_dir)

    return run_stage


@stage
def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    return quality.drop_poor(docs, model)


@stage
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs, shingle_words=3, max_distance=3)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    return decontam.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece."""
    return packing.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [("quality", quality_filter), ("toxicity", toxicity_filter), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

#: The filters learn their models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each reads what the one
    before has written to the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = common.written(apply(spark, docs, sf_dir), f"pipeline-{name}")
    common.release(spark, _STEPS)
    return docs
