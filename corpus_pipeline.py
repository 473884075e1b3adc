"""A corpus pipeline over ``documents``: quality, near copies, benchmark leaks, personal data, mixture.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.
``run`` writes every stage as Parquet in the shared folder and reads it again.

Defined cases, by stage: null, empty and short texts fail the quality rules and go;
very long texts are single rows throughout; of near copies the least doc_id stays, of
rows that share it that of greatest text, and rows with a null doc_id all stay; equal
documents are mixed by number; an empty table passes every stage as such, an empty
``benchmark`` cuts nothing, and empty ``labels`` leave the base rules alone to decide;
extra columns of any name and type are kept, and the mixture's own two columns get a
number if a column has their name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayspan.llm import decontam, mixing, neardup, pii, quality
from wayspan.llm.common import table
from wayspan.tables import scope


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly such passages goes."""
    return decontam.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each copy taken, with its shard and place."""
    return mixing.mix(docs)


STAGES = [("quality", good), ("near_dedup", distinct), ("decontamination", uncontaminated), ("pii", private), ("mixing", mixed)]

#: Near copies, personal data and the n-gram model can't be put in SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scope() as kept:  # a stage's own tables go with it
            docs = kept.result(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
