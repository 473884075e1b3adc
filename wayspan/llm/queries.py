"""Registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, license, mixing, neardup, pii, quality, substrings, toxicity, urls, warc
from .common import table
from .sql import ORACLES


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.archive(table(spark, sf_dir, "pages")))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.often_named(pages))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).drop("llr")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_of(table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license.scan(docs, license.fit(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": near_dedup,
    "op2_suffix_dedup": suffix_dedup,
    "op3_warc_archive": warc_archive,
    "op4_url_filter": url_filter,
    "op5_quality_rules": quality_rules,
    "op6_toxicity": toxicity_scores,
    "op7_source_mix": source_mix,
    "op8_pii_spans": pii_spans,
    "op9_decontamination": decontamination,
    "op10_license_scan": license_scan,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
