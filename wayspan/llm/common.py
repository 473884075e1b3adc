"""Shared plumbing of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, or with a number after it where a column of any case has that name."""
    low, n, name = {c.lower() for c in taken}, 0, wanted
    while name.lower() in low:
        n += 1
        name = f"{wanted}{n}"
    return name


def hash_sample(df: DataFrame, most: int, *key: str) -> DataFrame:
    """About ``most`` rows at most: those of small key hash, the same in any partitioning; all if there are no more.

    A fixed share is kept by a filter, so no task sends its own ``most`` rows anywhere.
    """
    n = df.count()
    if n <= most:
        return df
    share = 1 << 40
    return df.where(F.pmod(F.xxhash64(*key, F.lit(40)), F.lit(share)) < F.lit(int(most / n * share)))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
