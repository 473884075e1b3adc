"""Selections: every (month or all) x (wd, we or all) x (hour or all), in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import selection_key

AXES = ["month", "daytype", "hour"]


def cube(df: DataFrame, keys: list[str], sums: list[str], axes: list[str] | None = None) -> DataFrame:
    """Sums by axes cubed with fixed ``keys``; ``sel`` is the grouping id (a bit is set where an axis is pooled).

    Keys are reduced before they are expanded.
    """
    axes = axes or AXES
    pre = df.groupBy(*axes, *keys).agg(*[F.sum(c).alias(c) for c in sums])
    sets = []
    for bits in range(1 << len(axes)):
        sets.append([F.col(a) for i, a in enumerate(axes) if not bits >> (len(axes) - 1 - i) & 1] + [F.col(k) for k in keys])
    gid = F.lit(0)
    for a in axes:
        gid = gid * 2 + F.grouping(a)
    return pre.groupingSets(sets, *axes, *keys).agg(gid.cast("int").alias("sel"), *[F.sum(c).alias(c) for c in sums])


def grid(df: DataFrame, axes: list[str] | None = None) -> DataFrame:
    """All selections that the months and hours of ``df`` span, with or without rows, and their keys.

    The values of the axes are gathered in one row and unfolded there: no join.
    """
    axes = axes or AXES
    seen = df.agg(F.collect_set("month").alias("month"), F.collect_set(F.col("hour").cast("int")).alias("hour"))
    values = {"month": F.array_append("month", F.lit(None).cast("string")), "daytype": F.array(F.lit("wd"), F.lit("we"), F.lit(None).cast("string")), "hour": F.array_append("hour", F.lit(None).cast("int"))}
    for a in axes:
        seen = seen.withColumn(a, F.explode(values[a]))
    hour = F.col("hour") if "hour" in axes else F.lit(None).cast("int")
    return seen.select(*axes, selection_key(F.col("month"), F.col("daytype"), hour).alias("key"))
