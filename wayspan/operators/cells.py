"""Cells: mergeable sums and sparse histograms by (month, hour, cx, cy, dir); folding of headings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import MPS_TO_KMH, angle_between, cell_of, circular_mean, heading_bin, hist_bin, local_hour, local_month
from ..params import DEFAULTS, Params

KEY = ["month", "hour", "cx", "cy", "dir"]
SUMS = ["n", "sum_speed", "sum_lat", "sum_lon", "sum_sin", "sum_cos"]


def keyed(kept: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Positions that the funnel kept, with their cell key."""
    return kept.withColumns(
        {
            "month": local_month(F.col("feed_ts"), p.tz),
            "hour": local_hour(F.col("feed_ts"), p.tz),
            "cx": cell_of(F.col("x"), p.cell_size_m),
            "cy": cell_of(F.col("y"), p.cell_size_m),
            "dir": heading_bin(F.col("bearing"), p.heading_bins),
        }
    )


def cell_sums(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """n and sums of speed, position and unit heading by key; partial sums merge by adding."""
    rad = F.radians("bearing")
    return rows.groupBy(*(keys or KEY)).agg(F.count("*").alias("n"), F.sum("speed").alias("sum_speed"), F.sum("lat").alias("sum_lat"), F.sum("lon").alias("sum_lon"), F.sum(F.sin(rad)).alias("sum_sin"), F.sum(F.cos(rad)).alias("sum_cos"))


def speed_histogram(rows: DataFrame, p: Params = DEFAULTS, keys: list[str] | None = None) -> DataFrame:
    return rows.groupBy(*(keys or KEY), hist_bin(F.col("speed") * MPS_TO_KMH, p.hist_bin_kmh).alias("bin")).agg(F.count("*").alias("n"))


def merge(parts: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def fold_groups(cells: DataFrame, max_angle: float = 90.0) -> DataFrame:
    """(cx, cy, dir, grp): headings more than ``max_angle`` from the square's busiest one are group 1, others 0.

    Derived from all data once, never from a selection.  Of equally busy headings the lowest leads.
    """
    u = merge(cells, ["cx", "cy", "dir"], ["n", "sum_sin", "sum_cos"]).withColumn("bearing", circular_mean(F.col("sum_sin"), F.col("sum_cos")))
    lead = F.max_by("bearing", F.struct("n", -F.col("dir"))).over(W.partitionBy("cx", "cy"))
    return u.select("cx", "cy", "dir", F.when(angle_between(F.col("bearing"), lead) > max_angle, 1).otherwise(0).alias("grp"))


def regroup(df: DataFrame, groups: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Rewrite ``dir`` to its group (unknown: 0) and add up what now shares a key."""
    g = groups.withColumnRenamed("grp", "__g")
    out = df.join(g, ["cx", "cy", "dir"], "left").withColumn("dir", F.coalesce("__g", F.lit(0))).drop("__g")
    return merge(out, keys, sums)
