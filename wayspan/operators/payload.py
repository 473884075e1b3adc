"""What is published for a selection: means, percentiles, spread, share of free flow, profiles, masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import MPS_TO_KMH, circular_mean, project_xy, round_half_even, whole_direction
from ..params import DEFAULTS, Params
from .hist import percentiles
from .spatial import in_zone

QS = {"med": 0.5, "p15": 0.15, "p85": 0.85}


def free_flow(hist: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """(cx, cy, dir, ff): p85 over all data, where it is not below the floor."""
    return percentiles(hist, ["cx", "cy", "dir"], {"ff": p.free_flow_q}, p.hist_bin_kmh).where(F.col("ff") >= p.rel_min_ff_kmh)


def masked_cells(cells: DataFrame, zones: list[tuple[float, float, float]]) -> DataFrame:
    """(cx, cy) whose mean position over all data lies in a zone."""
    m = cells.groupBy("cx", "cy").agg((F.sum("sum_lat") / F.sum("n")).alias("lat"), (F.sum("sum_lon") / F.sum("n")).alias("lon"))
    x, y = project_xy(F.col("lon"), F.col("lat"))
    return m.where(in_zone(x, y, zones)).select("cx", "cy")


def means(cells: DataFrame, keys: list[str], masked: DataFrame | None = None, p: Params = DEFAULTS) -> DataFrame:
    """Cells of selections with enough samples, outside the mask: lat, lon, bearing, mean km/h."""
    c = cells.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in ("n", "sum_speed", "sum_lat", "sum_lon", "sum_sin", "sum_cos")]).where(F.col("n") >= p.min_samples)
    if masked is not None:
        c = c.join(masked, ["cx", "cy"], "left_anti")
    n = F.col("n")
    return c.select(*keys, "n", (F.col("sum_lat") / n).alias("lat"), (F.col("sum_lon") / n).alias("lon"), circular_mean(F.col("sum_sin"), F.col("sum_cos")).alias("bearing"), (F.col("sum_speed") / n * MPS_TO_KMH).alias("v"))


def payload(cells: DataFrame, hist: DataFrame, ff: DataFrame, keys: list[str], masked: DataFrame | None = None, p: Params = DEFAULTS) -> DataFrame:
    """Published columns by selection and cell; without a histogram its columns are null."""
    q = percentiles(hist, keys, QS, p.hist_bin_kmh)
    on = [k for k in keys if k not in ("cx", "cy", "dir")]
    m = means(cells, keys, masked, p)
    same = [m[k].eqNullSafe(q[k]) for k in keys]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    j = m.join(q, cond, "left").select(*[m[k] for k in keys], "n", "lat", "lon", "bearing", "v", *QS).join(ff, ["cx", "cy", "dir"], "left")
    return j.select(
        *on, "cx", "cy", F.col("dir").alias("grp"), round_half_even(F.col("lat"), 5).alias("lat"), round_half_even(F.col("lon"), 5).alias("lon"), whole_direction(F.col("bearing")).alias("dir"),
        *[round_half_even(F.col(c), 1).alias(c) for c in ("v", *QS)], round_half_even(F.col("p85") - F.col("p15"), 1).alias("spread"), round_half_even(F.try_divide(F.col("med"), F.col("ff")), 2).alias("rel"), "n",
    )


def profile(cells: DataFrame, keys: list[str], hours: list[int], p: Params = DEFAULTS) -> DataFrame:
    """Mean km/h by hour as ``q`` (array over ``hours``, -1 where an hour has too few samples); thin cells are left out."""
    by = cells.groupBy(*keys, "hour").agg(F.sum("n").alias("n"), F.sum("sum_speed").alias("s"))
    v = F.when(F.col("n") >= p.profile_min_samples, F.rint(F.col("s") / F.col("n") * MPS_TO_KMH).cast("int"))
    wide = by.withColumn("v", v).groupBy(*keys).pivot("hour", hours).agg(F.first("v"))
    filled: Column = F.lit(0)
    for h in hours:
        filled = filled + F.col(str(h)).isNotNull().cast("int")
    return wide.where(filled >= p.profile_min_hours).select(*keys, F.array(*[F.coalesce(F.col(str(h)), F.lit(-1)) for h in hours]).alias("q"))


def trim_range(values: DataFrame, column: str, tail: float = 0.01) -> DataFrame:
    """(low, high): the order statistics that leave ``tail`` at either end.

    Equal values are counted before they are ordered: published values are rounded, so
    few are left whatever the number of cells.
    """
    n = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    n = n.withColumns({"upto": F.sum("n").over(W.orderBy("v").rowsBetween(W.unboundedPreceding, 0)), "last": F.sum("n").over(W.partitionBy()) - 1})
    at = lambda share: F.min(F.when(F.col("upto") > F.floor(F.col("last") * share), F.col("v")))
    return n.agg(at(tail).alias("low"), at(1 - tail).alias("high"))


def catalogue_counts(cells: DataFrame) -> DataFrame:
    """One row: total samples, months with the days of each (by date of the file), hours, days, weekdays, first and last day."""
    days = cells.groupBy("day").agg(F.sum("n").alias("n"), F.collect_set("month").alias("months"), F.collect_set("hour").alias("hours"))
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    one = days.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("samples"), flat("months").alias("months"), flat("hours").alias("hours"), F.count("*").alias("days"), F.count(F.when(F.weekday("day") < 5, 1)).alias("weekdays"),
        F.min("day").alias("first"), F.max("day").alias("last"), F.collect_list(F.date_format("day", "yyyy-MM")).alias("filed"),
    )
    of = F.transform("months", lambda m: F.struct(m.alias("month"), F.size(F.filter("filed", lambda d: d == m)).alias("days")))
    return one.withColumn("months", of).drop("filed")
