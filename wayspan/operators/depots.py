"""Depots: slow, busy squares away from stops, grouped into sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import MPS_TO_KMH
from ..params import DEFAULTS, Params
from ..tables import scope
from .graph import components
from .spatial import near, nearest


def slow_cells(cells: DataFrame, max_kmh: float, min_samples: int, min_hours: int) -> DataFrame:
    """(cx, cy, n, kmh, slow_hours, lat, lon, sum_speed): directions and months are pooled; an hour is slow by its own mean."""
    hourly = cells.groupBy("cx", "cy", "hour").agg(*[F.sum(c).alias(c) for c in ("n", "sum_speed", "sum_lat", "sum_lon")])
    slow = F.col("sum_speed") / F.col("n") * MPS_TO_KMH <= max_kmh
    c = hourly.withColumn("slow", slow.cast("int")).groupBy("cx", "cy").agg(*[F.sum(x).alias(x) for x in ("n", "sum_speed", "sum_lat", "sum_lon")], F.sum("slow").alias("slow_hours"))
    c = c.withColumns({"kmh": F.col("sum_speed") / F.col("n") * MPS_TO_KMH, "lat": F.col("sum_lat") / F.col("n"), "lon": F.col("sum_lon") / F.col("n")})
    return c.where((F.col("kmh") <= max_kmh) & (F.col("n") >= min_samples) & (F.col("slow_hours") >= min_hours)).drop("sum_lat", "sum_lon")


def unshielded(candidates: DataFrame, stops: DataFrame, radius: float, keys: list[str]) -> DataFrame:
    """Candidates (keys, x, y) without those whose nearest stop within ``radius`` is no terminal of any pattern.

    stops: stop_id, x, y, is_terminal.
    """
    s = stops.groupBy("stop_id").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.max("is_terminal").alias("is_terminal"))
    hit = nearest(candidates, s, radius, keys, "stop_id", strict=True)
    return candidates.join(hit.where(~F.col("site.is_terminal")).select(*keys), keys, "left_anti")


def clusters(cells: DataFrame, reach: int = 2) -> DataFrame:
    """``cluster``: cells (cx, cy) joined while they are at most ``reach`` apart on both axes; named by the least (cx, cy)."""
    c = cells.select(F.struct("cx", "cy").alias("a")).distinct()
    steps = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in range(-reach, reach + 1) for y in range(-reach, reach + 1) if (x, y) > (0, 0)])
    moved = F.struct((F.col("a.cx") + F.col("d.x")).alias("cx"), (F.col("a.cy") + F.col("d.y")).alias("cy"))
    links = c.select("a", F.explode(steps).alias("d")).select("a", moved.alias("b")).join(c.withColumnRenamed("a", "b"), "b", "left_semi")
    with scope() as kept:
        labels = kept.result(components(links).select(F.col("node.cx").alias("cx"), F.col("node.cy").alias("cy"), F.col("label").alias("cluster")))
    return cells.join(labels, ["cx", "cy"], "left").withColumn("cluster", F.coalesce("cluster", F.struct("cx", "cy")))


def cluster_stats(cells: DataFrame, pad: float = 40.0) -> DataFrame:
    """Per cluster: sample-weighted centre, radius to the farthest cell plus ``pad``, cells, samples, km/h.

    Cells have x, y, n, sum_speed; lat and lon, if there, are averaged with the same weights.
    """
    axes = [c for c in ("x", "y", "lat", "lon") if c in cells.columns]
    centre = cells.groupBy("cluster").agg(*[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(f"mid_{c}") for c in axes])
    j = cells.join(centre, "cluster").withColumn("d", F.hypot(F.col("x") - F.col("mid_x"), F.col("y") - F.col("mid_y")))
    return j.groupBy("cluster").agg(*[F.first(f"mid_{c}").alias(c) for c in axes], (F.max("d") + pad).alias("radius_m"), F.count("*").alias("cells"), F.sum("n").alias("samples"), (F.sum("sum_speed") / F.sum("n") * MPS_TO_KMH).alias("kmh"))


def merge_sites(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Existing sites and those found whose centre is farther from every existing one than its radius; largest first.

    Sites: x, y, radius_m, samples.  Existing sites are grouped by the power of two that
    holds their radius, and each group has buckets of its own size.
    """
    power = F.ceil(F.log2(F.greatest(F.col("radius_m").cast("double"), F.lit(1.0)))).cast("int")
    old = existing.select("x", "y", F.col("radius_m").alias("r"), power.alias("power"))
    f = found.withColumn("__id", F.struct("x", "y", "radius_m", "samples"))
    covered = None
    for k in sorted(r[0] for r in old.select("power").distinct().collect() if r[0] is not None):  # some tens of powers at most
        size = float(2**k)
        hit = near(f.select("__id", "x", "y"), old.where(F.col("power") == k).drop("power"), size, None, "inner", size).where(F.col("d2") <= F.col("site_r") * F.col("site_r")).select("__id")
        covered = hit if covered is None else covered.unionByName(hit)
    fresh = f if covered is None else f.join(covered.distinct(), "__id", "left_anti")
    return existing.unionByName(fresh.drop("__id")).orderBy(F.desc("samples"), "x", "y")


def discover(cells: DataFrame, stops: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Sites found in unmasked cell sums; positions of squares are their mean positions."""
    from ..functions.expr import project_xy

    c = slow_cells(cells, p.depot_max_kmh, p.depot_min_samples, p.depot_min_hours)
    x, y = project_xy(F.col("lon"), F.col("lat"))
    c = unshielded(c.withColumns({"x": x, "y": y}), stops, p.depot_min_dist_to_stop_m, ["cx", "cy"])
    return cluster_stats(clusters(c, p.depot_link_cells), p.depot_pad_m)
