"""Filter funnels: each row gets the verdict of the first stage that rejects it.

Positions: day, snapshot_key, entity_idx, feed_ts, veh_ts, vehicle_id, trip_id,
route_id, lat, lon, speed, bearing.  Duplicates are judged among rows that passed
the stages before, within a day, in order of (snapshot_key, entity_idx).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import in_bbox, project_xy, trip_suffix
from ..params import DEFAULTS, Params
from .spatial import beside, in_zone, packed, squared

SPEED_STAGES = ("not_bus", "stale", "duplicate", "speed", "bbox", "no_stops", "depot", "at_terminal", "at_stop", "kept")
RIDE_STAGES = ("not_bus", "stale", "duplicate", "bbox", "kept")


def with_bus_flag(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """``is_bus``: the route is among the bus routes (route_id), a small dimension."""
    bus = routes.select("route_id").distinct().withColumn("is_bus", F.lit(True))
    return rows.join(bus, "route_id", "left").withColumn("is_bus", F.coalesce("is_bus", F.lit(False)))


def fresh_verdict(max_age: int) -> Column:
    """not_bus and stale; a vehicle clock ahead of the feed is fresh."""
    return F.when(~F.col("is_bus"), "not_bus").when(F.col("feed_ts") - F.col("veh_ts") > max_age, "stale")


def mark_duplicates(rows: DataFrame, day: str = "day", order: list[str] | None = None) -> DataFrame:
    """Verdict ``duplicate`` for later sightings among rows without a verdict: one shuffle.

    Rejected rows are salted apart, so they don't meet in one window.
    """
    order = order or ["snapshot_key", "entity_idx"]
    live = F.col("verdict").isNull()
    spread = F.when(live, F.lit(0)).otherwise(F.pmod(F.xxhash64(*order), F.lit(1 << 20)) + 1)
    rn = F.row_number().over(W.partitionBy(day, "vehicle_id", "veh_ts", spread, live).orderBy(*order))
    return rows.withColumn("verdict", F.when(live & (rn > 1), "duplicate").otherwise(F.col("verdict")))


def with_pattern(rows: DataFrame, trip_pattern: DataFrame, fallback: DataFrame) -> DataFrame:
    """``pattern_id``: the trip's own, else that of (route, suffix of the trip id)."""
    own = trip_pattern.select("trip_id", F.col("pattern_id").alias("__own"))
    other = fallback.select("route_id", F.col("direction").alias("__dir"), F.col("pattern_id").alias("__other"))
    out = rows.withColumn("__suffix", trip_suffix(F.col("trip_id"))).join(own, "trip_id", "left")
    out = out.join(other.withColumnRenamed("route_id", "__route"), (F.col("route_id") == F.col("__route")) & (F.col("__suffix") == F.col("__dir")), "left")
    return out.withColumn("pattern_id", F.coalesce("__own", "__other")).drop("__own", "__other", "__dir", "__suffix", "__route")


def with_route_dir(rows: DataFrame, trip_pattern: DataFrame, patterns: DataFrame, paths: DataFrame) -> DataFrame:
    """``rd_route``, ``rd_dir``: of the trip's pattern, else (route, suffix) if that has a path, else null."""
    own = trip_pattern.join(patterns.select("pattern_id", F.col("route_id").alias("__r"), F.col("direction").alias("__d")), "pattern_id").select("trip_id", "__r", "__d")
    has = paths.select(F.col("route_id").alias("__pr"), F.col("direction").alias("__pd")).distinct()
    out = rows.join(own, "trip_id", "left").withColumn("__suffix", trip_suffix(F.col("trip_id")))
    out = out.join(has, (F.col("route_id") == F.col("__pr")) & (F.col("__suffix") == F.col("__pd")), "left")
    return out.withColumns({"rd_route": F.coalesce("__r", "__pr"), "rd_dir": F.coalesce("__d", "__pd")}).drop("__r", "__d", "__pr", "__pd", "__suffix")


def path_of_trip(rows: DataFrame, trip_pattern: DataFrame, pattern_stop: DataFrame, paths: DataFrame) -> DataFrame:
    """(row columns, k, stop_id): the trip's own stops in order, else the canonical path of (route, suffix)."""
    own = trip_pattern.join(pattern_stop.where("seq is not null"), "pattern_id").select("trip_id", F.col("seq").alias("k"), "stop_id")
    known = rows.join(own, "trip_id")
    rest = rows.join(trip_pattern.select("trip_id"), "trip_id", "left_anti").withColumn("__suffix", trip_suffix(F.col("trip_id")))
    p = paths.select(F.col("route_id").alias("__r"), F.col("direction").alias("__d"), "k", "stop_id")
    rest = rest.join(p, (F.col("route_id") == F.col("__r")) & (F.col("__suffix") == F.col("__d"))).drop("__r", "__d", "__suffix")
    return known.unionByName(rest.select(known.columns))


def stop_verdicts(rows: DataFrame, pattern_stop: DataFrame, p: Params) -> DataFrame:
    """at_terminal, then at_stop, for rows without a verdict (pattern_id, x, y).

    Each row meets the stops of its pattern around its bucket as one array, in one join
    with a small dimension; rows are not shuffled for it.
    """
    reach = lambda r: math.ceil(r / p.stop_bucket_m)
    far = F.when(F.col("is_terminal"), max(reach(p.terminal_radius_m), reach(p.stop_radius_m))).otherwise(reach(p.stop_radius_m))
    sites = packed(pattern_stop.select("pattern_id", "x", "y", "is_terminal"), ["pattern_id"], far, p.stop_bucket_m).withColumnRenamed("site_pattern_id", "site___p")
    out = beside(rows.withColumn("__p", F.when(F.col("verdict").isNull(), F.col("pattern_id"))), sites, ["__p"], p.stop_bucket_m, "left")
    d2 = lambda s: squared(F.col("x"), F.col("y"), s["x"], s["y"])
    at_end = F.exists("sites", lambda s: s["is_terminal"] & (d2(s) <= p.terminal_radius_m**2))
    at_stop = F.exists("sites", lambda s: d2(s) <= p.stop_radius_m**2)
    return out.withColumn("verdict", F.coalesce("verdict", F.when(at_end, "at_terminal"), F.when(at_stop, "at_stop"))).drop("__p", "sites")


def speed_funnel(positions: DataFrame, schedule, zones: list[tuple[float, float, float]] = (), p: Params = DEFAULTS) -> DataFrame:
    """All positions with x, y, pattern_id and verdict ('kept' or the stage that dropped them)."""
    rows = with_bus_flag(positions, schedule.routes).withColumn("verdict", fresh_verdict(p.stale_max_s))
    rows = mark_duplicates(rows)
    ok = F.col("verdict").isNull()
    gate = F.when(~F.coalesce(F.col("speed").between(0, p.speed_max_mps), F.lit(False)), "speed").when(~F.coalesce(in_bbox(F.col("lat"), F.col("lon"), p.bbox), F.lit(False)), "bbox")
    rows = rows.withColumn("verdict", F.when(ok, gate).otherwise(F.col("verdict")))
    rows = with_pattern(rows, schedule.trip_pattern, schedule.fallback)
    x, y = project_xy(F.col("lon"), F.col("lat"))
    rows = rows.withColumns({"x": x, "y": y})
    late = F.when(F.col("pattern_id").isNull(), "no_stops").when(in_zone(F.col("x"), F.col("y"), list(zones)), "depot")
    rows = rows.withColumn("verdict", F.when(ok, late).otherwise(F.col("verdict")))
    rows = stop_verdicts(rows, schedule.pattern_stop, p).drop("is_bus")
    return rows.withColumn("verdict", F.coalesce("verdict", F.lit("kept")))


def ride_funnel(positions: DataFrame, schedule, p: Params = DEFAULTS) -> DataFrame:
    """The shorter funnel of ride times: no speed, stop or depot stages."""
    rows = with_bus_flag(positions, schedule.routes).withColumn("verdict", fresh_verdict(p.stale_max_s))
    rows = mark_duplicates(rows)
    outside = F.when(~F.coalesce(in_bbox(F.col("lat"), F.col("lon"), p.bbox), F.lit(False)), "bbox")
    x, y = project_xy(F.col("lon"), F.col("lat"))
    return rows.withColumns({"verdict": F.coalesce("verdict", outside, F.lit("kept")), "x": x, "y": y}).drop("is_bus")


def funnel_counts(rows: DataFrame, stages=SPEED_STAGES) -> DataFrame:
    """(stage, n) in order of ``stages``, those without rows as 0."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(i, s) for i, s in enumerate(stages)], "pos int, stage string")
    n = rows.groupBy(F.col("verdict").alias("stage")).agg(F.count("*").alias("n"))
    return every.join(n, "stage", "left").select("pos", "stage", F.coalesce("n", F.lit(0)).alias("n")).orderBy("pos")
