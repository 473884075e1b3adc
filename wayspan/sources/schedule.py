"""Schedules: CSV members to normalised dimensions (routes, patterns, paths, stops, shapes)."""

from __future__ import annotations

import csv
import io
import zipfile
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import is_bus, project_xy
from ..operators import polyline
from ..params import DEFAULTS, Params

#: Members of an archive and the columns read from them; all are text.
MEMBERS = {
    "routes": ["route_id", "route_short_name", "route_type"],
    "trips": ["route_id", "trip_id", "direction_id", "shape_id"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence"],
    "stops": ["stop_id", "stop_lat", "stop_lon", "stop_name"],
    "shapes": ["shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon"],
}


@dataclass
class Schedule:
    routes: DataFrame  # route_id, name
    trip_pattern: DataFrame  # trip_id, pattern_id
    patterns: DataFrame  # pattern_id, route_id, direction, is_fallback
    pattern_stop: DataFrame  # pattern_id, seq (null in fallbacks), stop_id, x, y, is_terminal
    fallback: DataFrame  # route_id, direction, pattern_id
    paths: DataFrame  # route_id, direction, k, stop_id
    stops: DataFrame  # stop_id, lat, lon, x, y, name
    shape_points: DataFrame  # route_id, direction, i, lat, lon, x, y, cum
    stop_dist: DataFrame  # route_id, direction, k, dist_m

    def write(self, path: str, static_date: str) -> None:
        for f in fields(self):
            getattr(self, f.name).write.mode("overwrite").parquet(f"{path}/{f.name}/static_date={static_date}")

    @classmethod
    def read(cls, spark: SparkSession, path: str, static_date: str) -> Schedule:
        return cls(*[spark.read.parquet(f"{path}/{f.name}/static_date={static_date}") for f in fields(cls)])


def read_csv(spark: SparkSession, path: str, member: str) -> DataFrame | None:
    """One member of an unpacked archive; missing columns are null; None if the file is absent.

    Columns are taken by header, ids stay text, a byte order mark is ignored.
    """
    from .stores import names

    if f"{member}.txt" not in names(spark, path):
        return None
    raw = spark.read.csv(f"{path}/{member}.txt", header=True, inferSchema=False, encoding="UTF-8", multiLine=False)
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    return raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in MEMBERS[member]])


def read_archive(spark: SparkSession, path: str) -> dict[str, DataFrame | None]:
    """Members of a zip archive.  Schedules are tens of MB; the archive itself is one file."""
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    out: dict[str, DataFrame | None] = {}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for member, columns in MEMBERS.items():
            if f"{member}.txt" not in z.namelist():
                out[member] = None
                continue
            with z.open(f"{member}.txt") as f:
                rows = [tuple(r.get(c) for c in columns) for r in csv.DictReader(io.TextIOWrapper(f, "utf-8-sig"))]
            out[member] = spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return out


def ordered_trips(stop_times: DataFrame) -> DataFrame:
    """(trip_id, route_id, direction, path): stops in order of their whole-number sequence."""
    other = [c for c in stop_times.columns if c not in ("seq", "stop_id")]
    keep = [F.first(c).alias(c) for c in other if c != "trip_id"]
    return stop_times.groupBy("trip_id").agg(*keep, F.transform(F.array_sort(F.collect_list(F.struct(F.col("seq").cast("int").alias("seq"), "stop_id"))), lambda s: s["stop_id"]).alias("path"))


def intern(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trip_id, pattern_id) and (pattern_id, route_id, direction, path): trips alike in order and direction share a pattern.

    Its id is a digest of what defines it, so it is the same in any run and any partitioning.
    """
    key = F.sha2(F.to_json(F.struct(F.col("route_id").cast("string").alias("r"), F.col("direction").alias("d"), F.col("path").alias("p"))), 256)
    t = trips.withColumn("pattern_id", key)
    return t.select("trip_id", "pattern_id"), t.groupBy("pattern_id").agg(F.first("route_id").alias("route_id"), F.first("direction").alias("direction"), F.first("path").alias("path"))


def longest_paths(trips: DataFrame, order: str = "trip_id") -> DataFrame:
    """(route_id, direction, path, ...): the longest trip of each; of equally long ones the first by ``order``."""
    best = F.min_by(F.struct(*[c for c in trips.columns if c not in ("route_id", "direction")]), F.struct(-F.size("path"), F.col(order)))
    return trips.groupBy("route_id", "direction").agg(best.alias("b")).select("route_id", "direction", "b.*")


def union_stops(ordered: DataFrame, patterns: DataFrame) -> DataFrame:
    """(route_id, direction, stop_id, is_terminal): the stops of all patterns of each; an end of any of them is an end."""
    of = patterns.select("pattern_id", "route_id", "direction")
    return ordered.join(of, "pattern_id").groupBy("route_id", "direction", "stop_id").agg(F.max("is_terminal").alias("is_terminal"))


def pattern_stops(patterns: DataFrame) -> DataFrame:
    """(pattern_id, seq, stop_id, is_terminal) of patterns with their path; first and last stop are terminals wherever they stand."""
    ordered = patterns.select("pattern_id", F.posexplode("path").alias("seq", "stop_id"), F.array(F.element_at("path", 1), F.element_at("path", -1)).alias("ends"))
    return ordered.select("pattern_id", "seq", "stop_id", F.array_contains("ends", F.col("stop_id")).alias("is_terminal"))


def build(members: dict[str, DataFrame | None], p: Params = DEFAULTS) -> Schedule:
    """All dimensions of one archive.  They are small beside positions."""
    routes = members["routes"].where(is_bus(F.col("route_type"), F.col("route_short_name"))).select("route_id", F.col("route_short_name").alias("name"))
    trips = members["trips"].join(routes.select("route_id"), "route_id", "left_semi").select("trip_id", "route_id", F.coalesce("direction_id", F.lit("0")).alias("direction"), "shape_id")
    times = members["stop_times"].withColumn("row", F.monotonically_increasing_id()).join(trips, "trip_id").withColumn("seq", F.col("stop_sequence").cast("int")).drop("stop_sequence")
    first = times.groupBy("trip_id").agg(F.min("row").alias("first_row"))
    runs = ordered_trips(times.drop("row")).join(first, "trip_id").withColumn("shape_id", F.nullif("shape_id", F.lit("")))

    trip_pattern, patterns = intern(runs.select("trip_id", "route_id", "direction", "path"))
    ordered = pattern_stops(patterns)
    name = F.concat_ws("|", F.lit("any"), "route_id", "direction")
    union = union_stops(ordered, patterns).select(name.alias("pattern_id"), F.lit(None).cast("int").alias("seq"), "stop_id", "is_terminal")
    fallback = patterns.select("route_id", "direction", name.alias("pattern_id")).distinct()

    x, y = project_xy(F.col("lon"), F.col("lat"))
    stops = members["stops"].join(ordered.select("stop_id").distinct(), "stop_id", "left_semi").dropDuplicates(["stop_id"]).select("stop_id", F.col("stop_lat").cast("double").alias("lat"), F.col("stop_lon").cast("double").alias("lon"), F.coalesce(F.nullif("stop_name", F.lit("")), F.col("stop_id")).alias("name"))
    stops = stops.withColumns({"x": x, "y": y}).select("stop_id", "lat", "lon", "x", "y", "name")
    pattern_stop = ordered.unionByName(union).join(stops.select("stop_id", "x", "y"), "stop_id").select("pattern_id", "seq", "stop_id", "x", "y", "is_terminal")

    longest = longest_paths(runs.select("trip_id", "route_id", "direction", "path", "shape_id", "first_row"), "first_row")
    paths = longest.select("route_id", "direction", F.posexplode("path").alias("k", "stop_id"))
    shape_points, stop_dist = shapes(members.get("shapes"), longest.select("route_id", "direction", "shape_id"), paths, stops, p)
    all_patterns = patterns.select("pattern_id", "route_id", "direction", F.lit(False).alias("is_fallback")).unionByName(fallback.select("pattern_id", "route_id", "direction", F.lit(True).alias("is_fallback")))
    return Schedule(routes, trip_pattern, all_patterns, pattern_stop, fallback, paths, stops, shape_points, stop_dist)


def shapes(points: DataFrame | None, wanted: DataFrame, paths: DataFrame, stops: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """Simplified shapes of canonical paths and the distance of each stop along them.

    A route is left out if its shape has fewer than two points, a stop has no place, or the stops don't fit.
    """
    keys = ["route_id", "direction"]
    spark = paths.sparkSession
    if points is None:
        return spark.createDataFrame([], "route_id string, direction string, i int, lat double, lon double, x double, y double, cum double"), spark.createDataFrame([], "route_id string, direction string, k int, dist_m double")
    x, y = project_xy(F.col("lon"), F.col("lat"))
    pts = points.join(wanted.where("shape_id is not null"), "shape_id").select(*keys, F.col("shape_pt_sequence").cast("int").alias("i"), F.col("shape_pt_lat").cast("double").alias("lat"), F.col("shape_pt_lon").cast("double").alias("lon")).withColumns({"x": x, "y": y})
    line = polyline.cumulative(polyline.simplify(pts, keys, p.shape_tolerance_m), keys)
    at = paths.join(stops.select("stop_id", "x", "y"), "stop_id", "left").select(*keys, "k", "x", "y")
    dist = polyline.match_stops(line, at, keys, p.stop_match_max_m, p.match_slack_m, p.candidate_limit)
    w = W.partitionBy(*keys).orderBy("i")
    line = line.join(dist.select(*keys).distinct(), keys, "left_semi").withColumn("i", F.row_number().over(w) - 1)
    return line.select(*keys, "i", "lat", "lon", "x", "y", "cum"), dist
