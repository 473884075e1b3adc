"""Daily ingest: positions through the funnels into mergeable tables, a partition for each day.

Tables below ``out``: agg, hist (speed map), seg, seghist (ride times), funnel (counts).
Days that are there already are left alone unless forced; dynamic partition overwrite
makes a day's write all or nothing for each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import MPS_TO_KMH, hist_bin
from ..operators import cells, funnel, rides
from ..params import DEFAULTS, Params
from ..sources.schedule import Schedule
from ..sources.stores import dates
from ..tables import scope, settled


def write_day(df: DataFrame, path: str) -> None:
    """One partition for each day of ``df``, one file each: daily tables are sums."""
    df.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def missing(spark: SparkSession, out: str, days: list[str], kinds: tuple[str, ...], force: bool = False) -> list[str]:
    """Days of which any of the tables is absent."""
    have = [set(dates(spark, f"{out}/{k}")) for k in kinds]
    return [d for d in days if force or not all(d in h for h in have)]


def speed_tables(positions: DataFrame, schedule: Schedule, zones=(), p: Params = DEFAULTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(agg, hist, counts by verdict); all keep ``day``.

    The funnel runs once: its rows are summed by verdict, cell and speed bin, and all
    three tables are sums of that settled one.
    """
    keys = ["day", *cells.KEY]
    judged = cells.keyed(funnel.speed_funnel(positions, schedule, zones, p), p).withColumn("bin", hist_bin(F.col("speed") * MPS_TO_KMH, p.hist_bin_kmh))
    kept = F.col("verdict") == "kept"
    judged = judged.withColumns({c: F.when(kept, F.col(c)) for c in (*cells.KEY, "bin")})
    fine = settled(cells.cell_sums(judged, [*keys, "bin", "verdict"]))
    agg, hist = cells.merge(fine.where(kept), keys, cells.SUMS), fine.where(kept).select(*keys, "bin", "n")
    return agg, hist, fine.groupBy("day", "verdict").agg(F.sum("n").alias("n"))


def ride_tables(positions: DataFrame, schedule: Schedule, p: Params = DEFAULTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(seg, seghist, counts of legs by verdict), from one settled table of sums by leg and bin."""
    judged = rides.legs_of_day(funnel.ride_funnel(positions, schedule, p).where("verdict = 'kept'"), schedule, p)
    keys = ["day", "month", "hour", *rides.LEG]
    fine = settled(rides.leg_sums(judged.withColumn("bin", hist_bin(F.col("seconds"), p.seg_bin_s)), [*keys, "bin", "verdict"]))
    kept = fine.where("verdict = 'kept'")
    return cells.merge(kept, keys, ["n", "sum_s"]), kept.select(*keys, "bin", "n"), fine.groupBy("day", "verdict").agg(F.sum("n").alias("n"))


def ingest_speed(positions: DataFrame, schedule: Schedule, out: str, zones=(), p: Params = DEFAULTS) -> None:
    with scope():
        for df, name in zip(speed_tables(positions, schedule, zones, p), ("agg", "hist", "funnel"), strict=True):
            write_day(df, f"{out}/{name}")


def ingest_rides(positions: DataFrame, schedule: Schedule, out: str, p: Params = DEFAULTS) -> None:
    with scope():
        for df, name in zip(ride_tables(positions, schedule, p)[:2], ("seg", "seghist"), strict=True):
            write_day(df, f"{out}/{name}")


def paths_document(schedule: Schedule, static_date: str) -> DataFrame:
    """One row with the JSON of canonical paths: stops used, routes in order, shape and distances where they fit."""
    keys = ["route_id", "direction"]
    path = schedule.paths.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "stop_id"))), lambda s: s["stop_id"]).alias("path")).where(F.size("path") >= 2)
    place = F.array(F.rint(F.col("lat") * 1e5) / 1e5, F.rint(F.col("lon") * 1e5) / 1e5)
    shape = schedule.shape_points.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", place.alias("p")))), lambda s: s["p"]).alias("shape"))
    dist = schedule.stop_dist.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", F.rint("dist_m").cast("long").alias("d")))), lambda s: s["d"]).alias("dist"))
    full = path.join(shape.join(dist, keys), keys, "left").join(schedule.routes, "route_id")
    route = F.struct(F.col("route_id").alias("route"), F.col("direction").alias("dir"), "name", "path", "shape", "dist")
    routes = full.agg(F.array_sort(F.collect_list(route)).alias("routes"))
    used = schedule.stops.join(full.select(F.explode("path").alias("stop_id")).distinct(), "stop_id", "left_semi")
    entry = F.struct(F.col("stop_id").alias("key"), F.struct((F.rint(F.col("lat") * 1e5) / 1e5).alias("lat"), (F.rint(F.col("lon") * 1e5) / 1e5).alias("lon"), "name").alias("value"))
    stops = used.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("stops"))
    return routes.join(stops, F.lit(True)).select(F.to_json(F.struct(F.lit(static_date).alias("static_date"), "stops", "routes")).alias("value"))
