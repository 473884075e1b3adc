"""Ride times: runs, passes of stops, legs between adjacent stops, and answers from A to B."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import hist_bin, local_hour, local_month, round_half_even
from ..params import DEFAULTS, Params
from .hist import percentiles
from .polyline import passes
from .spatial import near

RUN = ["day", "vehicle_id", "trip_id", "route_id"]
LEG = ["route_id", "direction", "from_stop", "to_stop"]
LEG_STAGES = ("backwards", "too_long", "gap", "kept")


def split_runs(samples: DataFrame, max_gap: int, keys: list[str] | None = None) -> DataFrame:
    """``run`` numbers the stretches of a vehicle's trip without a gap of more than ``max_gap`` seconds; ``gap`` to the sample before."""
    w = W.partitionBy(*(keys or RUN)).orderBy("ts", "x", "y")
    s = samples.withColumn("gap", F.col("ts") - F.lag("ts").over(w))
    return s.withColumn("run", F.sum(F.when(F.col("gap") > max_gap, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))


def with_holes(samples: DataFrame, max_hole: int, keys: list[str] | None = None) -> DataFrame:
    """``holes``: how many gaps beyond ``max_hole`` lie before each sample of its run."""
    w = W.partitionBy(*(keys or RUN), "run").orderBy("ts", "x", "y").rowsBetween(W.unboundedPreceding, 0)
    first = F.row_number().over(W.partitionBy(*(keys or RUN), "run").orderBy("ts", "x", "y")) == 1
    s = samples.withColumn("__first", first)
    return s.withColumn("holes", F.sum(F.when((F.col("gap") > max_hole) & ~F.col("__first"), 1).otherwise(0)).over(w)).drop("__first")


def nearest_passes(samples: DataFrame, path: DataFrame, radius: float, keys: list[str], bucket: float = 100.0) -> DataFrame:
    """Per run and place k of its path: when it was nearest (the earliest of equals), and the holes up to then.

    samples: keys, run, ts, x, y, holes, path_id; path: path_id, k, stop_id, x, y.  A stop that
    repeats on a path stands at its last place.
    """
    last = path.groupBy("path_id", "stop_id").agg(F.max(F.struct("k", "x", "y")).alias("p")).select("path_id", "stop_id", "p.k", "p.x", "p.y")
    j = near(samples, last, radius, ["path_id"], "inner", bucket)
    best = F.min_by(F.struct("ts", "holes"), F.struct("d2", "ts"))
    return j.groupBy(*keys, "run", "path_id", F.col("site_k").alias("k"), F.col("site_stop_id").alias("stop_id")).agg(best.alias("at")).select(*keys, "run", "path_id", "k", "stop_id", "at.ts", "at.holes")


def legs(passed: DataFrame, keys: list[str], max_s: int) -> DataFrame:
    """Pairs of neighbouring places that a run passed both of, with verdict: backwards, too_long, gap or kept."""
    w = W.partitionBy(*keys, "run").orderBy("k")
    nxt = F.lead(F.struct("k", "stop_id", "ts", "holes")).over(w)
    p = passed.withColumn("nxt", nxt).where(F.col("nxt.k") == F.col("k") + 1)
    seconds = F.col("nxt.ts") - F.col("ts")
    verdict = F.when(seconds <= 0, "backwards").when(seconds > max_s, "too_long").when(F.col("nxt.holes") != F.col("holes"), "gap").otherwise("kept")
    return p.select(*keys, "run", "path_id", "k", F.col("ts").alias("start_ts"), F.col("stop_id").alias("from_stop"), F.col("nxt.stop_id").alias("to_stop"), seconds.alias("seconds"), verdict.alias("verdict"))


def legs_of_day(kept: DataFrame, schedule, p: Params = DEFAULTS) -> DataFrame:
    """Legs of positions that the ride funnel kept, keyed by route and direction."""
    from .funnel import with_route_dir

    rows = with_route_dir(kept, schedule.trip_pattern, schedule.patterns, schedule.paths).where("rd_route is not null")
    rows = rows.withColumns({"ts": F.col("veh_ts"), "path_id": F.concat_ws("|", "rd_route", "rd_dir")})
    rows = with_holes(split_runs(rows, p.run_gap_max_s), p.seg_gap_max_s)
    path = schedule.paths.join(schedule.stops.select("stop_id", "x", "y"), "stop_id").withColumn("path_id", F.concat_ws("|", "route_id", "direction")).select("path_id", "k", "stop_id", "x", "y")
    found = legs(nearest_passes(rows, path, p.stop_pass_radius_m, RUN, p.stop_bucket_m), RUN, p.seg_max_s)
    ids = F.split("path_id", r"\|")
    return found.withColumns({"route_id": ids[0], "direction": ids[1], "month": local_month(F.col("start_ts"), p.tz), "hour": local_hour(F.col("start_ts"), p.tz)})


def leg_sums(kept: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return kept.groupBy(*(keys or ["month", "hour", *LEG])).agg(F.count("*").alias("n"), F.sum("seconds").alias("sum_s"))


def leg_histogram(kept: DataFrame, width: float, keys: list[str] | None = None) -> DataFrame:
    return kept.groupBy(*(keys or ["month", "hour", *LEG]), hist_bin(F.col("seconds"), width).alias("bin")).agg(F.count("*").alias("n"))


def leg_values(sums: DataFrame, hist: DataFrame, keys: list[str], p: Params = DEFAULTS) -> DataFrame:
    """(keys, med, avg, n): whole seconds, null below the least number of observations; n is always told."""
    s = sums.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("sum_s").alias("sum_s"))
    q = percentiles(hist, keys, {"med": 0.5}, p.seg_bin_s)
    ok = F.col("n") >= p.seg_min_obs
    out = s.join(q, keys, "left")
    return out.select(*keys, F.when(ok, round_half_even(F.col("med")).cast("int")).alias("med"), F.when(ok, round_half_even(F.col("sum_s") / F.col("n")).cast("int")).alias("avg"), "n")


def path_legs(paths: DataFrame) -> DataFrame:
    """(route_id, direction, leg, from_stop, to_stop) of canonical paths."""
    w = W.partitionBy("route_id", "direction").orderBy("k")
    return paths.select("route_id", "direction", F.col("k").alias("leg"), F.col("stop_id").alias("from_stop"), F.lead("stop_id").over(w).alias("to_stop")).where("to_stop is not null")


def ride_arrays(values: DataFrame, paths: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Per route and direction (and ``on``, selection columns): med, avg, n along the path, null where nothing is known.

    Routes without any observation are left out.
    """
    on = on or []
    seen = values.select(*on, "route_id", "direction").distinct()
    laid = seen.join(path_legs(paths), ["route_id", "direction"]).join(values, [*on, *LEG], "left")
    a = laid.groupBy(*on, "route_id", "direction").agg(F.array_sort(F.collect_list(F.struct("leg", "med", "avg", F.coalesce("n", F.lit(0)).alias("n")))).alias("a"), F.count("n").alias("known")).where("known > 0")
    return a.select(*on, "route_id", "direction", *[F.col("a")[c].alias(c) for c in ("med", "avg", "n")])


def ride_total(stretches: DataFrame, leg_spans: DataFrame, value: Column, keys: list[str]) -> DataFrame:
    """Time along a stretch: each leg charged by the share of it that is covered, holes at the route's mean leg.

    stretches: keys, route_id, direction, from_m, to_m; leg_spans: route_id, direction, leg,
    start_m, end_m and what ``value`` and ``n`` need.  Nothing measured: no row.
    ``observations`` is the (upper) median of n over the charged legs.
    """
    line = ["route_id", "direction"]
    spans = leg_spans.withColumn("value", value.cast("double"))
    spans = spans.withColumn("fill", F.avg("value").over(W.partitionBy(*line)))
    overlap = F.least(F.col("end_m"), F.col("to_m")) - F.greatest(F.col("start_m"), F.col("from_m"))
    j = stretches.join(spans, line).withColumns({"overlap": overlap, "span": F.col("end_m") - F.col("start_m")}).where("span > 0 and overlap > 0 and fill is not null")
    share = F.col("overlap") / F.col("span")
    g = j.groupBy(*keys, *line).agg(
        F.sum(F.coalesce("value", "fill") * share).alias("seconds"),
        F.count(F.when(F.col("value").isNull(), 1)).alias("holes"),
        F.count("*").alias("legs"),
        F.count("value").alias("measured"),
        F.sort_array(F.collect_list(F.coalesce("n", F.lit(0)))).alias("charged"),
    )
    return g.where("measured > 0").select(*keys, *line, "seconds", "holes", "legs", F.element_at("charged", (F.floor(F.size("charged") / 2) + 1).cast("int")).alias("observations"))


def ride_pairs(queries: DataFrame, segs: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Of each query (q, ax_, ay_, bx_, by_ planar, direct metres) and line, the shortest way from a pass near A to one near B.

    Lines are a small dimension; the queries are the large side.
    """
    line = ["route_id", "direction"]
    a = passes(queries.select("q", F.col("a_x").alias("x"), F.col("a_y").alias("y")), segs, [], line, p.ride_near_m, 6)
    b = passes(queries.select("q", F.col("b_x").alias("x"), F.col("b_y").alias("y")), segs, [], line, p.ride_near_m, 6)
    # the shortest way to a place near B begins at the last place near A before it; at one place B comes first, so a way has length
    both = a.select("q", *line, "along", F.lit(1).alias("kind"), "off").unionByName(b.select("q", *line, "along", F.lit(0).alias("kind"), "off"))
    before = W.partitionBy("q", *line).orderBy("along", "kind").rowsBetween(W.unboundedPreceding, -1)
    start = F.last(F.when(F.col("kind") == 1, F.struct("along", "off")), ignorenulls=True).over(before)
    j = both.withColumn("a", start).where("kind = 0 and a is not null").select("q", *line, F.col("a.along").alias("from_m"), F.col("along").alias("to_m"), F.greatest("a.off", "off").alias("off"))
    best = F.min_by(F.struct("from_m", "to_m", "off"), F.struct(F.col("to_m") - F.col("from_m"), F.col("from_m")))
    g = j.groupBy("q", *line).agg(best.alias("w")).select("q", *line, "w.*").join(queries.select("q", "direct"), "q")
    return g.where(F.col("to_m") - F.col("from_m") <= F.col("direct") * p.ride_detour_max + 2 * p.ride_near_m)


def ride_options(queries: DataFrame, segs: DataFrame, stop_dist: DataFrame, values: DataFrame, metric: str = "avg", p: Params = DEFAULTS) -> DataFrame:
    """All routes from A to B of each query, with seconds, metres, stops to board and alight at, holes, observations.

    stop_dist: route_id, direction, k, dist_m; values: route_id, direction, leg, med, avg, n.
    Queries of the same A and B are answered once.
    """
    line, trip = ["route_id", "direction"], ["a_x", "a_y", "b_x", "b_y", "direct"]
    asked, queries = queries, queries.groupBy(*trip).agg(F.min("q").alias("q"))
    w = W.partitionBy(*line).orderBy("k")
    spans = stop_dist.select(*line, F.col("k").alias("leg"), F.col("dist_m").alias("start_m"), F.lead("dist_m").over(w).alias("end_m")).where("end_m is not null")
    spans = spans.join(values, [*line, "leg"], "left")
    ways = ride_pairs(queries, segs, p)
    timed = ride_total(ways, spans, F.col(metric), ["q"])
    at = ways.join(stop_dist, line).groupBy("q", *line).agg(
        F.coalesce(F.max(F.when(F.col("dist_m") <= F.col("from_m"), F.col("k"))), F.lit(0)).alias("board"),
        F.coalesce(F.max(F.when(F.col("dist_m") <= F.col("to_m"), F.col("k"))), F.max("k")).alias("alight"),
    )
    out = timed.join(ways, ["q", *line]).join(at, ["q", *line]).join(queries, "q").drop("q").join(asked.select("q", *trip), trip)
    return out.select("q", *line, "seconds", (F.col("to_m") - F.col("from_m")).alias("metres"), F.greatest(F.lit(0), F.col("alight") - F.col("board")).alias("stops"), "board", "alight", "holes", "legs", "observations", "off", "from_m", "to_m")

