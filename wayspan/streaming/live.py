"""Streams: duplicates within a watermark, cells by window, runs as sessions.

A stream cannot reorder a day, so of duplicates that arrive out of order the first to
arrive stays; on ordered input the result is that of the batch funnel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import cell_of, heading_bin, hist_bin
from ..operators.funnel import fresh_verdict, with_bus_flag
from ..params import DEFAULTS, Params


def live_positions(stream: DataFrame, routes: DataFrame, p: Params = DEFAULTS, lateness: str = "10 minutes") -> DataFrame:
    """Fresh bus positions (x, y, speed given), each sighting once, with event time ``at``."""
    rows = with_bus_flag(stream, routes).withColumn("verdict", fresh_verdict(p.stale_max_s)).where("verdict is null")
    rows = rows.withColumn("at", F.timestamp_seconds("veh_ts")).withWatermark("at", lateness)
    return rows.dropDuplicatesWithinWatermark(["vehicle_id", "veh_ts"]).where(F.col("speed").between(0, p.speed_max_mps)).drop("is_bus", "verdict")


def live_cells(rows: DataFrame, window: str = "1 hour", p: Params = DEFAULTS) -> DataFrame:
    """n and sum of speed by window, cell and heading; mergeable like the batch tables."""
    return rows.groupBy(
        F.window("at", window).alias("w"), cell_of(F.col("x"), p.cell_size_m).alias("cx"), cell_of(F.col("y"), p.cell_size_m).alias("cy"), heading_bin(F.col("bearing"), p.heading_bins).alias("dir")
    ).agg(F.count("*").alias("n"), F.sum("speed").alias("sum_speed"))


def live_histogram(rows: DataFrame, window: str = "1 hour", p: Params = DEFAULTS) -> DataFrame:
    return rows.groupBy(F.window("at", window).alias("w"), cell_of(F.col("x"), p.cell_size_m).alias("cx"), cell_of(F.col("y"), p.cell_size_m).alias("cy"), hist_bin(F.col("speed") * 3.6, p.hist_bin_kmh).alias("bin")).agg(F.count("*").alias("n"))


def live_runs(rows: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """A vehicle's trip as sessions without a gap of more than the threshold."""
    gap = F.session_window("at", f"{p.run_gap_max_s} seconds").alias("s")
    return rows.groupBy(gap, "vehicle_id", "trip_id", "route_id").agg(F.count("*").alias("samples"), F.min("veh_ts").alias("first_ts"), F.max("veh_ts").alias("last_ts"))
