"""What users ask: cells of a selection, the cell at a place, rides from A to B, the catalogue."""

from __future__ import annotations

import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import metres_between, profile_key, project_xy
from ..operators import polyline, rides, spatial
from ..params import DEFAULTS, Params
from ..sources.schedule import Schedule
from .publish import DAYTYPE_LABELS, RIDE_METRICS, Published, index_document, metric_descriptors


class Transit:
    """Answers from published selections; those that ``publish.stored`` reads cost one partition each."""

    def __init__(self, spark: SparkSession, published: Published, schedule: Schedule | None = None, p: Params = DEFAULTS):
        self.spark, self.published, self.schedule, self.p = spark, published, schedule, p

    def _key(self, month: str | None, daytype: str | None, hour) -> str:
        """A selection's key; what isn't known falls back to 'all'."""
        month = month if month in self.published.months else "all"
        daytype = daytype if daytype in DAYTYPE_LABELS else "all"
        hour = f"{int(hour):02d}" if str(hour).isdigit() and int(hour) in self.published.hours else "all"
        return f"{month}-{daytype}-{hour}"

    def speed_cells(self, month: str = "all", daytype: str = "all", hour="all") -> DataFrame:
        """All metrics of a selection's cells, the busiest last."""
        return self.published.cells.where(F.col("key") == self._key(month, daytype, hour)).orderBy("n", "cx", "cy", "grp")

    @staticmethod
    def viewport(cells: DataFrame, south: float, west: float, north: float, east: float, metric: str = "v", pad: float = 0.1) -> DataFrame:
        """Cells with a value inside the padded bounds."""
        dy, dx = (north - south) * pad, (east - west) * pad
        return cells.where(F.col("lat").between(south - dy, north + dy) & F.col("lon").between(west - dx, east + dx) & F.col(metric).isNotNull())

    def cell_at(self, lat: float, lon: float, heading: float | None = None, radius: float = 60.0, month: str = "all", daytype: str = "all", hour="all") -> DataFrame:
        """The nearest cell's row, with its hours as ``q`` where it has a profile."""
        x, y = project_xy(F.col("lon"), F.col("lat"))
        c = self.speed_cells(month, daytype, hour).withColumns({"x": x, "y": y, "cell": F.struct("cx", "cy", "grp")})
        q = self.spark.createDataFrame([(0, lat, lon, heading)], "q int, lat double, lon double, heading double").withColumns({"x": x, "y": y})
        hit = spatial.nearest_cell(q, c.select("cell", "x", "y", "dir"), radius, max_angle=90.0).select("cell")
        month, daytype = self._key(month, daytype, hour).rsplit("-", 2)[:2]
        prof = self.published.profiles.where(F.col("key") == profile_key(F.lit(month), F.lit(daytype)))
        prof = prof.select(F.struct("cx", "cy", F.col("dir").alias("grp")).alias("cell"), "q")
        return c.join(hit, "cell", "left_semi").join(prof, "cell", "left").drop("cell", "x", "y")

    def arrow_at(self, lat: float, lon: float, radius: float = 60.0, lane: float = 4.0, month: str = "all", daytype: str = "all", hour="all") -> DataFrame:
        """The cell whose arrow, drawn ``lane`` metres to the right of its place, is nearest."""
        x, y = project_xy(F.col("lon"), F.col("lat"))
        c = self.speed_cells(month, daytype, hour).withColumns({"x": x, "y": y, "cell": F.struct("cx", "cy", "grp")})
        q = self.spark.createDataFrame([(0, lat, lon)], "q int, lat double, lon double").withColumns({"x": x, "y": y})
        hit = spatial.nearest_cell(q, c.select("cell", "x", "y", "dir"), radius, lane=lane).select("cell")
        return c.join(hit, "cell", "left_semi").drop("cell", "x", "y")

    def nearest_hour(self, hour: int | None = None) -> int | None:
        """The measured hour nearest to ``hour``, or to the feed's local time now; of two the earlier."""
        hour = datetime.datetime.now(ZoneInfo(self.p.tz)).hour if hour is None else hour
        return min(self.published.hours, key=lambda h: (abs(h - hour), h), default=None)

    def rides(self, a: tuple[float, float], b: tuple[float, float], month: str = "all", daytype: str = "all", hour="all", metric: str = "avg", rows: int | None = None) -> DataFrame:
        """Options from a to b (lat, lon), fastest first."""
        metric = metric if metric in RIDE_METRICS else "avg"
        s = self.schedule
        line = ["route_id", "direction"]
        q = self.spark.createDataFrame([(0, *a, *b)], "q int, la double, lo double, lb double, ob double")
        ax, ay = project_xy(F.col("lo"), F.col("la"))
        bx, by = project_xy(F.col("ob"), F.col("lb"))
        q = q.withColumns({"a_x": ax, "a_y": ay, "b_x": bx, "b_y": by, "direct": metres_between(F.col("la"), F.col("lo"), F.col("lb"), F.col("ob"))})
        pts, dist = route_lines(s)
        arrays = self.published.rides.where(F.col("key") == self._key(month, daytype, hour))
        values = arrays.select(*line, F.posexplode(F.arrays_zip("med", "avg", "n")).alias("leg", "v")).select(*line, "leg", "v.med", "v.avg", "v.n")
        out = rides.ride_options(q, polyline.segments(pts, line), dist, values, metric, self.p).join(s.routes, "route_id", "left")
        out = out.orderBy("seconds", "route_id", "direction")
        return out.limit(rows) if rows else out

    def catalogue(self) -> DataFrame:
        return index_document(self.published.index, self.spark)

    def metrics(self) -> list[dict]:
        return metric_descriptors(self.p)


def route_lines(s: Schedule) -> tuple[DataFrame, DataFrame]:
    """(points with cum, stop distances) of every route: its shape, else the chain of its stops."""
    keys = ["route_id", "direction"]
    shaped = s.stop_dist.select(*keys).distinct()
    chain = s.paths.join(shaped, keys, "left_anti").join(s.stops.select("stop_id", "x", "y"), "stop_id").select(*keys, F.col("k").alias("i"), "x", "y")
    chain = polyline.cumulative(chain, keys)
    pts = s.shape_points.select(*keys, "i", "x", "y", "cum").unionByName(chain.select(*keys, "i", "x", "y", "cum"))
    return pts, s.stop_dist.select(*keys, "k", "dist_m").unionByName(chain.select(*keys, F.col("i").alias("k"), F.col("cum").alias("dist_m")))
