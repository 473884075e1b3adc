"""Published selections: one pass over the daily tables for all of them.

Headings are folded, squares masked and free flow taken from the whole archive first;
then sums and histograms are cubed over (month, day type, hour).  ``store`` writes the
selections as tables, a partition each, which ``stored`` reads by partition; the
``*_documents`` functions make the same selections JSON, empty ones included.
"""

from __future__ import annotations

import datetime
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.expr import daytype, month_label, profile_key, selection_key
from ..operators import cells, hist, payload, rides, rollup
from ..params import DEFAULTS, Params
from ..sources.stores import names
from ..tables import settled

REQUIRED = ("month", "hour", "cx", "cy", "dir", "n")

@dataclass(frozen=True)
class Metric:
    """How a published column is shown."""

    key: str
    label: str
    unit: str
    factor: int = 1
    decimals: int = 1
    invert: bool = False


# Keys, labels and units of the published metrics and day types.
METRICS = (
    Metric("v", "Average", "km/h"),
    Metric("med", "Median", "km/h"),
    Metric("p15", "Slow day (p15)", "km/h"),
    Metric("p85", "Fast day (p85)", "km/h"),
    Metric("rel", "% of free-flow", "%", factor=100, decimals=0),
    Metric("spread", "Unreliability (p85−p15)", "km/h", invert=True),
)
DAYTYPE_LABELS = {"all": "All days", "wd": "Weekdays", "we": "Weekends"}
RIDE_METRICS = {"avg": "Average", "med": "Median"}


def metric_descriptors(p: Params = DEFAULTS) -> list[dict]:
    """The metrics with the ends of their colour scales."""
    ends = {"rel": (p.rel_scale_low, p.rel_scale_high), "spread": (p.spread_scale_low, p.spread_scale_high)}
    scaled = ((m, ends.get(m.key, (p.scale_low_kmh, p.scale_high_kmh))) for m in METRICS)
    return [vars(m) | {"scale": {"low": low, "high": high}} for m, (low, high) in scaled]


@dataclass
class Tables:
    agg: DataFrame
    hist: DataFrame | None
    seg: DataFrame | None
    seghist: DataFrame | None


def load(spark: SparkSession, out: str) -> Tables:
    """Daily tables.  No agg or one without headings is an error; histograms and rides may be absent."""
    if not names(spark, f"{out}/agg"):
        raise FileNotFoundError(f"{out}/agg: nothing has been ingested")
    agg = spark.read.parquet(f"{out}/agg")
    lacking = [c for c in REQUIRED if c not in agg.columns]
    if lacking:
        raise ValueError(f"agg lacks {', '.join(lacking)}: ingest again")
    other = [spark.read.parquet(f"{out}/{k}") if names(spark, f"{out}/{k}") else None for k in ("hist", "seg", "seghist")]
    if other[1] is None or other[2] is None:
        other[1] = other[2] = None
    return Tables(agg, *other)


def _empty_hist(agg: DataFrame) -> DataFrame:
    return agg.select("day", *cells.KEY, F.lit(0).alias("bin"), "n").where("false")


@dataclass
class Published:
    cells: DataFrame  # sel, month, daytype, hour, key, cell columns
    profiles: DataFrame  # month, daytype, key, cx, cy, grp, q
    rides: DataFrame | None  # sel, month, daytype, hour, key, route_id, direction, med, avg, n
    index: dict  # what there is, for whoever asks
    keys: DataFrame | None = None  # key of every selection, with or without cells
    profile_keys: DataFrame | None = None

    @property
    def hours(self) -> list[int]:
        return self.index["hours"]

    @property
    def months(self) -> list[str]:
        return [m["key"] for m in self.index["months"]]


AXIS_KEYS = ["sel", *rollup.AXES]


def publish(t: Tables, paths: DataFrame | None = None, zones=(), p: Params = DEFAULTS) -> Published:
    agg = t.agg.withColumn("daytype", daytype(F.col("day")))
    h = (t.hist if t.hist is not None else _empty_hist(t.agg)).withColumn("daytype", daytype(F.col("day")))
    groups = settled(cells.fold_groups(t.agg))
    keys = [*rollup.AXES, "cx", "cy", "dir"]
    agg, h = settled(cells.regroup(agg, groups, keys, cells.SUMS)), settled(cells.regroup(h, groups, [*keys, "bin"], ["n"]))
    masked = settled(payload.masked_cells(agg, list(zones))) if zones else None
    ff = settled(payload.free_flow(h, p))

    cubed = rollup.cube(agg, ["cx", "cy", "dir"], cells.SUMS)
    cubed_h = rollup.cube(h, ["cx", "cy", "dir", "bin"], ["n"])
    body = payload.payload(cubed, cubed_h, ff, [*AXIS_KEYS, "cx", "cy", "dir"], masked, p)
    key = selection_key(F.col("month"), F.col("daytype"), F.col("hour"))

    index = catalogue(t, paths, p)
    hours = index["hours"]
    by_hour = rollup.cube(agg, ["cx", "cy", "dir", "hour"], ["n", "sum_speed"], ["month", "daytype"])
    prof = payload.profile(by_hour, ["sel", "month", "daytype", "cx", "cy", "dir"], hours, p)
    if masked is not None:
        prof = prof.join(masked, ["cx", "cy"], "left_anti")

    ride = None
    if t.seg is not None and paths is not None:
        # only months and hours that the speed map has
        seen = agg.select("month", "hour").distinct()
        s = t.seg.withColumn("daytype", daytype(F.col("day"))).join(seen.select("month").distinct(), "month", "left_semi").join(seen.select("hour").distinct(), "hour", "left_semi")
        sh = t.seghist.withColumn("daytype", daytype(F.col("day"))).join(seen.select("month").distinct(), "month", "left_semi").join(seen.select("hour").distinct(), "hour", "left_semi")
        full = [*AXIS_KEYS, *rides.LEG]
        v = _leg_values(rollup.cube(s, rides.LEG, ["n", "sum_s"]), rollup.cube(sh, [*rides.LEG, "bin"], ["n"]), full, p)
        ride = rides.ride_arrays(v.withColumn("key", key), paths, ["key"])

    profiled = rollup.grid(agg, ["month", "daytype"]).select("month", "daytype", profile_key(F.col("month"), F.col("daytype")).alias("key"))
    return Published(body.withColumn("key", key), prof.withColumn("key", profile_key(F.col("month"), F.col("daytype"))), ride, index, rollup.grid(agg), profiled)


def catalogue(t: Tables, paths: DataFrame | None, p: Params = DEFAULTS) -> dict:
    """The index: what was measured and how; one row of counts comes to the driver."""
    c = payload.catalogue_counts(t.agg).withColumn("months", F.transform("months", lambda m: F.struct(m["month"].alias("key"), month_label(m["month"]).alias("label"), m["days"].alias("days")))).first()
    n = {"all": c["days"], "wd": c["weekdays"], "we": c["days"] - c["weekdays"]}
    ride = t.seg is not None and paths is not None
    return {
        "generated": datetime.date.today().isoformat(), "timezone": p.tz, "cell_size_m": p.cell_size_m, "heading_bins": p.heading_bins, "stop_radius_m": p.stop_radius_m, "terminal_radius_m": p.terminal_radius_m,
        "min_samples": p.min_samples, "metrics": metric_descriptors(p), "hist_bin_kmh": p.hist_bin_kmh, "free_flow_q": p.free_flow_q,
        "rides": ride and {"stop_pass_radius_m": p.stop_pass_radius_m, "min_observations": p.seg_min_obs, "bin_s": p.seg_bin_s, "routes": paths.select("route_id", "direction").distinct().count(), "metrics": [{"key": k, "label": v} for k, v in RIDE_METRICS.items()]},
        "scale": {"low_kmh": p.scale_low_kmh, "high_kmh": p.scale_high_kmh}, "hours": list(c["hours"]), "days": {"count": c["days"], "first": str(c["first"]), "last": str(c["last"])},
        "samples": c["samples"], "months": [m.asDict() for m in c["months"]], "daytypes": [{"key": k, "label": v, "days": n[k]} for k, v in DAYTYPE_LABELS.items()],
    }


def _leg_values(sums: DataFrame, hists: DataFrame, keys: list[str], p: Params) -> DataFrame:
    """leg_values over keys that may be null (pooled axes)."""
    fill = {k: F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in rollup.AXES}
    v = rides.leg_values(sums.withColumns(fill), hists.withColumns(fill), keys, p)
    back = {k: F.nullif(F.col(k), F.lit("\u0000")) for k in rollup.AXES}
    return v.withColumns(back).withColumn("hour", F.col("hour").cast("int"))


def _every(rows: DataFrame, column: str, keys: DataFrame | None, empty: Column | None = None) -> DataFrame:
    """Rows (key, column) with an empty array, or ``empty``, for each other key."""
    if keys is None:
        return rows
    none = F.array() if empty is None else empty
    return keys.select("key").join(rows, "key", "left").withColumn(column, F.coalesce(column, none.cast(rows.schema[column].dataType)))


def cell_documents(body: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(key, value): a selection as JSON of parallel arrays, cells in ascending order of samples."""
    cols = ["lat", "lon", "dir", "v", "med", "p15", "p85", "spread", "rel", "n"]
    rows = body.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "cx", "cy", "grp", *[c for c in cols if c != "n"]))).alias("r"))
    return _every(rows, "r", keys).select("key", F.to_json(F.struct(*[F.col("r")[c].alias(c) for c in cols]), {"ignoreNullFields": "false"}).alias("value"))


def profile_documents(prof: DataFrame, body: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(key, value): cells of a month and day type with their hours row by row."""
    place = body.groupBy("cx", "cy", F.col("grp").alias("dir")).agg(F.max_by("lat", "n").alias("lat"), F.max_by("lon", "n").alias("lon"))
    rows = prof.join(place, ["cx", "cy", "dir"]).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("cx", "cy", "dir", "lat", "lon", "q"))).alias("r"))
    return _every(rows, "r", keys).select("key", F.to_json(F.struct(F.col("r")["lat"].alias("lat"), F.col("r")["lon"].alias("lon"), F.col("r")["dir"].alias("dir"), F.flatten(F.col("r")["q"]).alias("q"))).alias("value"))


def ride_documents(ride: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(key, value): 'route|direction' to arrays along its path."""
    e = F.struct(F.concat_ws("|", "route_id", "direction").alias("key"), F.struct("med", "avg", "n").alias("value"))
    order = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    rows = ride.groupBy("key").agg(F.map_from_entries(F.array_sort(F.collect_list(e), order)).alias("m"))
    return _every(rows, "m", keys, F.create_map()).select("key", F.to_json("m", {"ignoreNullFields": "false"}).alias("value"))


def index_document(index: dict, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(json.dumps(index, ensure_ascii=False),)], "value string").coalesce(1)


def write_documents(docs: DataFrame, path: str) -> None:
    """A folder for each key.  What an earlier run left goes, keys that are no more included, whatever the session overwrites."""
    docs.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("key").text(path)


def write_all(out: Published, path: str, spark: SparkSession) -> None:
    """All documents and the tables behind them."""
    store(out, f"{path}/tables", spark)
    kept = stored(spark, f"{path}/tables")
    write_documents(cell_documents(kept.cells, out.keys), f"{path}/cells")
    write_documents(profile_documents(kept.profiles, kept.cells, out.profile_keys), f"{path}/profiles")
    if kept.rides is not None:
        write_documents(ride_documents(kept.rides, out.keys), f"{path}/rides")
    index_document(out.index, spark).write.mode("overwrite").text(f"{path}/index")


def store(out: Published, path: str, spark: SparkSession) -> None:
    """The selections as tables, a partition for each, with their schemas, and the index."""
    tables = {k: df for k, df in (("cells", out.cells), ("profiles", out.profiles), ("rides", out.rides)) if df is not None}
    for name, df in tables.items():
        df.repartition("key").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("key").parquet(f"{path}/{name}")
    schemas = json.dumps({name: df.schema.json() for name, df in tables.items()})
    spark.createDataFrame([(schemas,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/schemas")
    index_document(out.index, spark).write.mode("overwrite").text(f"{path}/index")


def stored(spark: SparkSession, path: str) -> Published:
    """Selections that ``store`` wrote: what is asked of one key reads its partition alone."""
    index, schemas = (json.loads(spark.read.text(f"{path}/{name}").first()[0]) for name in ("index", "schemas"))
    read = {name: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{path}/{name}") for name, schema in schemas.items()}
    return Published(read["cells"], read["profiles"], read.get("rides"), index)
