import json

import pytest
from pyspark.sql import functions as F

from wayspan.functions import expr as X
from wayspan.operators import cells, hist, payload, rides, rollup
from wayspan.params import Params
from wayspan.plans import publish

HIST = "month string, hour int, cx int, cy int, dir int, bin int, n long"
CELL = "day date, month string, hour int, cx int, cy int, dir int, n long, sum_speed double, sum_lat double, sum_lon double, sum_sin double, sum_cos double"


@pytest.mark.parametrize(
    ("bins", "q", "want"),
    [
        ({10: 2, 30: 1, 50: 2}, 0.5, 30.5),
        ({30: 9, 0: 21}, 0.5, 0.5),
        ({30: 21, 0: 9}, 0.5, 30.5),
        ({10: 1, 20: 1}, 0.5, 10.5),
        ({5: 20, 20: 60, 40: 20}, 0.15, 5.5),
        ({5: 20, 20: 60, 40: 20}, 0.85, 40.5),
        ({5: 20, 20: 60, 40: 5}, 0.85, 20.5),
        ({12: 1, 30: 1}, 0.01, 12.5),
        ({7: 40}, 0.99, 7.5),
    ],
)
def test_percentiles(spark, bins, q, want):
    h = spark.createDataFrame([("a", b, n) for b, n in bins.items()], "k string, bin int, n long")
    assert hist.percentiles(h, ["k"], {"v": q}).first().v == want


def test_percentiles_of_nothing(spark):
    assert hist.percentiles(spark.createDataFrame([], "k string, bin int, n long"), ["k"], {"v": 0.5}).count() == 0


def test_percentiles_match_ungrouped_rows(spark):
    rows = [(k, (k * 7 + i * i) % 50) for k in range(5) for i in range(1, 60 + k)]
    df = spark.createDataFrame(rows, "k int, bin int")
    got = {r.k: r.v for r in hist.percentiles(df.groupBy("k", "bin").agg(F.count("*").alias("n")), ["k"], {"v": 0.85}).collect()}
    want = {r.k: r.v + 0.5 for r in df.groupBy("k").agg(F.expr("percentile_disc(0.85) within group (order by bin)").alias("v")).collect()}
    assert got == want


def test_free_flow_floor_and_pooling(spark, rows):
    h = spark.createDataFrame([("a", 1, 0, 0, 0, 10, 90), ("b", 2, 0, 0, 0, 40, 10), ("a", 1, 1, 0, 0, 4, 50), ("a", 1, 2, 0, 0, 30, 50)], HIST)
    assert rows(payload.free_flow(h), "cx", "ff") == [(0, 10.5), (2, 30.5)]


def _cell(day="2026-08-03", hour=8, cx=0, cy=0, d=0, n=10, speed=25.0, bearing=0.0, month="2026-08"):
    import datetime
    import math

    return (datetime.date.fromisoformat(day), month, hour, cx, cy, d, n, speed, 49.84 * n, 24.03 * n, n * math.sin(math.radians(bearing)), n * math.cos(math.radians(bearing)))


def test_payload(spark):
    c = spark.createDataFrame([_cell()], CELL)
    h = spark.createDataFrame([("2026-08", 8, 0, 0, 0, 2, 8), ("2026-08", 8, 0, 0, 0, 37, 2)], HIST)
    ff = spark.createDataFrame([(0, 0, 0, 40.5)], "cx int, cy int, dir int, ff double")
    r = payload.payload(c, h, ff, ["cx", "cy", "dir"]).first()
    assert (r.v, r.med, r.n, r.lat, r.dir, r.spread, r.rel) == (9.0, 2.5, 10, 49.84, 0, 35.0, 0.06)
    r = payload.payload(c, h.where("false"), ff.where("false"), ["cx", "cy", "dir"]).first()
    assert (r.v, r.med, r.rel) == (9.0, None, None)
    assert payload.payload(spark.createDataFrame([_cell(n=4)], CELL), h, ff, ["cx", "cy", "dir"]).count() == 0


def test_headings_average_as_vectors(spark):
    c = spark.createDataFrame([_cell(n=5, bearing=350.0), _cell(n=5, bearing=10.0)], CELL)
    assert payload.means(c, ["cx", "cy", "dir"]).select(X.whole_direction(F.col("bearing"))).first()[0] == 0


def test_fold(spark, rows):
    bins = {0: 40, 1: 30, 2: 10, 4: 25}
    c = spark.createDataFrame([_cell(d=d, n=n, bearing=45.0 * d) for d, n in bins.items()], CELL)
    g = cells.fold_groups(c)
    out = cells.regroup(c, g, ["cx", "cy", "dir"], ["n"])
    assert rows(out, "dir", "n") == [(0, 80), (1, 25)]
    quiet = spark.createDataFrame([_cell(d=2, n=1), _cell(d=4, n=50), _cell(d=7, n=3)], CELL)
    assert rows(cells.regroup(quiet, g, ["cx", "cy", "dir"], ["n"]), "dir", "n") == [(0, 4), (1, 50)]
    one = spark.createDataFrame([_cell(d=3, n=20, bearing=135.0), _cell(d=4, n=5, bearing=180.0)], CELL)
    assert rows(cells.regroup(one, cells.fold_groups(one), ["cx", "cy", "dir"], ["n"]), "dir", "n") == [(0, 25)]


def test_profile(spark):
    hours = list(range(5, 11))
    c = spark.createDataFrame([_cell(hour=h, n=3, speed=7.5 if h == 7 else 15.0) for h in hours], CELL)
    assert payload.profile(c, ["cx", "cy", "dir"], hours).first().q == [18, 18, 9, 18, 18, 18]
    assert payload.profile(c.where("hour > 5"), ["cx", "cy", "dir"], hours).count() == 0
    thin = c.unionByName(spark.createDataFrame([_cell(hour=11, n=2)], CELL))
    assert payload.profile(thin, ["cx", "cy", "dir"], [*hours, 11]).first().q[-1] == -1


def test_cube_and_grid(spark, rows):
    c = spark.createDataFrame([_cell(n=1), _cell(day="2026-08-08", hour=9, n=2)], CELL).withColumn("daytype", X.daytype(F.col("day")))
    got = {(r.month, r.daytype, r.hour): r.n for r in rollup.cube(c, ["cx"], ["n"]).collect()}
    assert got[None, None, None] == 3 and got["2026-08", "wd", None] == 1 and got[None, "we", 9] == 2
    g = rollup.grid(c)
    assert g.count() == 2 * 3 * 3 and g.where("key = '2026-08-wd-09'").count() == 1


def test_mask(spark, rows):
    from wayspan.plans.cli import zones_of

    c = spark.createDataFrame([_cell(), _cell(cx=9)], CELL).withColumn("sum_lat", F.when(F.col("cx") == 9, F.col("sum_lat") + 1).otherwise(F.col("sum_lat")))
    assert rows(payload.masked_cells(c, zones_of(spark, [{"lat": 49.84, "lon": 24.03, "radius_m": 50}]))) == [(0, 0)]


def test_daytypes_and_keys(spark):
    df = spark.createDataFrame([("2026-08-03",), ("2026-08-07",), ("2026-08-08",), ("2026-08-09",)], "d string")
    assert [r[0] for r in df.select(X.daytype(F.to_date("d"))).collect()] == ["wd", "wd", "we", "we"]
    one = spark.range(1)
    assert one.select(X.month_label(F.lit("2026-07"))).first()[0] == "July 2026"
    assert [one.select(X.heading_bin(F.lit(float(b)))).first()[0] for b in (0, 359, 20, 90, 180, 22, 23)] == [0, 0, 0, 2, 4, 0, 1]
    assert one.select(X.ramp_colour(F.lit(0.5)), X.ramp_colour(F.lit(1.5)), X.ramp_colour(F.lit(1.0), invert=True)).first()[:] == ("#f0a620", "#2e9e4a", "#d62828")
    assert one.select(X.duration_text(F.lit(345.0)), X.duration_text(F.lit(59.4)), X.duration_text(F.lit(3900.0))).first()[:] == ("5 min 45 s", "59 s", "1 h 05 min")


def test_ride_arrays(spark):
    keys = ["route_id", "direction", "from_stop", "to_stop"]
    s = spark.createDataFrame([("r", "0", "A", "B", 10, 1200), ("r", "0", "B", "C", 10, 600), ("z", "0", "A", "B", 4, 400)], "route_id string, direction string, from_stop string, to_stop string, n long, sum_s long")
    h = spark.createDataFrame([("r", "0", "A", "B", 24, 10), ("r", "0", "B", "C", 12, 10), ("z", "0", "A", "B", 20, 4)], "route_id string, direction string, from_stop string, to_stop string, bin int, n long")
    paths = spark.createDataFrame([(r, "0", k, stop) for r in "rzq" for k, stop in enumerate("ABC")], "route_id string, direction string, k int, stop_id string")
    got = {r.route_id: (r.med, r.avg, r.n) for r in rides.ride_arrays(rides.leg_values(s, h, keys), paths).collect()}
    assert got == {"r": ([122, 62], [120, 60], [10, 10]), "z": ([None, None], [None, None], [4, 0])}


def test_publish_end_to_end(spark):
    c = spark.createDataFrame([_cell(hour=h, n=6, speed=30.0) for h in range(5, 12)] + [_cell(day="2026-08-08", hour=8, cx=3, d=4, bearing=180.0)], CELL)
    h = spark.createDataFrame([(r.day, r.month, r.hour, r.cx, r.cy, r.dir, 18, r.n) for r in c.collect()], "day date, " + HIST)
    out = publish.publish(publish.Tables(c, h, None, None), p=Params())
    keys = {r.key for r in out.cells.select("key").distinct().collect()}
    assert {"all-all-all", "2026-08-wd-05", "all-we-08"} <= keys and "2026-08-we-05" not in keys
    doc = json.loads(publish.cell_documents(out.cells).where("key = 'all-all-all'").first().value)
    assert doc["n"] == [10, 42] and doc["med"] == [18.5, 18.5] and doc["rel"] == [1.0, 1.0]
    prof = json.loads(publish.profile_documents(out.profiles, out.cells).where("key = 'profile-all-all'").first().value)
    assert prof["q"] == [18] * 7
    index = out.index
    assert index["samples"] == 52 and index["hours"] == [5, 6, 7, 8, 9, 10, 11] and index["rides"] is False
    assert index["months"] == [{"key": "2026-08", "label": "August 2026", "days": 2}] and index["days"] == {"count": 2, "first": "2026-08-03", "last": "2026-08-08"}
    assert [(d["key"], d["days"]) for d in index["daytypes"]] == [("all", 2), ("wd", 1), ("we", 1)]
    assert index["metrics"][4] == {"key": "rel", "label": "% of free-flow", "unit": "%", "factor": 100, "decimals": 0, "invert": False, "scale": {"low": 0.35, "high": 1.0}}
    assert [m["key"] for m in publish.metric_descriptors()] == ["v", "med", "p15", "p85", "rel", "spread"]


def test_written_selections(spark, tmp_path):
    """Every selection has a document, empty ones too; a second run leaves nothing of the first; tables are read by partition."""
    c = spark.createDataFrame([_cell(hour=h, n=6, speed=30.0) for h in range(5, 12)] + [_cell(day="2026-08-08", hour=8, cx=3, d=4, bearing=180.0)], CELL)
    h = spark.createDataFrame([(r.day, r.month, r.hour, r.cx, r.cy, r.dir, 18, r.n) for r in c.collect()], "day date, " + HIST)
    web = f"{tmp_path}/web"
    keys = lambda kind: {r.key for r in spark.read.text(f"{web}/{kind}").select("key").distinct().collect()}
    publish.write_all(publish.publish(publish.Tables(c, h, None, None)), web, spark)
    assert len(keys("cells")) == 2 * 3 * 8 and len(keys("profiles")) == 2 * 3
    empty = json.loads(spark.read.text(f"{web}/cells").where("key = '2026-08-we-05'").first().value)
    assert empty == {k: [] for k in ("lat", "lon", "dir", "v", "med", "p15", "p85", "spread", "rel", "n")}
    publish.write_all(publish.publish(publish.Tables(c.where("hour < 7"), h.where("hour < 7"), None, None)), web, spark)
    assert len(keys("cells")) == 2 * 3 * 3 and "all-all-08" not in keys("cells")
    again = publish.stored(spark, f"{web}/tables")
    assert again.hours == [5, 6] and again.months == ["2026-08"]
    one = again.cells.where("key = 'all-all-05'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(key" in one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_ride_documents_of_empty_selections(spark):
    ride = spark.createDataFrame([("a", "r", "0", [1], [2], [3])], "key string, route_id string, direction string, med array<int>, avg array<int>, n array<int>")
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    got = {r.key: json.loads(r.value) for r in publish.ride_documents(ride, keys).collect()}
    assert got == {"a": {"r|0": {"med": [1], "avg": [2], "n": [3]}}, "b": {}}
