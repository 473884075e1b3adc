import pytest
from network import AT_N, FAR, POSITION, START, T0, entity, feed, position, write_static
from pyspark.sql import functions as F

from wayspan.operators import cells, funnel
from wayspan.operators.spatial import in_zone, near
from wayspan.sources import schedule, snapshots


@pytest.fixture(scope="module")
def plan(spark, tmp_path_factory):
    return schedule.build(schedule.read_archive(spark, str(write_static(tmp_path_factory.mktemp("static")))))


@pytest.fixture
def counts(spark, plan):
    def run(*rows, zones=()):
        judged = funnel.speed_funnel(spark.createDataFrame(list(rows), POSITION), plan, zones)
        return {r.stage: r.n for r in funnel.funnel_counts(judged).collect() if r.n}

    return run


def test_only_buses(counts):
    assert counts(position(0), position(1, route="R_TROL", trip="2_1_0", vehicle="b"), position(2, route="R_TRAM", trip="3_1_0", vehicle="c")) == {"not_bus": 2, "kept": 1}


def test_stale_is_one_sided(counts):
    assert counts(position(0, veh=T0 - 200), position(1, veh=T0 - 30, vehicle="b"), position(2, veh=T0 + 500, vehicle="c")) == {"stale": 1, "kept": 2}


def test_first_sighting_counts(counts):
    assert counts(position(0), position(1)) == {"duplicate": 1, "kept": 1}


def test_bad_first_sighting_shadows(counts):
    assert counts(position(0, speed=99.0), position(1)) == {"speed": 1, "duplicate": 1}


def test_stops_of_own_trip_only(counts):
    assert counts(position(0, *AT_N)) == {"at_stop": 1}
    assert counts(position(0, *AT_N, trip="1_1_1")) == {"kept": 1}


def test_unknown_trips_fall_back(counts):
    assert counts(position(0, *AT_N, trip="999_7_0")) == {"at_stop": 1}
    assert counts(position(0, *AT_N, trip="999_7_1")) == {"kept": 1}
    assert counts(position(0, trip="999_7_5")) == {"no_stops": 1}


def test_terminal_before_stop(counts):
    assert counts(position(0, START[0] + 80 / 111_320, START[1])) == {"at_terminal": 1}
    assert counts(position(0, START[0] + 200 / 111_320, START[1])) == {"kept": 1}


def test_speed_and_box(counts):
    assert counts(position(0, speed=40.0), position(1, 52.0, 21.0, vehicle="b"), position(2, speed=float("nan"), vehicle="c")) == {"speed": 2, "bbox": 1}


def test_depot(counts, spark):
    from wayspan.plans.cli import zones_of

    zones = zones_of(spark, [{"lat": 49.8408, "lon": 24.03, "radius_m": 100}])
    assert counts(position(0), zones=zones) == {"depot": 1}
    assert counts(position(0, 49.8408 + 150 / 111_320, 24.03), zones=zones) == {"kept": 1}


def test_empty_input(counts):
    assert counts() == {}


def test_cells(spark, plan):
    kept = cells.keyed(funnel.speed_funnel(spark.createDataFrame([position(0, speed=6.0), position(1, speed=10.0, vehicle="b"), position(2, speed=2.0, vehicle="c", bearing=180.0)], POSITION), plan))
    got = sorted((r.month, r.hour, r.dir, r.n, r.sum_speed) for r in cells.cell_sums(kept).collect())
    assert got == [("2026-08", 10, 0, 2, 16.0), ("2026-08", 10, 4, 1, 2.0)]
    assert sum(r.n for r in cells.speed_histogram(kept).collect()) == 3


def test_near_edges(spark):
    pts = spark.createDataFrame([(0, 0.0, 0.0), (1, -30.0, 0.0), (2, 41.0, 0.0)], "q int, x double, y double")
    site = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    assert sorted(r.q for r in near(pts, site, 40, how="left_semi").collect()) == [0, 1]
    assert near(pts, site, 41, how="left_anti").count() == 0
    assert spark.range(1).select(in_zone(F.lit(3.0), F.lit(4.0), [(0, 0, 5)])).first()[0]


def test_decoder():
    rows = snapshots.decode(feed(entity(), entity(bearing=None), entity(speed=None), entity(vehicle=None, eid="E9"), entity(ts=0), entity(trip="")))
    assert [r[0] for r in rows] == [0, 3, 4]
    assert [r[3] for r in rows] == ["v1", "E9", "v1"]
    assert all(r[2] == T0 for r in rows)
    assert rows[0][6] == pytest.approx(49.8408, abs=1e-5)


def test_malformed_is_told(spark, tmp_path):
    day = tmp_path / "2026-08-06"
    day.mkdir()
    (day / "2026-08-06T070000Z.pb").write_bytes(feed(entity(), entity(vehicle="v2")))
    (day / "2026-08-06T070010Z.pb").write_bytes(b"\x0a\xff\xff")
    rows = snapshots.read_snapshots(spark, str(tmp_path))
    assert rows.where("error is not null").count() == 1
    good = snapshots.readable(rows).collect()
    assert len(good) == 2 and str(good[0].day) == "2026-08-06"


def test_schedule(plan, rows):
    assert rows(plan.paths.where("direction = '0'"), "k", "stop_id") == [(0, "START"), (1, "N"), (2, "FAR")]
    assert rows(plan.fallback, "route_id", "direction") == [("R_BUS", "0"), ("R_BUS", "1")]
    ends = plan.pattern_stop.where("is_terminal and seq is not null").select("stop_id").distinct()
    assert rows(ends) == [("FAR",), ("START",)]
    assert rows(plan.stops, "stop_id", "name")[0] == ("FAR", "FAR")
    assert FAR[0] == pytest.approx(plan.stops.where("stop_id = 'FAR'").first().lat)


def test_path_for(spark, plan, rows):
    trips = spark.createDataFrame([("1_1_1", "R_BUS"), ("77_0", "R_BUS"), ("77_9", "R_BUS")], "trip_id string, route_id string")
    got = funnel.path_of_trip(trips, plan.trip_pattern, plan.pattern_stop, plan.paths)
    assert rows(got, "trip_id", "k", "stop_id") == [("1_1_1", 0, "START"), ("1_1_1", 1, "S"), ("1_1_1", 2, "FAR"), ("77_0", 0, "START"), ("77_0", 1, "N"), ("77_0", 2, "FAR")]
