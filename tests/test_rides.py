import pytest
from network import FAR, N, POSITION, START, T0, position, write_static
from pyspark.sql import functions as F

from wayspan.operators import funnel, polyline, rides
from wayspan.params import Params
from wayspan.plans import ingest
from wayspan.sources import schedule


@pytest.fixture(scope="module")
def plan(spark, tmp_path_factory):
    return schedule.build(schedule.read_archive(spark, str(write_static(tmp_path_factory.mktemp("static")))))


def drive(*legs, step=10, trip="1_1_0", route="R_BUS"):
    """Positions every ``step`` seconds along (from, to, seconds) legs; None waits."""
    out, t = [], T0
    for a, b, s in legs:
        for k in range(0, s, step):
            out.append((t + k, a[0] + (b[0] - a[0]) * k / s, a[1] + (b[1] - a[1]) * k / s))
        t += s
    out.append((t, *legs[-1][1]))
    return [position(i, lat, lon, veh=ts, ts=ts, trip=trip, route=route) for i, (ts, lat, lon) in enumerate(out)]


@pytest.fixture
def legs(spark, plan):
    def run(samples, p=Params()):
        kept = funnel.ride_funnel(spark.createDataFrame(samples, POSITION), plan, p).where("verdict = 'kept'")
        return sorted((r.from_stop, r.to_stop, r.seconds, r.verdict) for r in rides.legs_of_day(kept, plan, p).collect())

    return run


def test_clean_run(legs):
    assert legs(drive((START, N, 120), (N, FAR, 180))) == [("N", "FAR", 180, "kept"), ("START", "N", 120, "kept")]


def test_dwell_goes_to_the_next_leg(legs):
    assert legs(drive((START, N, 120), (N, N, 45), (N, FAR, 180))) == [("N", "FAR", 225, "kept"), ("START", "N", 120, "kept")]


def test_hole(legs):
    run = drive((START, N, 120), (N, FAR, 400))
    assert legs([r for r in run if not T0 + 150 < r[4] < T0 + 450]) == [("N", "FAR", 400, "gap"), ("START", "N", 120, "kept")]


def test_backwards_and_too_long(legs):
    assert {v[3] for v in legs(drive((FAR, N, 180), (N, START, 120)))} == {"backwards"}
    assert legs(drive((START, N, 1860)))[0][3] == "too_long"


def test_short_turn(legs):
    assert legs(drive((START, N, 120))) == [("START", "N", 120, "kept")]


def test_unknown_route(legs):
    assert legs(drive((START, N, 120), trip="5_5_7")) == []


def test_split(spark, rows):
    s = spark.createDataFrame([("d", "v", "t", "r", ts, 0.0, 0.0) for ts in (631, 0, 30, 1231)], "day string, vehicle_id string, trip_id string, route_id string, ts long, x double, y double")
    got = rides.split_runs(s, 600)
    assert rows(got, "ts", "run") == [(0, 0), (30, 0), (631, 1), (1231, 1)]
    assert rows(rides.with_holes(got, 20), "ts", "holes") == [(0, 0), (30, 1), (631, 0), (1231, 1)]


def test_tables(spark, plan):
    seg, hist, _ = ingest.ride_tables(spark.createDataFrame(drive((START, N, 120), (N, FAR, 180)), POSITION), plan)
    got = {(r.month, r.hour, r.route_id, r.direction, r.from_stop, r.to_stop): (r.n, r.sum_s) for r in seg.collect()}
    assert got["2026-08", 10, "R_BUS", "0", "START", "N"] == (1, 120)
    assert sorted(r.bin for r in hist.collect()) == [24, 36]


def test_ingest_writes_days_once(spark, plan, tmp_path):
    df = spark.createDataFrame(drive((START, N, 120), (N, FAR, 180)), POSITION).withColumn("day", F.to_date("day"))
    ingest.ingest_rides(df, plan, str(tmp_path))
    ingest.ingest_speed(df, plan, str(tmp_path))
    assert ingest.missing(spark, str(tmp_path), ["2026-08-06", "2026-08-07"], ("seg", "seghist")) == ["2026-08-07"]
    assert spark.read.parquet(f"{tmp_path}/funnel").agg(F.sum("n")).first()[0] == df.count()
    doc = ingest.paths_document(plan, "2026-08-01").first().value
    assert '"path":["START","N","FAR"]' in doc and '"static_date":"2026-08-01"' in doc


def test_ride_total_fills_holes(spark):
    spans = spark.createDataFrame([("r", "0", 0, 0.0, 100.0, 50, 7), ("r", "0", 1, 100.0, 300.0, None, None), ("r", "0", 2, 300.0, 400.0, 70, 3), ("r", "0", 3, 400.0, 400.0, 10, 99)], "route_id string, direction string, leg int, start_m double, end_m double, avg int, n long")
    way = spark.createDataFrame([(1, "r", "0", 50.0, 350.0), (2, "r", "0", 120.0, 200.0)], "q int, route_id string, direction string, from_m double, to_m double")
    got = rides.ride_total(way, spans, F.col("avg"), ["q"]).collect()
    fill = (50 + 70 + 10) / 3
    assert len(got) == 1 and got[0].q == 1
    assert got[0].seconds == pytest.approx(25 + fill + 35) and (got[0].holes, got[0].legs, got[0].observations) == (1, 3, 3)


def test_ride_options(spark):
    line = spark.createDataFrame([("r", d, i, x, y) for d, pts in (("0", [(0.0, 0.0), (1000.0, 0.0)]), ("1", [(1000.0, 10.0), (0.0, 10.0)])) for i, (x, y) in enumerate(pts)], "route_id string, direction string, i int, x double, y double")
    line = polyline.cumulative(line, ["route_id", "direction"])
    dist = spark.createDataFrame([("r", d, k, 500.0 * k) for d in "01" for k in range(3)], "route_id string, direction string, k int, dist_m double")
    values = spark.createDataFrame([("r", d, k, 60, 60 + 10 * k, 9) for d in "01" for k in range(2)], "route_id string, direction string, leg int, med int, avg int, n long")
    q = spark.createDataFrame([(1, 100.0, 5.0, 900.0, 5.0, 800.0), (2, 900.0, 5.0, 100.0, 5.0, 800.0), (3, 100.0, 900.0, 900.0, 5.0, 1200.0)], "q int, a_x double, a_y double, b_x double, b_y double, direct double")
    got = {(r.q, r.direction): (round(r.seconds, 6), r.metres, r.board, r.alight, r.stops) for r in rides.ride_options(q, polyline.segments(line, ["route_id", "direction"]), dist, values).collect()}
    assert got == {(1, "0"): (round(0.8 * 60 + 0.8 * 70, 6), 800.0, 0, 1, 1), (2, "1"): (round(0.8 * 60 + 0.8 * 70, 6), 800.0, 0, 1, 1)}
