import datetime

from network import N, POSITION, START, T0, entity, feed, position, write_static

from wayspan.params import Params
from wayspan.plans import api, cli, publish
from wayspan.sources import stores


def test_static_date():
    assert stores.static_date_for("2026-08-06", ["2026-08-01", "2026-08-05", "2026-09-01"]) == "2026-08-05"
    assert stores.static_date_for("2026-07-01", ["2026-08-01", "2026-08-05"]) == "2026-08-01"
    assert stores.static_date_for("2026-07-01", []) is None


def test_asof_frame(spark, rows):
    d = datetime.date
    days = spark.createDataFrame([(d(2026, 8, 6),), (d(2026, 7, 1),)], "day date")
    have = spark.createDataFrame([(d(2026, 8, 1),), (d(2026, 8, 5),)], "static_date date")
    assert rows(stores.asof(days, have)) == [(d(2026, 7, 1), d(2026, 8, 1)), (d(2026, 8, 6), d(2026, 8, 5))]
    assert rows(stores.asof(days, have.where("false")))[0][1] is None


def test_mirror(spark, tmp_path):
    for side, names in (("a", "xy"), ("b", "yz")):
        (tmp_path / side / "agg").mkdir(parents=True)
        for n in names:
            (tmp_path / side / "agg" / n).write_text(side)
    assert stores.mirror(spark, f"{tmp_path}/a", f"{tmp_path}/b") == ["agg/x"]
    assert (tmp_path / "b/agg/y").read_text() == "b" and (tmp_path / "b/agg/x").read_text() == "a"


def test_params_from_env():
    p = Params.from_env({"TZ_LOCAL": "UTC", "MIN_SAMPLES": "7", "CELL_SIZE_M": "50"})
    assert (p.tz, p.min_samples, p.cell_size_m) == ("UTC", 7, 50.0)


def test_command_line(spark, tmp_path, monkeypatch):
    """Snapshots and a schedule in, published documents and answers out."""
    monkeypatch.setattr(cli.session, "build", lambda *a, **b: spark)
    day = tmp_path / "raw/2026-08-06"
    day.mkdir(parents=True)
    for i in range(40):
        t = T0 + 10 * i
        f = i / 39
        at = (START[0] + (N[0] - START[0]) * f, START[1] + (N[1] - START[1]) * f)
        (day / f"2026-08-06T{i:04d}Z.pb").write_bytes(feed(*[entity(*at, ts=t, vehicle=f"v{v}", bearing=45.0) for v in range(6)], ts=t))
    static = tmp_path / "static/2026-08-01"
    static.mkdir(parents=True)
    write_static(static)
    base = ["--raw", f"{tmp_path}/raw", "--static", f"{tmp_path}/static", "--out", f"{tmp_path}/data"]
    cli.main([*base, "speed", "--all"])
    cli.main([*base, "rides", "--all"])
    cli.main([*base, "publish", "--web", f"{tmp_path}/web"])
    assert stores.dates(spark, f"{tmp_path}/data/agg") == ["2026-08-06"]
    assert spark.read.text(f"{tmp_path}/web/cells").where("key = '2026-08-wd-10'").count() == 1
    cli.main([*base, "depots", "--force"])
    assert cli.read_sites(spark, f"{tmp_path}/data/depots.json") == []

    s, _ = cli._schedule(spark, cli.parser().parse_args([*base, "publish"]), "2026-08-06", Params())
    t = api.Transit(spark, publish.stored(spark, f"{tmp_path}/web/tables"), s)
    cells = t.speed_cells(hour=10)
    assert cells.count() > 5 and cells.first().v == 28.8
    c = cells.first()
    assert t.cell_at(c.lat, c.lon, 40.0).first().n >= c.n
    assert t.cell_at(c.lat, c.lon, 225.0).count() == 0
    assert t.arrow_at(c.lat, c.lon).count() == 1
    assert t.speed_cells(month="2031-01", daytype="xx", hour="99").count() == t.speed_cells().count()
    ride = t.rides(START, N).collect()
    assert [(r.route_id, r.direction) for r in ride] == [("R_BUS", "0")] and 350 < ride[0].seconds < 400
    assert t.rides(N, START).count() == 0
    assert t.nearest_hour(3) == t.nearest_hour() == 10 and len(t.metrics()) == 6 and '"samples"' in t.catalogue().first()[0]
    assert t.viewport(cells, *START, *N).count() > 0


def test_live_equals_batch(spark, tmp_path, rows):
    from wayspan.operators import funnel
    from wayspan.streaming import live

    schema = POSITION + ", x double, y double"
    data = [(*position(i, veh=T0 + i // 2 * 60, vehicle="v"), float(i), 0.0) for i in range(20)]
    df = spark.createDataFrame(data, schema)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    routes = spark.createDataFrame([("R_BUS",)], "route_id string")
    stream = live.live_positions(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), routes)
    q = live.live_cells(stream).writeStream.outputMode("append").format("memory").queryName("live_cells_out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    q = stream.writeStream.outputMode("append").format("memory").queryName("live_rows").option("checkpointLocation", f"{tmp_path}/ck2").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = funnel.mark_duplicates(funnel.with_bus_flag(df, routes).withColumn("verdict", funnel.fresh_verdict(120)))
    assert rows(spark.table("live_rows"), "veh_ts") == rows(batch.where("verdict is null"), "veh_ts")
