"""Every catalogue query against its SQL, where the driver's small tables are there."""

import math
import os

import pytest

from wayspan import catalog

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    c = duckdb.connect()
    for t in ("events", "lineitem", "supplier", "orders", "customer", "nation", "part"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(rows):
    v = lambda x: round(x, 6) + 0.0 if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(map(v, r)) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", [q for q in catalog.QUERIES if q not in ("selection_cube", "selection_percentiles")])
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = plain(tuple(r) for r in df.select(*cols).collect())
    if name in catalog.SQL:
        assert got == plain(duck.execute(f"select {','.join(cols)} from ({catalog.SQL[name]})").fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    if not os.path.isdir(SF):
        pytest.skip("no tables")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(("name", "joins", "exchanges"), [("nearest_stop", 2, 4), ("nearest_cell", 1, 3), ("trip_scoped_stop_mask", 4, 9), ("empty_selections", 1, 5), ("polyline_project", 1, 4)])
def test_plans(spark, name, joins, exchanges):
    """No cross joins, and no more joins and exchanges than the work needs."""
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    full = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Join") <= joins and sum("Exchange " in line and "Broadcast" not in line for line in full.splitlines()) <= exchanges


def test_ride_options_where_lines_run_round_again(spark, tmp_path):
    """Lines that repeat their stretch hold many ways of one length: of those the one that the SQL takes (F3)."""
    larger = "/root/testdata/sf0.01"
    if not os.path.isdir(larger):
        pytest.skip("no tables")
    c = duckdb.connect()
    c.execute(f"copy (select s_suppkey + 1000 * k as s_suppkey, s_nationkey from '{larger}/supplier.parquet', range(12) t(k)) to '{tmp_path}/supplier.parquet'")
    for t in ("events", "customer"):
        c.execute(f"copy (from '{larger}/{t}.parquet') to '{tmp_path}/{t}.parquet'")
    for t in ("supplier", "events", "customer"):
        c.execute(f"create view {t} as from '{tmp_path}/{t}.parquet'")
    got = catalog.ride_options(spark, str(tmp_path))
    cols = sorted(got.columns)
    want = plain(c.execute(f"select {','.join(cols)} from ({catalog.SQL['ride_options']})").fetchall())
    assert want and plain(tuple(r) for r in got.select(*cols).collect()) == want
