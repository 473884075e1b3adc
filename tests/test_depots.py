from wayspan.operators import depots

CELL = "cx int, cy int, hour int, n long, sum_speed double, sum_lat double, sum_lon double"


def test_slow_cells(spark, rows):
    c = spark.createDataFrame([(0, 0, h, 30, 3.0, 0.0, 0.0) for h in range(10)] + [(1, 0, h, 30, 3.0, 0.0, 0.0) for h in range(9)] + [(2, 0, h, 30, 300.0, 0.0, 0.0) for h in range(12)], CELL)
    assert rows(depots.slow_cells(c, 4, 300, 10), "cx", "n", "slow_hours") == [(0, 300, 10)]


def test_shielded_by_a_stop_but_not_a_terminal(spark, rows):
    c = spark.createDataFrame([(0, 0, 0.0, 0.0), (9, 0, 1000.0, 0.0), (20, 0, 5000.0, 0.0)], "cx int, cy int, x double, y double")
    stops = spark.createDataFrame([("m", 60.0, 0.0, False), ("t", 1060.0, 0.0, True), ("t", 1060.0, 0.0, False), ("f", 5120.0, 0.0, False)], "stop_id string, x double, y double, is_terminal boolean")
    assert rows(depots.unshielded(c, stops, 120, ["cx", "cy"]), "cx") == [(9,), (20,)]


def test_clusters_and_stats(spark, rows):
    cells = [(0, 0), (2, 2), (4, 4), (7, 4), (10, 10)] + [(100 + i, 0) for i in range(0, 40, 2)]
    df = spark.createDataFrame([(x, y, x * 25.0, y * 25.0, 10, 5.0) for x, y in cells], "cx int, cy int, x double, y double, n long, sum_speed double")
    got = depots.clusters(df, 2)
    sizes = {tuple(r.cluster): r.cells for r in depots.cluster_stats(got, 40.0).collect()}
    assert sizes == {(0, 0): 3, (7, 4): 1, (10, 10): 1, (100, 0): 20}
    first = depots.cluster_stats(got, 40.0).where("cluster.cx = 0").first()
    assert (first.x, first.y, first.samples) == (50.0, 50.0, 30) and round(first.radius_m, 3) == round(40 + 50 * 2**0.5, 3)


def test_clusters_of_nothing(spark):
    assert depots.clusters(spark.createDataFrame([], "cx int, cy int")).count() == 0


def test_merge(spark, rows):
    site = "x double, y double, radius_m double, samples int"
    old = spark.createDataFrame([(0.0, 0.0, 100.0, 5)], site)
    found = spark.createDataFrame([(50.0, 0.0, 10.0, 9), (100.0, 0.0, 10.0, 8), (101.0, 0.0, 10.0, 7), (102.0, 0.0, 10.0, 6)], site)
    assert [r.x for r in depots.merge_sites(old, found).collect()] == [101.0, 102.0, 0.0]
