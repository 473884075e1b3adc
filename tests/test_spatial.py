import random

import pytest

from wayspan.operators import spatial


@pytest.mark.parametrize(("sites", "strict"), [(3, True), (60, False), (900, True)])
def test_nearest_is_the_nearest(spark, sites, strict):
    """Sparse and dense sites, ties and points on the radius itself: as by looking at all of them."""
    rng = random.Random(sites)
    s = [(k, rng.randrange(0, 600, 5), rng.randrange(0, 600, 5)) for k in range(sites)]
    p = [(q, rng.randrange(-200, 800, 5), rng.randrange(-200, 800, 5)) for q in range(400)]
    got = {r.q: (r.site.k, r.site.d2) for r in spatial.nearest(spark.createDataFrame(p, "q int, x int, y int"), spark.createDataFrame(s, "k int, x int, y int"), 100, ["q"], "k", strict=strict).collect()}
    want = {}
    for q, x, y in p:
        d2, k = min(((x - a) ** 2 + (y - b) ** 2, k) for k, a, b in s)
        if d2 < 10_000 or d2 == 10_000 and not strict:
            want[q] = (k, d2)
    assert got == want


@pytest.mark.parametrize("max_angle", [None, 90.0])
def test_nearest_cell_is_the_nearest(spark, max_angle):
    rng = random.Random(1)
    cells = [(k, rng.randrange(300), rng.randrange(300), rng.randrange(8) * 45) for k in range(150)]
    asked = [(q, rng.randrange(300), rng.randrange(300), rng.choice([None, 0, 130, 250])) for q in range(200)]
    apart = lambda a, b: min((a - b) % 360, (b - a) % 360)
    out = spatial.nearest_cell(spark.createDataFrame(asked, "q int, x int, y int, heading int"), spark.createDataFrame(cells, "cell int, x int, y int, dir int"), 40, max_angle=max_angle)
    want = {}
    for q, x, y, h in asked:
        ok = [((x - a) ** 2 + (y - b) ** 2, k) for k, a, b, d in cells if max_angle is None or h is None or apart(h, d) <= max_angle]
        if ok and min(ok)[0] <= 1600:
            want[q] = min(ok)[::-1]
    assert {r.q: (r.cell, r.d2) for r in out.collect()} == want


def test_nearest_looks_at_one_site_of_a_place(spark, monkeypatch):
    """Many sites at few places: a point meets that of least key of each, and far ones only if there is no close one."""
    met = []
    packed = spatial.packed

    def spy(*a):
        out = packed(*a)
        met.append(max(len(r.sites) for r in out.collect()))
        return out

    monkeypatch.setattr(spatial, "packed", spy)
    s = spark.range(8_000).selectExpr("id AS k", "id % 4 * 100.0D AS x", "0.0D AS y")
    p = spark.range(2_000).selectExpr("id AS q", "id % 40 * 10.0D AS x", "IF(id % 2 = 0, 0.0D, 99.0D) AS y")
    got = {r.q: (r.site.k, r.site.d2) for r in spatial.nearest(p, s, 100, ["q"], "k").collect()}
    want = {}
    for q in range(2_000):
        x, y = q % 40 * 10, 0 if q % 2 == 0 else 99
        d2, k = min(((x - k * 100) ** 2 + y * y, k) for k in range(4))
        if d2 < 10_000:
            want[q] = (k, d2)
    assert got == want
    assert max(met) <= 4
