import math
import random
import time

import pytest
from pyspark.sql import functions as F

from wayspan.operators import polyline as pl

CORNER = [(0, 0), (500, 0), (1000, 0), (1000, 1000)]
TWO_WAYS = [((26, 383), (83, 159)), ((127, 444), (171, 112)), ((251, 468), (215, 39)), ((335, 91), (313, 373))]
BETWEEN = [(60, 248), (156, 226), (229, 201), (327, 193)]
EQUALLY_FAR = [[(474, 11), (418, 122), (331, 261), (213, 428)], [(259, 424), (266, 413), (289, 404), (466, 343)], [(55, 398), (72, 372), (79, 339), (83, 266)]]
THERE_AND_BACK = [(0, 0), (1000, 0), (1000, 40), (0, 40)]


def cum(line):
    out = [0.0]
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        out.append(out[-1] + math.hypot(bx - ax, by - ay))
    return out


@pytest.fixture
def frame(spark):
    return lambda line: pl.cumulative(spark.createDataFrame([("r", i, float(x), float(y)) for i, (x, y) in enumerate(line)], "r string, i int, x double, y double"), ["r"])


def ask(spark, line, x, y):
    return spark.createDataFrame([(1, float(x), float(y))], "q int, x double, y double")


def test_cumulative(frame):
    assert [r.cum for r in frame(CORNER).orderBy("i").collect()] == [0, 500, 1000, 2000]


@pytest.mark.parametrize(("line", "tol", "want"), [(CORNER, 1, [0, 2, 3]), ([(0, 0), (50, 2), (100, 0)], 5, [0, 2]), ([(0, 0), (50, 2), (100, 0)], 0, [0, 1, 2]), ([(0, 0)], 1, [0])])
def test_simplify(line, tol, want):
    assert pl.simplify_indices(line, tol) == want


def test_simplify_frame(frame):
    assert [r.i for r in pl.simplify(frame(CORNER), ["r"], 1.0).orderBy("i").collect()] == [0, 2, 3]


@pytest.mark.parametrize(("p", "along", "off"), [((300, 20), 300, 20), ((1200, 1200), 2000, math.hypot(200, 200))])
def test_project(spark, frame, p, along, off):
    r = pl.project(ask(spark, CORNER, *p).withColumn("r", F.lit("r")), pl.segments(frame(CORNER), ["r"]), ["r"]).first()
    assert (r.along, r.off) == (pytest.approx(along), pytest.approx(off))


def test_candidates(spark, frame):
    segs = pl.segments(frame(THERE_AND_BACK), ["r"])
    got = sorted(r.along for r in pl.candidates(ask(spark, None, 500, 20), segs, [], ["r"], 30).collect())
    assert got == [500, 1540]
    assert sorted(r.along for r in pl.passes(ask(spark, None, 500, 20), segs, [], ["r"], 30).collect()) == [500, 1540]


@pytest.mark.parametrize(
    ("line", "stops", "want"),
    [
        (CORNER, [(0, 5), (500, 5), (1000, 0), (995, 700)], [0, 500, 1000, 1700]),
        (THERE_AND_BACK, [(100, 10), (900, 10), (500, 35)], [100, 900, 1540]),
        ([(0, 0), (1000, 0)], [(500, 5), (490, 5), (900, 5)], [500, 500, 900]),
        (CORNER, [(0, 5), (500, 900)], None),
        ([(0, 0)], [(0, 0)], None),
    ],
)
def test_match(line, stops, want):
    got = pl.match_sequence(line, cum(line), stops, 60)
    assert got == (want if want is None else pytest.approx(want))


def test_match_frame(spark, frame):
    at = spark.createDataFrame([("r", k, float(x), float(y)) for k, (x, y) in enumerate([(0, 5), (500, 5), (995, 700)])], "r string, k int, x double, y double")
    assert [r.dist_m for r in pl.match_stops(frame(CORNER), at, ["r"], 60).orderBy("k").collect()] == pytest.approx([0, 500, 1700])
    lost = at.unionByName(spark.createDataFrame([("r", 3, None, None)], "r string, k int, x double, y double"))
    assert pl.match_stops(frame(CORNER), lost, ["r"], 60).count() == 0


def test_slices(spark, frame):
    line = frame(CORNER)
    at = spark.createDataFrame([("r", 250.0), ("r", 1500.0), ("r", 9999.0)], "r string, dist double")
    got = {r.dist: (r.x, r.y) for r in pl.point_along(pl.segments(line, ["r"]), at, ["r"]).collect()}
    assert got == {250.0: (250, 0), 1500.0: (1000, 500), 9999.0: (1000, 1000)}
    ends = spark.createDataFrame([("r", 250.0, 1500.0)], "r string, from_m double, to_m double")
    assert [(r.x, r.y) for r in pl.slice_between(line, ends, ["r"]).orderBy("pos").collect()] == [(250, 0), (500, 0), (1000, 0), (1000, 500)]


def plain_simplify(line, tol):
    """Douglas-Peucker as it is usually told."""
    if len(line) < 3:
        return list(range(len(line)))

    def off(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    at = max(range(1, len(line) - 1), key=lambda i: off(line[i], line[0], line[-1]))
    if off(line[at], line[0], line[-1]) <= tol:
        return [0, len(line) - 1]
    return plain_simplify(line[: at + 1], tol) + [at + i for i in plain_simplify(line[at:], tol)[1:]]


@pytest.mark.parametrize("seed", range(12))
def test_simplify_like_the_plain_form(seed):
    rng = random.Random(seed)
    line = [(rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(rng.randint(0, 60))]
    if seed % 3 == 0:
        line += line[:1]
    for tol in (0, 5, 20, 60, 200):
        assert pl.simplify_indices(line, tol) == plain_simplify(line, tol)


@pytest.mark.parametrize("seed", range(12))
def test_match_is_the_cheapest_chain(seed):
    """Against all chains of candidate places."""
    import itertools

    import numpy as np

    rng = random.Random(seed)
    line = [(rng.uniform(0, 300), rng.uniform(0, 300)) for _ in range(8)]
    stops = [(rng.uniform(0, 300), rng.uniform(0, 300)) for _ in range(4)]
    far, length = 90, np.array(cum(line))
    places = [list(zip(*pl.places_near(np.array(line), length, np.array(s), far, 6), strict=True)) for s in stops]
    chains = [c for c in itertools.product(*places) if all(a[0] - 80 < b[0] for a, b in zip(c, c[1:]))]
    got = pl.match_sequence(line, length, stops, far)
    if not chains:
        assert got is None
    else:
        best = min(chains, key=lambda c: sum(off for _, off in c))
        assert got == pytest.approx(list(itertools.accumulate((a for a, _ in best), max)))


def test_offsets_that_differ_in_their_last_bits_count_as_equal(spark, frame):
    """A stretch that is driven there and, later, back is equally near both times, whatever the last bits say: the first comes first."""
    line = []
    for a, b in TWO_WAYS:
        line += [a, b, (600, 600), b, a, (600, 600)]
    segs = pl.segments(frame(line), ["r"])
    asked = spark.createDataFrame([(q, float(x), float(y)) for q, (x, y) in enumerate(BETWEEN)], "q int, x double, y double")
    got = {}
    for r in pl.candidates(asked, segs, [], ["r"], 20, decimals=6).where("off < 0.5").orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append(r.along)
    assert len(got) == len(BETWEEN)
    assert all(len(places) == 2 and places == sorted(places) for places in got.values())


def test_simplify_keeps_the_foremost_of_equally_far_vertices():
    """Two vertices in line with their chord are equally far from it, whatever the last bits say."""
    for line in EQUALLY_FAR:
        tol = plain_off(line[1], line[0], line[3]) - 0.001
        assert pl.simplify_indices(line, tol) == [0, 2, 3]
        assert pl.simplify_indices(line, tol, 6) == [0, 1, 3]


def plain_off(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)
    return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)


@pytest.mark.parametrize("k", range(4))
def test_a_pass_there_and_back_is_one(spark, frame, k):
    """Turned round at once, a stretch is equally near both ways: one pass, on its last segment."""
    (a, b), at = TWO_WAYS[k], BETWEEN[k]
    line = [b, a, b]
    segs = pl.segments(frame(line), ["r"])
    length = math.dist(a, b)
    want = [length + plain_t(at, a, b) * length]
    assert [r.along for r in pl.passes(ask(spark, line, *at), segs, [], ["r"], 20, 6).collect()] == pytest.approx(want)
    whole = [r.along for r in pl.passes(ask(spark, line, *at), segs, [], ["r"], 20).collect()]
    assert len(whole) == 1 and whole != pytest.approx(want)


def plain_t(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    return ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy)


def test_project_looks_at_shared_places_and_stretches_once(spark, frame):
    """Many queries at one place, and a line of many rounds: 2 * 10**9 pairs; a place without x has no offset."""
    ring, rounds, n = [(0, 0), (100, 0), (100, 100), (0, 100)], 5_000, 100_000
    q = spark.range(n).select(F.col("id").alias("q"), F.lit("r").alias("r"), F.when(F.col("id") % 5 < 4, (F.col("id") % 5 * 10).cast("double")).alias("x"), F.lit(-3.0).alias("y"))
    begin = time.monotonic()
    got = pl.project(q, pl.segments(frame(ring * rounds), ["r"]), ["r"], 6).groupBy("along", "off").count().collect()
    assert time.monotonic() - begin < 60
    assert {(r.along, r.off): r["count"] for r in got} == {(10.0 * k, 3.0): n // 5 for k in range(4)} | {(100.0, None): n // 5}


@pytest.mark.parametrize("at", [0, 5, 16, 250, 4093])
def test_tree_sums(at):
    """From left to right: single values, whole nodes, single values."""
    import numpy as np

    x = np.random.default_rng(at).uniform(0, 700, 900)
    node = lambda a, n: 0.0 + sum((v for v in node_values(a, n)), 0.0)

    def node_values(a, n):
        return [x[a - at]] if n == 1 else [node(a + j * n // 16, n // 16) for j in range(16)]

    for end in (1, 3, 15, 16, 17, 100, 300, 899, 900):
        a, total = at, 0.0
        while a < at + end:
            n = 1
            while a % (16 * n) == 0 and a + 16 * n <= at + end:
                n *= 16
            total += x[a - at] if n == 1 else node(a, n)
            a += n
        assert pl.tree_sums(x, at)[end - 1] == total


def test_candidates_look_at_shared_places_once(spark, frame):
    """Many queries at few places, and a line of many rounds: 2 * 10**8 pairs; a place without x has no candidates."""
    ring, rounds, n = [(0, 0), (100, 0), (100, 100), (0, 100)], 1_000, 50_000
    q = spark.range(n).select(F.col("id").alias("q"), F.when(F.col("id") % 5 < 4, (10 + F.col("id") % 5 * 10).cast("double")).alias("x"), F.lit(-3.0).alias("y"))
    begin = time.monotonic()
    got = pl.candidates(q, pl.segments(frame(ring * rounds), ["r"]), [], ["r"], 20, decimals=6).groupBy("rank", "along", "off").count().collect()
    assert time.monotonic() - begin < 60
    assert {(r.rank, r.along, r.off): r["count"] for r in got} == {(k + 1, 400.0 * k + 10.0 * j, 3.0): n // 5 for k in range(6) for j in (1, 2, 3, 4)}
