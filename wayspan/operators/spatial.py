"""Distance joins through a grid of buckets.

Each site is copied to the buckets within its reach, so a point looks only into
its own: an equi-join with the distance as residual, or with an array of the bucket's
sites where one row a point is wanted.  A site has at most
(2 * ceil(radius / bucket) + 1) ** 2 copies, whatever its neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import angle_between, round_half_even
from ..tables import settled


def site_buckets(sites: DataFrame, reach: int, bucket: float, x: str = "x", y: str = "y") -> DataFrame:
    """Sites with ``bx``, ``by`` of every bucket within ``reach``."""
    steps = F.array(*[F.lit(i) for i in range(-reach, reach + 1)])
    s = sites.withColumn("bx", F.explode(F.transform(steps, lambda d: F.floor(F.col(x) / bucket).cast("long") + d)))
    return s.withColumn("by", F.explode(F.transform(steps, lambda d: F.floor(F.col(y) / bucket).cast("long") + d)))


def squared(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by)


def near(points: DataFrame, sites: DataFrame, radius: float, keys: list[str] | None = None, how: str = "inner", bucket: float = 100.0, strict: bool = False) -> DataFrame:
    """Points (x, y) with sites (x, y) within ``radius``: ``how`` is inner, left_semi or left_anti.

    ``keys`` are equality columns of both sides.  Of an inner join the site's columns
    come as ``site_*``, with ``d2``.
    """
    keys = keys or []
    names = {c: f"site_{c}" for c in sites.columns}
    s = site_buckets(sites, math.ceil(radius / bucket), bucket).withColumnsRenamed(names)
    p = points.withColumns({"__bx": F.floor(F.col("x") / bucket).cast("long"), "__by": F.floor(F.col("y") / bucket).cast("long")})
    d2 = squared(F.col("x"), F.col("y"), F.col("site_x"), F.col("site_y"))
    on = (F.col("__bx") == F.col("bx")) & (F.col("__by") == F.col("by")) & (d2 < radius * radius if strict else d2 <= radius * radius)
    for k in keys:
        on = on & (F.col(k) == F.col(f"site_{k}"))
    out = p.join(s, on, how)
    if how == "inner":
        out = out.withColumn("d2", d2).drop("bx", "by")
    return out.drop("__bx", "__by")


def packed(sites: DataFrame, keys: list[str], reach: Column | int, bucket: float) -> DataFrame:
    """(keys, bx, by, sites): the sites that points of a bucket may lie within reach of, as one array.

    Sites are a dimension: what lies within reach of one bucket is bounded by their
    density, not by the points.  ``reach`` counts buckets and may differ by site.
    """
    far = reach if isinstance(reach, Column) else F.lit(reach)
    at = lambda c: F.floor(F.col(c) / bucket).cast("long")
    around = lambda c: F.explode(F.sequence(at(c) - far, at(c) + far))
    whole = F.struct(*[F.col(c) for c in sites.columns]).alias("site")
    s = sites.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(whole, *[F.col(k).alias(f"__{k}") for k in keys], far.alias("far"), "x", "y")
    far = F.col("far")
    s = s.withColumn("bx", around("x")).withColumn("by", around("y"))
    return s.groupBy(*[f"__{k}" for k in keys], "bx", "by").agg(F.collect_list("site").alias("sites")).withColumnsRenamed({f"__{k}": f"site_{k}" for k in keys})


def beside(points: DataFrame, packs: DataFrame, keys: list[str], bucket: float, how: str = "inner") -> DataFrame:
    """Points (x, y) with the array ``sites`` of their bucket: each point is joined once."""
    p = points.withColumns({"__bx": F.floor(F.col("x") / bucket).cast("long"), "__by": F.floor(F.col("y") / bucket).cast("long")})
    on = (F.col("__bx") == F.col("bx")) & (F.col("__by") == F.col("by"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"site_{k}"))
    return p.join(packs, on, how).drop("__bx", "__by", "bx", "by", *[f"site_{k}" for k in keys])


def nearest(points: DataFrame, sites: DataFrame, radius: float, point_key: list[str], site_key: str, keys: list[str] | None = None, bucket: float | None = None, strict: bool = True) -> DataFrame:
    """(point_key, site): the nearest site of each point that has any within ``radius``, with ``d2``; of equally near ones the least ``site_key``.

    The minimum is taken in the point's row, so points are neither multiplied nor
    shuffled.  Of sites at one place only that of least ``site_key`` is looked at.  Sites
    within a quarter of the radius come first, in buckets of that width; only points that
    have none there meet those of the larger buckets, half a radius wide unless given.
    """
    keys, bucket, close = keys or [], bucket or radius / 2, radius / 4
    whole = F.struct(*[F.col(c) for c in sites.columns])
    sites = settled(sites.groupBy(*[F.col(c).alias(f"__{c}") for c in [*keys, "x", "y"]]).agg(F.min(F.struct(F.col(site_key).alias("key"), whole.alias("site"))).alias("first")).select("first.site.*"))
    d2 = lambda s: squared(F.col("x"), F.col("y"), s["x"], s["y"])
    least = lambda c: F.array_min(F.transform(c, lambda s: F.struct(d2(s).alias("d2"), s[site_key].alias("key"), s.alias("site"))))
    j = beside(points, packed(sites, keys, 1, close), keys, close, "left").withColumn("__near", least("sites")).drop("sites")
    done = F.coalesce(F.col("__near.d2") <= close * close, F.lit(False))
    far = packed(sites, keys, math.ceil(radius / bucket), bucket).withColumn("site___far", F.lit(True))
    j = beside(j.withColumn("__far", ~done), far, [*keys, "__far"], bucket, "left")
    best = j.select(*point_key, F.when(F.col("__far"), least("sites")).otherwise(F.col("__near")).alias("best"))
    best = best.where(F.col("best.d2") < radius * radius if strict else F.col("best.d2") <= radius * radius)
    return best.select(*point_key, F.struct(*[F.col(f"best.site.{c}").alias(c) for c in sites.columns], F.col("best.d2").alias("d2")).alias("site"))


def in_zone(x: Column, y: Column, zones: list[tuple[float, float, float]]) -> Column:
    """Whether a point lies in any of a few circles (x, y, radius); circles are a literal array."""
    if not zones:
        return F.lit(False)
    z = F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y"), F.lit(float(r) ** 2).alias("r2")) for a, b, r in zones])
    return F.exists(z, lambda c: squared(x, y, c["x"], c["y"]) <= c["r2"])


def nearest_cell(queries: DataFrame, cells: DataFrame, radius: float, bucket: float | None = None, max_angle: float | None = None, lane: float = 0.0) -> DataFrame:
    """(q, cell, d2): the nearest cell of each query (q, x, y and, for ``max_angle``, heading); cells: (cell, x, y, dir).

    With ``lane`` metres a cell counts where its arrow is drawn: beside its place, to the
    right of its heading; squared distances are then rounded to six decimals.  Buckets
    are half a radius wide unless given.
    """
    bucket = bucket or radius / 2
    if lane:
        turn = F.radians(F.col("dir").cast("double"))
        cells = cells.withColumns({"x": F.col("x") + F.cos(turn) * lane, "y": F.col("y") - F.sin(turn) * lane})
    j = beside(queries, packed(cells, [], math.ceil(radius / bucket), bucket), [], bucket)
    sites = F.col("sites")
    if max_angle is not None:
        sites = F.filter(sites, lambda s: F.col("heading").isNull() | (angle_between(F.col("heading").cast("double"), s["dir"].cast("double")) <= max_angle))
    d2 = lambda s: squared(F.col("x"), F.col("y"), s["x"], s["y"])
    ranked = F.transform(sites, lambda s: F.struct((round_half_even(d2(s), 6) if lane else d2(s)).alias("d2"), s["cell"].alias("cell")))
    return j.select("q", F.array_min(ranked).alias("best")).where(F.col("best.d2") <= radius * radius).select("q", "best.cell", "best.d2")
