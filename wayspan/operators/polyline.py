"""Polylines: lengths, projections, simplification, matching of stops, slices.

Vertices are rows (line key, i, x, y).  Simplification and matching are sequential
by nature and run as grouped Arrow functions, a line at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import round_half_even


def cumulative(points: DataFrame, keys: list[str]) -> DataFrame:
    """``cum``: length of the line up to each vertex."""
    w = W.partitionBy(*keys).orderBy("i")
    step = F.coalesce(F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)), F.lit(0.0))
    return points.withColumn("__step", step).withColumn("cum", F.sum("__step").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__step")


#: Values under a node of the tree in which ``tree_sums`` adds.
FAN = 16


def tree_sums(values: np.ndarray, at: int = 0, before: float = 0.0) -> np.ndarray:
    """``before`` and the values up to each, added as a segment tree does in which the first value is leaf ``at``.

    From left to right: single values up to a node's border, whole nodes (by their nodes in
    turn), single values again.  A node is the sum of its values, one after the other.
    """
    head = min(-at % FAN, len(values))
    first = np.cumsum(np.concatenate(([before], values[:head])))
    rest = values[head:]
    whole = len(rest) // FAN
    rows = np.concatenate([rest, np.zeros(-len(rest) % FAN)]).reshape(-1, FAN)
    start = first[-1:]
    if whole:
        start = np.concatenate([start, tree_sums(np.cumsum(rows[:whole], axis=1)[:, -1], (at + head) // FAN, first[-1])])
    rows[:, 0] += start[: len(rows)]
    sums = np.cumsum(rows, axis=1)
    sums[:whole, -1] = start[1:]
    return np.concatenate([first[1:], sums.ravel()[: len(rest)]])


def cumulative_in_tree(points: DataFrame, keys: list[str], together: str) -> DataFrame:
    """``cum`` as of ``cumulative``, but for the order of addition: that of a tree over all lines of a ``together``, end to end by key."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*keys, "i"], kind="stable").reset_index(drop=True)
        head = np.flatnonzero((pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy())
        step = np.nan_to_num(np.sqrt((pdf[["x", "y"]].diff().to_numpy() ** 2).sum(axis=1)))
        step[head] = 0.0
        cum = [tree_sums(step[a:z], a) for a, z in zip(head, np.append(head[1:], len(pdf)), strict=True)]
        return pdf.drop(columns=together).assign(cum=np.concatenate(cum))

    schema = ", ".join(f"{c} {t}" for c, t in [*points.drop(together).dtypes, ("cum", "double")])
    return points.groupBy(together).applyInPandas(run, schema)


def segments(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i, ax, ay, bx, by, cum) of vertex pairs; expects ``cum``."""
    w = W.partitionBy(*keys).orderBy("i")
    s = points.select(*keys, "i", F.col("x").alias("ax"), F.col("y").alias("ay"), F.lead("x").over(w).alias("bx"), F.lead("y").over(w).alias("by"), "cum")
    return s.where("bx is not null")


def along_off(x: Column, y: Column, seg: Column | None = None) -> tuple[Column, Column]:
    """Distance along and from the segment (ax, ay, bx, by, cum; columns, or fields of ``seg``) of the point nearest to (x, y)."""
    ax, ay, bx, by, cum = (F.col(c) if seg is None else seg[c] for c in ("ax", "ay", "bx", "by", "cum"))
    dx, dy = bx - ax, by - ay
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((x - ax) * dx + (y - ay) * dy, len2))))
    ox, oy = x - ax - t * dx, y - ay - t * dy
    return cum + t * F.sqrt(len2), F.sqrt(F.pow(ox, F.lit(2.0)) + F.pow(oy, F.lit(2.0)))


def _equal_in(off: Column, decimals: int | None) -> Column:
    """Offsets as they are compared: in so many decimals, or in full."""
    return off if decimals is None else round_half_even(off, decimals)


def project(queries: DataFrame, segs: DataFrame, keys: list[str], decimals: int | None = None) -> DataFrame:
    """(q, keys, along, off): the nearest place of each query (q, keys, x, y) on its line; of equally near ones the first segment.

    A line's segments are one array, so a place meets its line once and the minimum is
    taken in its row.  Places that several queries share are looked at once, and so are
    stretches that a line runs through again: of those the first is never farther.
    ``decimals`` are those in which offsets count as equal.
    """
    shape = ["ax", "ay", "bx", "by"]
    first = segs.groupBy(*keys, *shape).agg(F.min(F.struct("i", "cum")).alias("first"))
    seg = F.struct("first.i", *shape, "first.cum")
    lines = first.groupBy(*keys).agg(F.array_sort(F.collect_list(seg)).alias("segs"))
    x, y = F.col("x"), F.col("y")

    def place(s: Column) -> Column:
        along, off = along_off(x, y, s)
        return F.struct(_equal_in(off, decimals).alias("near"), s["i"].alias("i"), along.alias("along"), off.alias("off"))

    # queries of a place stand in some arrays, so that none grows with a crowded place alone
    crowd = queries.groupBy(*keys, "x", "y", F.pmod(F.xxhash64("q"), F.lit(4)).alias("part")).agg(F.collect_list("q").alias("qs"))
    j = crowd.join(lines, keys).select("qs", *keys, F.array_min(F.transform("segs", place)).alias("p"))
    return j.select(F.explode("qs").alias("q"), *keys, "p.along", "p.off")


def offsets_within(queries: DataFrame, segs: DataFrame, on: list[str], max_off: float) -> DataFrame:
    """Query points (q, x, y) and segments of their lines within ``max_off``: (q, keys, i, along, off), by an equi-join on grid buckets.

    A segment is copied to the buckets of its bounding box, widened by ``max_off``; a
    query looks into its own, so each pair meets once.
    """
    size = max(float(max_off), 1.0)

    def reach(a: str, b: str) -> Column:
        first, last = F.floor((F.least(a, b) - max_off) / size), F.floor((F.greatest(a, b) + max_off) / size)
        return F.explode(F.sequence(first.cast("long"), last.cast("long")))

    s = segs.withColumn("gx", reach("ax", "bx")).withColumn("gy", reach("ay", "by"))
    q = queries.withColumns({"gx": F.floor(F.col("x") / size).cast("long"), "gy": F.floor(F.col("y") / size).cast("long")})
    along, off = along_off(F.col("x"), F.col("y"))
    return q.join(s, [*on, "gx", "gy"]).withColumns({"along": along, "off": off}).where(F.col("off") <= max_off).drop("gx", "gy")


def _beside(step: int, w) -> Column:
    """The offset of the neighbouring segment, null if that is too far away to be here (or not there at all)."""
    shift = F.lag if step < 0 else F.lead
    return F.when(shift("i").over(w) == F.col("i") + step, shift("near").over(w))


def _place_by_place(queries: DataFrame, on: list[str], find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Queries with what ``find`` finds at their places (on, x, y): a place that several share is looked at once."""
    place = [*on, "x", "y"]
    return queries.select("q", *place).join(find(queries.select(*place).distinct()), place)


def candidates(queries: DataFrame, segs: DataFrame, on: list[str], keys: list[str], max_off: float, limit: int = 6, decimals: int | None = None) -> DataFrame:
    """Local minima of the offset within ``max_off``, the nearest ``limit``: (q, keys, rank, along, off).

    ``decimals`` are those in which offsets count as equal; of equal ones the first segment comes first.
    """
    line = W.partitionBy("x", "y", *keys)

    def find(places: DataFrame) -> DataFrame:
        o = offsets_within(places, segs, on, max_off).withColumn("near", _equal_in(F.col("off"), decimals))
        w = line.orderBy("i")
        low = F.coalesce(_beside(-1, w) >= F.col("near"), F.lit(True)) & F.coalesce(_beside(1, w) >= F.col("near"), F.lit(True))
        rank = F.row_number().over(line.orderBy("near", "i"))
        return o.withColumn("low", low).where("low").withColumn("rank", rank).where(F.col("rank") <= limit)

    return _place_by_place(queries, on, find).select("q", *keys, "rank", "along", "off")


def passes(queries: DataFrame, segs: DataFrame, on: list[str], keys: list[str], max_off: float, decimals: int | None = None) -> DataFrame:
    """One place for each pass of a line near a query; a plateau is one pass, its last segment.

    A segment counts if it is not farther than the one before and nearer than the one
    after.  ``decimals`` are those in which offsets are compared, with ``max_off`` too.
    """
    slack = 0.0 if decimals is None else 10.0**-decimals
    w = W.partitionBy("x", "y", *keys).orderBy("i")

    def find(places: DataFrame) -> DataFrame:
        o = offsets_within(places, segs, on, max_off + slack).withColumn("near", _equal_in(F.col("off"), decimals))
        falls = F.coalesce(F.col("near") <= _beside(-1, w), F.lit(True))
        rises = F.coalesce(_beside(1, w) > F.col("near"), F.lit(True))
        return o.withColumn("low", falls & rises).where(F.col("low") & (F.col("near") <= max_off))

    return _place_by_place(queries, on, find).select("q", *keys, "along", "off")


def to_chords(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of the way along the chord a-b of the place nearest to each point, and the distance to it."""
    d = b - a
    length2 = (d * d).sum(axis=-1)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(length2 > 0, ((points - a) * d).sum(axis=-1) / length2, 0.0).clip(0.0, 1.0)
    off = points - a - t[..., None] * d
    return t, np.hypot(off[..., 0], off[..., 1])


def simplify_indices(xy, tol: float, decimals: int | None = None) -> list[int]:
    """Vertices that Douglas-Peucker keeps: of each stretch its ends, and the farthest vertex from their chord if farther than ``tol``.

    All stretches of one depth are measured together.  ``decimals`` are those in which
    distances count as equal; of equally far vertices the foremost is kept.
    """
    xy = np.asarray(xy, float).reshape(-1, 2)
    kept = np.zeros(len(xy), bool)
    kept[[0, -1] if len(xy) else []] = True
    ends = np.flatnonzero(kept)
    open_ = np.diff(ends) > 1
    while open_.any():
        # each inner vertex of an open stretch, with its stretch
        inner = np.flatnonzero(~kept)
        stretch = np.searchsorted(ends, inner) - 1
        live = open_[stretch]
        inner, stretch = inner[live], stretch[live]
        off = to_chords(xy[inner], xy[ends[stretch]], xy[ends[stretch + 1]])[1]
        if decimals is not None:
            off = off.round(decimals)
        first = np.lexsort((inner, -off, stretch))  # by stretch, the farthest and then the foremost first
        first = first[np.concatenate(([True], np.diff(stretch[first]) > 0))]
        new = inner[first[off[first] > tol]]
        grown = np.union1d(ends, new)
        # only stretches that were just divided go on
        fresh = np.isin(grown, new)
        open_ = (fresh[:-1] | fresh[1:]) & (np.diff(grown) > 1)
        kept[new] = True
        ends = grown
    return np.flatnonzero(kept).tolist()


def simplify(points: DataFrame, keys: list[str], tol: float, decimals: int | None = None) -> DataFrame:
    """The vertices that Douglas-Peucker keeps, a line at a time."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i", kind="stable")
        return pdf.iloc[simplify_indices(pdf[["x", "y"]].to_numpy(), tol, decimals)]

    return points.groupBy(*keys).applyInPandas(run, points.schema)


def places_near(xy: np.ndarray, cum: np.ndarray, at: np.ndarray, max_off: float, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances along and from the line of the places where it passes ``at``: local minima within ``max_off``, the nearest ``limit``."""
    t, off = to_chords(np.broadcast_to(at, (len(xy) - 1, 2)), xy[:-1], xy[1:])
    wall = np.concatenate(([np.inf], off, [np.inf]))
    low = np.flatnonzero((off <= max_off) & (wall[:-2] >= off) & (wall[2:] >= off))
    low = low[np.argsort(off[low], kind="stable")[:limit]]
    return cum[low] + t[low] * np.hypot(*(xy[low + 1] - xy[low]).T), off[low]


def match_sequence(xy, cum, stops, max_off: float, slack: float = 80.0, limit: int = 6) -> list[float] | None:
    """Cheapest places of the stops in order, or None if there are none.

    Each stop adds the offset of its place to the cheapest of the costs of places that
    it may follow, those less than ``slack`` beyond it.  Steps back are levelled at the end.
    """
    xy, cum, stops = np.asarray(xy, float).reshape(-1, 2), np.asarray(cum, float), np.asarray(stops, float).reshape(-1, 2)
    if len(xy) < 2 or not len(stops):
        return None
    along, back, cost = [], [], np.zeros(1)
    for stop in stops:
        here, off = places_near(xy, cum, stop, max_off, limit)
        follows = along[-1][None, :] - slack < here[:, None] if along else np.ones((len(here), 1), bool)
        price = np.where(follows, cost, np.inf)
        if not np.isfinite(price).any():
            return None
        back.append(price.argmin(axis=1))
        along.append(here)
        cost = price.min(axis=1) + off
    at, out = int(cost.argmin()), []
    for here, origin in zip(reversed(along), reversed(back), strict=True):
        out.append(here[at])
        at = int(origin[at])
    return np.maximum.accumulate(out[::-1]).tolist()


def match_stops(points: DataFrame, stops: DataFrame, keys: list[str], max_off: float, slack: float = 80.0, limit: int = 6) -> DataFrame:
    """(keys, k, dist_m) for lines whose stops (keys, k, x, y) all fit; points: (keys, i, x, y, cum)."""
    schema = ", ".join([f"{c} {t}" for c, t in points.select(*keys).dtypes] + ["k int", "dist_m double"])

    def run(line: pd.DataFrame, stop: pd.DataFrame) -> pd.DataFrame:
        line, stop = line.sort_values("i", kind="stable"), stop.sort_values("k", kind="stable")
        found = None
        if len(line) and len(stop) and not stop[["x", "y"]].isna().any().any():
            found = match_sequence(line[["x", "y"]].to_numpy(), line["cum"].to_numpy(), stop[["x", "y"]].to_numpy(), max_off, slack, limit)
        if found is None:
            return stop.iloc[:0][[*keys, "k"]].assign(dist_m=pd.Series(dtype=float))
        return stop[[*keys, "k"]].assign(dist_m=found)

    return points.groupBy(*keys).cogroup(stops.groupBy(*keys)).applyInPandas(run, schema)


def point_along(segs: DataFrame, at: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, dist) -> x, y on the line at that distance; past the end its last vertex."""
    j = at.join(segs, keys).withColumn("len", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))
    hit = F.col("cum") + F.col("len") >= F.col("dist")
    best = F.coalesce(F.min_by(F.struct("ax", "ay", "bx", "by", "cum", "len"), F.when(hit, F.col("i"))), F.max_by(F.struct("ax", "ay", "bx", "by", "cum", "len"), F.col("i")))
    g = j.groupBy(*keys, "dist").agg(best.alias("s"))
    t = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("dist") - F.col("s.cum"), F.col("s.len")), F.lit(0.0)))
    return g.select(*keys, "dist", (F.col("s.ax") + (F.col("s.bx") - F.col("s.ax")) * t).alias("x"), (F.col("s.ay") + (F.col("s.by") - F.col("s.ay")) * t).alias("y"))


def slice_between(points: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """Vertices strictly between two distances and the points at both: (keys, pos, x, y); points need ``cum``."""
    inner = points.join(ends, keys).where((F.col("cum") > F.col("from_m")) & (F.col("cum") < F.col("to_m"))).select(*keys, F.col("cum").alias("pos"), "x", "y")
    segs = segments(points, keys)
    both = ends.select(*keys, F.col("from_m").alias("dist")).unionByName(ends.select(*keys, F.col("to_m").alias("dist")))
    return inner.unionByName(point_along(segs, both, keys).select(*keys, F.col("dist").alias("pos"), "x", "y"))
