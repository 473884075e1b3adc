"""Column expressions: geometry, time, numbers, labels.  No Python runs on executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MPS_TO_KMH = 3.6
METRES_PER_DEGREE = 111_320.0

# WGS-84 and the transverse Mercator zone with central meridian 27 E.
AXIS, FLATTENING, SCALE, FALSE_EAST, MERIDIAN = 6_378_137.0, 1 / 298.257223563, 0.9996, 500_000.0, 27.0
# Names of the compass, and the colours of the ramp.
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
RAMP = [(0.0, (214, 40, 40)), (0.5, (240, 166, 32)), (1.0, (46, 158, 74))]


def lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _series(terms: list[tuple[Column, float]]) -> Column:
    total = F.lit(0.0)
    for value, divisor in terms:
        total = total + value / F.lit(divisor)
    return total


def project_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to (easting, northing) in metres: the classic series for the ellipsoid."""
    e2 = FLATTENING * (2 - FLATTENING)
    second = e2 / (1 - e2)
    phi = F.radians(lat)
    s, c, t = F.sin(phi), F.cos(phi), F.tan(phi)
    normal = F.lit(AXIS) / F.sqrt(F.lit(1.0) - F.lit(e2) * s * s)
    tt, cc = t * t, F.lit(second) * c * c
    a = c * (F.radians(lon) - F.radians(F.lit(MERIDIAN)))
    a2 = a * a
    # arc of the meridian: sine multiples with coefficients in powers of e2
    arc = {
        0: 1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256,
        2: -(3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024),
        4: 15 * e2**2 / 256 + 45 * e2**3 / 1024,
        6: -35 * e2**3 / 3072,
    }
    meridian = F.lit(arc[0]) * phi
    for k in (2, 4, 6):
        meridian = meridian + F.lit(arc[k]) * F.sin(phi * k)
    east = _series([(a, 1.0), ((1 - tt + cc) * a2 * a, 6.0), ((5 - 18 * tt + tt * tt + 72 * cc - 58 * second) * a2 * a2 * a, 120.0)])
    north = _series([(a2, 2.0), ((5 - tt + 9 * cc + 4 * cc * cc) * a2 * a2, 24.0), ((61 - 58 * tt + tt * tt + 600 * cc - 330 * second) * a2 * a2 * a2, 720.0)])
    return F.lit(SCALE) * normal * east + F.lit(FALSE_EAST), F.lit(SCALE) * (F.lit(AXIS) * meridian + normal * t * north)


def cell_of(v: Column, size: float) -> Column:
    """Index of the square along one axis: floor, also below zero."""
    return F.floor(v / F.lit(float(size))).cast("int")


def heading_bin(bearing: Column, bins: int = 8) -> Column:
    """Bins are centred: 0 holds what is nearest to north."""
    width = 360.0 / bins
    return F.pmod(F.floor((F.pmod(bearing.cast("double"), F.lit(360.0)) + width / 2) / width), F.lit(bins)).cast("int")


def local_time(epoch: Column, tz: str) -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds(epoch), tz)


def local_month(epoch: Column, tz: str) -> Column:
    return F.date_format(local_time(epoch, tz), "yyyy-MM")


def local_hour(epoch: Column, tz: str) -> Column:
    return F.hour(local_time(epoch, tz))


def daytype(day: Column) -> Column:
    return F.when(F.weekday(day) < 5, "wd").otherwise("we")


def month_label(month: Column) -> Column:
    return F.date_format(F.to_date(F.concat(month, F.lit("-01"))), "MMMM yyyy")


def trip_suffix(trip_id: Column) -> Column:
    """What follows the last underscore; the whole id without one."""
    return F.substring_index(trip_id, "_", -1)


def is_bus(route_type: Column, short_name: Column) -> Column:
    return (route_type == "3") & ~F.coalesce(short_name, F.lit("")).startswith("Тр")


def in_bbox(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def hist_bin(v: Column, width: float) -> Column:
    return F.floor(v / F.lit(float(width))).cast("int")


def bin_centre(b: Column, width: float) -> Column:
    return (b + 0.5) * F.lit(float(width))


def round_half_even(v: Column, dp: int = 0) -> Column:
    """NumPy's way: scale, round half to even, unscale; NaN becomes null."""
    scale = float(10**dp)
    return F.when(~F.isnan(v), F.rint(v * scale) / scale)


def circular_mean(sum_sin: Column, sum_cos: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(sum_sin, sum_cos)), F.lit(360.0))


def whole_direction(degrees: Column) -> Column:
    return F.pmod(F.rint(degrees).cast("int"), F.lit(360))


def angle_between(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, F.lit(360.0) - d)


def metres_between(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular, scaled at the first point."""
    dx = (lon2 - lon1) * F.cos(F.radians(lat1))
    dy = lat2 - lat1
    return F.sqrt(dx * dx + dy * dy) * F.lit(METRES_PER_DEGREE)


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483)))


def clamp01(v: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - low) / (high - low)))


def ramp_colour(t: Column, stops: list[tuple[float, tuple[int, int, int]]] = RAMP, invert: bool = False) -> Column:
    """'#rrggbb' on a piecewise linear ramp over [0, 1]."""
    t = F.lit(1.0) - t if invert else t
    out = None
    for (a, low), (b, high) in reversed(list(zip(stops, stops[1:], strict=False))):
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (t - a) / (b - a)))
        rgb = [F.rint(F.lit(float(p)) + share * float(q - p)).cast("int") for p, q in zip(low, high, strict=True)]
        colour = F.format_string("#%02x%02x%02x", *rgb)
        out = colour if out is None else F.when(t <= b, colour).otherwise(out)
    return out


def compass_name(degrees: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, COMPASS)), F.pmod(F.floor(degrees / 45.0 + 0.5), F.lit(8)).cast("int") + 1)


def format_value(v: Column, factor: float = 1.0, decimals: int = 0) -> Column:
    return F.format_number(v * factor, decimals)


def duration_text(seconds: Column) -> Column:
    """'45 s', '12 min 05 s', '1 h 05 min'."""
    s = F.floor(seconds + 0.5)
    m = F.floor(s / 60)
    short, middle = F.format_string("%d s", s), F.format_string("%d min %02d s", m, F.pmod(s, F.lit(60)))
    return F.when(s < 60, short).when(m < 60, middle).otherwise(F.format_string("%d h %02d min", F.floor(m / 60), F.pmod(m, F.lit(60))))


def selection_key(month: Column, daytype_: Column, hour: Column) -> Column:
    """'2026-08-wd-07', with 'all' for an axis that is pooled."""
    return F.concat_ws("-", F.coalesce(month, F.lit("all")), F.coalesce(daytype_, F.lit("all")), F.coalesce(F.lpad(hour.cast("string"), 2, "0"), F.lit("all")))


def profile_key(month: Column, daytype_: Column) -> Column:
    """'profile-2026-08-wd'."""
    return F.concat_ws("-", F.lit("profile"), F.coalesce(month, F.lit("all")), F.coalesce(daytype_, F.lit("all")))
