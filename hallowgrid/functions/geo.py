"""Geometry and grid expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .scalar import let

METRES_PER_DEG = 111320.0
MERCATOR_R = 6378137.0

_NUM = r"-?[0-9][0-9.eE+\-]*"
_PAIR = r"\[\s*(" + _NUM + r")\s*,\s*(" + _NUM + ")"


def point(lat: Column, lng: Column) -> Column:
    return F.struct(lat.alias("lat"), lng.alias("lng"))


def geometry_centre(geometry_json: Column) -> Column:
    """Centre of a GeoJSON geometry text: its point, or the plain mean of all vertices.

    Every innermost coordinate array starts with ``[x, y``, at whatever depth, so the
    vertices are found by one scan of the text and no recursion over types is needed.
    """
    coords = F.get_json_object(geometry_json, "$.coordinates")
    xs = F.regexp_extract_all(coords, F.lit(_PAIR), F.lit(1))
    ys = F.regexp_extract_all(coords, F.lit(_PAIR), F.lit(2))
    return F.when(F.size(xs) > 0, point(_mean(ys), _mean(xs)))


def _mean(texts: Column) -> Column:
    total = F.aggregate(texts, F.lit(0.0), lambda acc, t: acc + t.try_cast("double"))
    return total / F.size(texts)


def vertex_mean(vertices: Column) -> Column:
    """Mean of an ``array<struct<lat,lng>>`` without area weighting."""
    n = F.size(vertices)

    def mean(field: str) -> Column:
        return F.aggregate(vertices, F.lit(0.0), lambda acc, v: acc + v[field]) / n

    return F.when(n > 0, point(mean("lat"), mean("lng")))


def usable_point(lat: Column, lng: Column) -> Column:
    """``struct(lat, lng, reprojected)``; metres are converted back from Web Mercator."""
    deg = (F.abs(lat) <= 90) & (F.abs(lng) <= 180)
    back_lng = lng / F.lit(MERCATOR_R) * F.lit(180.0) / F.pi()
    back_lat = (F.lit(2.0) * F.atan(F.exp(lat / F.lit(MERCATOR_R))) - F.pi() / 2) * F.lit(180.0) / F.pi()
    plausible = (F.abs(back_lat) <= 90) & (F.abs(back_lng) <= 180)

    def shaped(a: Column, b: Column, flag: bool) -> Column:
        return F.struct(a.alias("lat"), b.alias("lng"), F.lit(flag).alias("reprojected"))

    return F.when(deg, shaped(lat, lng, False)).when(plausible, shaped(back_lat, back_lng, True))


def floor_quotient(x: Column, step: float) -> Column:
    """Exact floor(x / step) for doubles.

    ``floor(x / step)`` rounds the quotient first and so jumps a cell on multiples of
    an inexact step (1.0 / 0.05 is 20.0, yet 20 * 0.05 exceeds 1.0 in binary); the
    remainder of two doubles is exact, so it is taken out before dividing.
    """
    m = x % F.lit(step)
    return F.rint((x - m) / F.lit(step)) - F.when(m < 0, F.lit(1.0)).otherwise(F.lit(0.0))


def snap(x: Column, step: float = 0.05) -> Column:
    """Centre of the ``step`` degree cell ``x`` lies in, at four decimals."""
    centre = floor_quotient(x, step) * F.lit(step) + F.lit(step / 2.0)
    return F.rint(centre * F.lit(10000.0)) / F.lit(10000.0)


def cell_index(x: Column, deg: float) -> Column:
    return F.floor(x / F.lit(deg)).cast("bigint")


def layer_cell(x: Column, deg: int = 10) -> Column:
    return (F.floor(x / F.lit(deg)) * deg).cast("int")


def layer_cell_key(lat: Column, lng: Column, deg: int = 10) -> Column:
    return F.concat_ws("_", layer_cell(lat, deg), layer_cell(lng, deg))


def lng_gap(lng1: Column, lng2: Column) -> Column:
    """Difference in longitude, the short way round the antimeridian."""
    d = lng2 - lng1
    return F.when(d > 180, d - 360).when(d < -180, d + 360).otherwise(d)


def metres(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Equirectangular distance, good at a few hundred metres."""
    dy = (lat2 - lat1) * F.lit(METRES_PER_DEG)
    dx = lng_gap(lng1, lng2) * F.lit(METRES_PER_DEG) * F.cos(F.radians((lat1 + lat2) / 2.0))
    return F.sqrt(dy * dy + dx * dx)


def wkt_point(c: Column) -> Column:
    """``Point(lng lat)`` to a point, NULL when malformed or out of range."""
    lng = F.regexp_extract(c, vocab.WKT_POINT, 1).try_cast("double")
    lat = F.regexp_extract(c, vocab.WKT_POINT, 2).try_cast("double")
    return F.when((F.abs(lat) <= 90) & (F.abs(lng) <= 180), point(lat, lng))


def _unwrapping(lngs: Column) -> Column:
    """+1: western vertices move east by 360, -1: eastern ones west, 0: none."""
    east = F.size(F.filter(lngs, lambda x: x > 0))
    west = F.size(F.filter(lngs, lambda x: x < 0))
    spans = (F.array_max(lngs) - F.array_min(lngs) > 180) & (east > 0) & (west > 0)
    return F.when(~spans, F.lit(0)).when(east >= west, F.lit(1)).otherwise(F.lit(-1))


def _moved(v: Column, side: Column) -> Column:
    return point(v["lat"], F.when(v["lng"] * side < 0, v["lng"] + side * 360).otherwise(v["lng"]))


def unwrap_antimeridian(vertices: Column) -> Column:
    """Shift the minority side of 180 degrees across, for units that span it.

    ``vertices`` is ``array<struct<lat,lng>>``.  A unit is taken to span the
    antimeridian when its vertices are more than 180 degrees of longitude apart and
    lie on both sides of zero; the side with fewer vertices moves by 360.
    """
    side = _unwrapping(F.transform(vertices, lambda v: v["lng"]))
    return let(side, lambda s: F.transform(vertices, lambda v: _moved(v, s)))


def unwrap_rings(rings: Column) -> Column:
    """The same for all rings of a unit together, parts and holes alike."""
    side = _unwrapping(F.transform(F.flatten(rings), lambda v: v["lng"]))
    return let(side, lambda s: F.transform(rings, lambda ring: F.transform(ring, lambda v: _moved(v, s))))
