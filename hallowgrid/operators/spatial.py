"""Spatial joins written as equi joins on grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import reliable_checkpoint

_SUB = 16  # bins per cell side: a cell of 2 radii gives bins of radius / 8
_LEVELS = 5  # times a crowded bin is split again, by _SPLIT each way
_SPLIT = 4
_CROWD = 32  # distinct points of a bin that are measured one by one
_FEW = 512  # points of a cell, up to which all are measured one by one


def _row(lat: Column, cell: float) -> Column:
    return F.floor(lat / F.lit(cell)).cast("int")


def _columns(row: Column, cell: float) -> Column:
    """Cells on a latitude row: each at least ``cell`` * 1/cos wide, so that a cell is
    never narrower in metres than at the equator.  At least one."""
    outer = F.least(F.greatest(F.abs(row), F.abs(row + 1)) * F.lit(cell), F.lit(90.0))
    return F.greatest(F.floor(F.lit(360.0 / cell) * F.cos(F.radians(outer))), F.lit(1)).cast("int")


def _column(lng: Column, n: Column) -> Column:
    return F.floor((lng + 180.0) / (F.lit(360.0) / n)).cast("int")


def _celled(points: DataFrame, name: str, cell: float) -> DataFrame:
    """Points with their cell (``row``, ``col``) and the number of columns on its row."""
    p = points.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    p = p.select("lat", "lng", F.col(name).alias("near_name"), _row(F.col("lat"), cell).alias("row"))
    p = p.withColumn("__n", _columns(F.col("row"), cell))
    return p.withColumn("col", F.pmod(_column(F.col("lng"), F.col("__n")), F.col("__n")))


def _located(celled: DataFrame, cell: float) -> DataFrame:
    """Distinct points with their cell and the finest bin (``fi``, ``fj``); the lowest name of each."""
    fine = _SUB * _SPLIT**_LEVELS
    p = celled.select(
        "lat",
        "lng",
        "near_name",
        "row",
        "col",
        F.floor(F.col("lat") / F.lit(cell / fine)).alias("fi"),
        F.floor((F.col("lng") + 180.0) / (F.lit(360.0 / fine) / F.col("__n").cast("double"))).alias("fj"),
    )
    return p.groupBy("row", "col", "fi", "fj", "lat", "lng").agg(F.min("near_name").alias("near_name"))


def _bin(level: int) -> list[Column]:
    """Bin of a level, by integer division of the finest, so that bins nest exactly."""
    k = float(_SPLIT ** (_LEVELS - level))
    return [F.floor(F.col(c) / k).alias(b) for c, b in (("fi", "bi"), ("fj", "bj"))]


def _boxes(spots: DataFrame, level: int) -> DataFrame:
    """Bounding box and number of points of every bin of a level, with the bin it is part of (``pi``, ``pj``)."""
    b = spots.select("row", "col", *_bin(level), "lat", "lng").groupBy("row", "col", "bi", "bj")
    b = b.agg(
        F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lng").alias("lng0"), F.max("lng").alias("lng1"), F.count(F.lit(1)).alias("n")
    )
    return b.withColumns({"pi": F.floor(F.col("bi") / float(_SPLIT)), "pj": F.floor(F.col("bj") / float(_SPLIT))})


def _reach(pairs: DataFrame) -> DataFrame:
    """Least and most distance of a site to any point of a box: ``least_m``, ``most_m``."""
    s, t = F.col("slat"), F.col("slng")
    lat0, lat1 = F.col("lat0"), F.col("lat1")
    gaps = pairs.withColumns(
        {
            "__west": geo.lng_gap(t, F.col("lng0")),
            "__east": geo.lng_gap(t, F.col("lng1")),
            "__c0": F.cos(F.radians((s + lat0) / 2.0)),
            "__c1": F.cos(F.radians((s + lat1) / 2.0)),
        }
    )
    west, east, c0, c1 = F.col("__west"), F.col("__east"), F.col("__c0"), F.col("__c1")
    near_y = F.greatest(lat0 - s, s - lat1, F.lit(0.0)) * geo.METRES_PER_DEG
    far_y = F.greatest(F.abs(lat0 - s), F.abs(lat1 - s)) * geo.METRES_PER_DEG
    near_x = (
        F.when((west <= 0) & (east >= 0), F.lit(0.0)).otherwise(F.least(F.abs(west), F.abs(east)))
        * geo.METRES_PER_DEG
        * F.least(c0, c1)
    )
    # The cosine peaks inside the span when the middle latitudes straddle the equator.
    top_cos = F.when((s + lat0) * (s + lat1) <= 0, F.lit(1.0)).otherwise(F.greatest(c0, c1))
    far_x = F.greatest(F.abs(west), F.abs(east)) * geo.METRES_PER_DEG * top_cos
    slack = 1e-9
    least = (F.sqrt(near_y * near_y + near_x * near_x) * (1 - slack)).alias("least_m")
    most = (F.sqrt(far_y * far_y + far_x * far_x) * (1 + slack)).alias("most_m")
    kept = [c for c in pairs.columns if c not in ("lat0", "lat1", "lng0", "lng1", "pi", "pj")]
    return gaps.select(*kept, least, most)


def _open(met: DataFrame, radius_m: float) -> DataFrame:
    """Boxes that can still hold a site's nearest point: none nearer than ``bound`` is known to be full.

    A site meets a bounded number of boxes, so their list is bounded too.
    """
    box = F.struct("least_m", "row", "col", "bi", "bj", "n")
    near = met.filter(F.col("least_m") <= radius_m)
    bounds = near.groupBy("slat", "slng").agg(F.least(F.min("most_m"), F.min("bound")).alias("bound"), F.collect_list(box).alias("boxes"))
    return bounds.select("slat", "slng", "bound", F.inline(F.filter("boxes", lambda b: b["least_m"] <= F.col("bound")))).drop("least_m")


def _reached_cells(sites: DataFrame, radius_m: float, cell: float) -> DataFrame:
    """Every site once per cell within its reach (about four)."""
    rd = radius_m / geo.METRES_PER_DEG * (1 + 1e-9)
    s, t = F.col("slat"), F.col("slng")
    cos = F.cos(F.radians(F.least(F.abs(s) + rd, F.lit(90.0))))
    rl = F.when(cos > 1e-9, F.lit(rd) / cos).otherwise(F.lit(360.0))
    rows = sites.select(
        "slat", "slng", rl.alias("__rl"), F.explode(F.sequence(_row(s - rd, cell), _row(s + rd, cell))).alias("row")
    ).withColumn("__n", _columns(F.col("row"), cell))
    n = F.col("__n")
    span = rows.withColumns({"__lo": _column(t - F.col("__rl"), n), "__hi": _column(t + F.col("__rl"), n)})
    # Near the poles a reach can cover the whole row.
    last = F.least(F.col("__hi"), F.col("__lo") + n - 1)
    each = span.select("slat", "slng", "row", "__n", F.explode(F.sequence(F.col("__lo"), last)).alias("__c"))
    return each.select("slat", "slng", "row", F.pmod(F.col("__c"), n).alias("col"))


def _opened(reached: DataFrame, spots: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of a site and a point that may be its nearest, where cells are crowded.

    Distinct points are summed up as the bounding boxes of bins an eighth of the radius
    wide.  A left location meets a bounded number of boxes; the nearest far corner among
    them bounds its distance, and only boxes nearer than that bound stay open.  Points of
    open boxes are measured if the box holds few; a crowded box is split four by four, and
    the same is done with its parts, up to five times.  So a location meets a bounded
    number of boxes and points however many share its surroundings, and the work grows
    with the number of locations and points.  Open boxes are written to the shared folder,
    which tells whether any is crowded.
    """
    key = ["row", "col", "bi", "bj"]
    met = _reach(reached.join(_boxes(spots, 0), ["row", "col"])).withColumn("bound", F.lit(float("inf")))
    pairs = None
    for level in range(_LEVELS + 1):
        open_boxes = reliable_checkpoint(spots.sparkSession, _open(met, radius_m))
        crowded = F.col("n") > (_CROWD if level < _LEVELS else 1 << 62)
        near = open_boxes.filter(~crowded).select("slat", "slng", *key).join(spots.select(*spots.columns, *_bin(level)), key)
        near = near.select("slat", "slng", "lat", "lng", "near_name")
        pairs = near if pairs is None else pairs.unionByName(near)
        if open_boxes.filter(crowded).isEmpty():
            break
        inner = open_boxes.filter(crowded).select("slat", "slng", "bound", "row", "col", F.col("bi").alias("pi"), F.col("bj").alias("pj"))
        met = _reach(inner.join(_boxes(spots, level + 1), ["row", "col", "pi", "pj"]))
    return pairs


def nearest_within(
    left: DataFrame,
    points: DataFrame,
    radius_m: float = 250.0,
    name: str = "name",
    lat: str = "lat",
    lng: str = "lng",
) -> DataFrame:
    """Left rows with a point within ``radius_m``: adds ``dist_m`` and ``near_name``.

    Ties in distance take the lowest name.  Works at every latitude and across the
    antimeridian.

    Plan.  A left location meets the cells within its reach, about four, by an equi join.
    One count of the points by cell comes first.  If no cell holds more than ``_FEW``, all
    points of a cell are measured: each location meets a bounded number, in one plan that
    stages nothing.  Else see :func:`_opened`.
    """
    spark = left.sparkSession
    cell = 2.0 * radius_m / geo.METRES_PER_DEG
    celled = _celled(points, name, cell)
    sites = (
        left.select(F.col(lat).cast("double").alias("slat"), F.col(lng).cast("double").alias("slng"))
        .filter(F.col("slat").isNotNull() & F.col("slng").isNotNull())
        .distinct()
    )
    reached = _reached_cells(sites, radius_m, cell)
    most = celled.groupBy("row", "col").count().agg(F.max("count")).first()[0]
    if (most or 0) <= _FEW:
        pairs = reached.join(celled.drop("__n"), ["row", "col"])
    else:
        pairs = _opened(reached, reliable_checkpoint(spark, _located(celled, cell)), radius_m)
    s, t = F.col("slat"), F.col("slng")
    far = geo.metres(s, t, F.col("lat"), F.col("lng")).alias("d")
    near = pairs.select("slat", "slng", far, "near_name").filter(F.col("d") <= radius_m)
    nearest = near.groupBy("slat", "slng").agg(F.min(F.struct("d", "near_name")).alias("best"))
    return (
        left.withColumns({"slat": F.col(lat).cast("double"), "slng": F.col(lng).cast("double")})
        .join(nearest, ["slat", "slng"])
        .select(*left.columns, F.col("best.d").alias("dist_m"), F.col("best.near_name").alias("near_name"))
    )


def metres_literal(lat1: float, lng1: float, lat2: float, lng2: float) -> float:
    """Scalar twin of ``geo.metres`` for brute-force checks."""
    d = lng2 - lng1
    d = d - 360 if d > 180 else d + 360 if d < -180 else d
    dy = (lat2 - lat1) * geo.METRES_PER_DEG
    dx = d * geo.METRES_PER_DEG * math.cos(math.radians((lat1 + lat2) / 2.0))
    return math.sqrt(dy * dy + dx * dx)
