import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from hallowgrid.operators import units
from hallowgrid.plans.catalog import ORACLES, joining
from tools.check_oracles import compare

POINTS = "id int, lat double, lng double, row string, edges string, level string"
SHAPES = "unit string, rings array<array<struct<lat:double,lng:double>>>, x0 string, base string"


def star(rnd, y, x, r, n):
    """A ragged ring about a centre."""
    turns = sorted(rnd.random() * 2 * math.pi for _ in range(n))
    return [(y + math.sin(t) * r * (0.4 + 0.6 * rnd.random()), x + math.cos(t) * r * (0.4 + 0.6 * rnd.random())) for t in turns]


def wrapped(ring):
    return [(y, (x + 180) % 360 - 180) for y, x in ring]


def inside(y, x, rings):
    odd = False
    for ring in rings:
        for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def unwrapped(rings):
    xs = [x for r in rings for _, x in r]
    if max(xs) - min(xs) <= 180 or min(xs) >= 0 or max(xs) <= 0:
        return rings
    east = sum(x > 0 for x in xs) >= sum(x < 0 for x in xs)
    return [[(y, x + 360 if east and x < 0 else x - 360 if not east and x > 0 else x) for y, x in r] for r in rings]


def plain(points, shapes):
    out = set()
    for name, rings in shapes:
        rings = unwrapped(rings)
        x0 = min(x for r in rings for _, x in r)
        for k, (y, x) in enumerate(points):
            side = x if x0 <= x < x0 + 360 else x + math.ceil((x0 - x) / 360) * 360
            if inside(y, side, rings):
                out.add((k, name))
    return out


def frames(spark, points, shapes):
    pts = spark.createDataFrame([(k, y, x, "a", "b", "c") for k, (y, x) in enumerate(points)], POINTS)
    return pts, spark.createDataFrame([(n, r, "d", "e") for n, r in shapes], SHAPES)


@pytest.mark.parametrize("edges, crowd", [(48, 20_000), (4, 30), (1, 5)])
def test_cells_agree_with_brute_force(spark, monkeypatch, edges, crowd):
    monkeypatch.setattr(units, "_EDGES", edges)
    monkeypatch.setattr(units, "_CROWD", crowd)
    rnd = random.Random(edges)
    shapes = [(f"s{k}", [star(rnd, rnd.uniform(-60, 60), rnd.uniform(-160, 160), r, n)]) for k, (r, n) in enumerate([(9, 200), (0.5, 300), (0.02, 100), (25, 40), (3, 5)])]
    big = star(rnd, 10.3, 20.7, 6, 150)
    shapes += [("holes", [big, star(rnd, 10.3, 20.7, 1.5, 60), star(rnd, 10.3, 20.7, 0.3, 20), star(rnd, 40, 20, 2, 9)])]
    shapes += [("across", [wrapped(star(rnd, -20, 179.2, 4, 90)), wrapped(star(rnd, -20, 179.2, 1, 30))]), ("square", [[(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)]])]
    points = []
    for _, rings in shapes:
        r = unwrapped(rings)[0]
        (y0, y1), (x0, x1) = ((min(v), max(v)) for v in zip(*r))
        points += [(rnd.uniform(y0 - 0.1, y1 + 0.1), (rnd.uniform(x0 - 0.1, x1 + 0.1) + 180) % 360 - 180) for _ in range(150)]
        points += [(y, (x + 180) % 360 - 180) for y, x in ((y + rnd.gauss(0, 1e-3), x + rnd.gauss(0, 1e-3)) for y, x in r[:20])]
    points += [(2.0 + rnd.random() / 50, 2.0 + rnd.random() / 50) for _ in range(200)]
    pts, shaped = frames(spark, points, shapes)
    got = units.within_units(pts, shaped)
    assert got.columns == [*pts.columns, "unit", "x0", "base"]
    rows = [(r.id, r.unit) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(points, shapes)
    assert units.within_units(pts, shaped.limit(0)).count() == units.within_units(pts.limit(0), shaped).count() == 0


def test_points_without_place_are_nowhere(spark):
    _, shaped = frames(spark, [], [("square", [[(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)]])])
    pts = spark.createDataFrame([(1, None, 2.0), (2, 2.0, None), (3, 2.0, 2.0), (3, 2.0, 2.0)], "id int, lat double, lng double")
    assert [r.id for r in units.within_units(pts, shaped).collect()] == [3, 3]


def test_a_detailed_border_and_a_crowd_are_spread(spark):
    """One degree with a border of 20,000 edges and 200,000 points: many cells, few edges and points in each."""
    n = 20_000
    ring = [(40.5 + math.sin(t) * (0.3 + 0.02 * math.sin(50 * t)), 10.5 + math.cos(t) * (0.3 + 0.02 * math.sin(50 * t))) for t in (2 * math.pi * k / n for k in range(n))]
    _, shaped = frames(spark, [], [("coast", [ring])])
    pts = spark.range(200_000).select((40 + F.rand(1)).alias("lat"), (10 + F.rand(2)).alias("lng"))
    cells = units.unit_cells(shaped, points=pts).select("level", "row", "ucol", F.size("edges").alias("n")).collect()
    assert len(cells) > 500 and max(c.n for c in cells) <= 200 and sum(c.n == 0 for c in cells) > 20
    share = units.within_units(pts, shaped).count() / 200_000
    assert abs(share - math.pi * 0.09) < 0.01


def test_a_border_is_not_within_its_ring(spark):
    """Outer borders are outside, borders of holes inside, lines where parts meet inside but for their ends."""
    square = lambda y, x, a, b: [(y - a, x - b), (y - a, x + b), (y + a, x + b), (y + a, x - b)]
    shapes = [("hole", [square(4.5, 4.5, 3.25, 3.25), square(4.5, 4.5, 1.25, 1.25)]), ("back", [square(4.5, 4.5, 3.25, 3.25)[::-1], square(4.5, 4.5, 1.25, 1.25)])]
    shapes += [("parts", [[(-2.0, 178.0), (2.0, 178.0), (2.0, 180.0), (-2.0, 180.0)], [(-2.0, 180.0), (2.0, 180.0), (2.0, -179.0), (-2.0, -179.0)]])]
    shapes += [("notch", [[(20.0, 20.0), (20.0, 24.0), (24.0, 24.0), (21.0, 22.0), (24.0, 20.0)]])]
    both = {"hole", "back"}
    want = {(1.25, 4.5): set(), (7.75, 4.5): set(), (4.5, 1.25): set(), (4.5, 7.75): set(), (1.25, 1.25): set(), (7.75, 7.75): set(), (1.25, 7.75): set(), (7.75, 1.25): set()}
    want |= {(3.25, 4.5): both, (5.75, 4.5): both, (4.5, 3.25): both, (4.5, 5.75): both, (3.25, 3.25): both, (5.75, 5.75): both, (3.25, 5.75): both, (5.75, 3.25): both}
    want |= {(4.5, 4.5): set(), (2.0, 2.0): both, (0.0, 180.0): {"parts"}, (0.5, -180.0): {"parts"}, (2.0, 180.0): set(), (-2.0, -180.0): set(), (0.0, 178.0): set(), (1.0, -179.0): set()}
    want |= {(21.0, 22.0): set(), (22.5, 23.0): set(), (20.0, 22.0): set(), (20.5, 22.0): {"notch"}, (24.0, 22.0): set()}
    near = {(y + d, x - d): v for (y, x), v in want.items() if abs(x) < 179 for d in (3e-15, -3e-15)}  # as far as sums round
    points = list(want) + list(near)
    pts, shaped = frames(spark, points, shapes)
    found = {k: set() for k in range(len(points))}
    for r in units.within_units(pts, shaped).collect():
        found[r.id].add(r.unit)
    assert {points[k]: v for k, v in found.items() if v != (want | near)[points[k]]} == {}


@pytest.mark.parametrize("name", ["points_in_units", "child_units", "units_across_180"])
def test_unit_queries_on_borders_and_at_180_agree_with_sql(spark, tmp_path, name):
    """Customers on the borders of a supplier's square, and beyond 180 degrees from it (F2, F3, F5)."""
    lat, lng = (lambda k: k * 7919 % 14400 / 100 - 60), (lambda k: k * 104729 % 36000 / 100 - 180)
    far = lambda k: (lng(k) + 180) / 30 + (174 if lng(k) < 0 else -186)
    suppliers = [k for k in range(1, 3000) if abs(lng(k)) > 179][:6] + list(range(1, 40))
    squares = [(math.floor(lat(s)) + 0.5, math.floor(lng(s)) + 0.5) for s in suppliers]
    customers = set(range(1, 300))
    for k in range(1, 72_000):
        edge = any(max(abs(lat(k) + o - y), abs(lng(k) + o - x)) in (6.25, 2.25) for y, x in squares for o in (0, 0.25))
        beyond = abs(lng(k)) > 178 and any(abs(lat(k) - y) < 6 and abs(x) > 178 for y, x in squares[:6])
        seam = abs(far(k)) in (180, 177.25, 178.25) or any(abs(lat(k) - y) == 4.25 for y, _ in squares[:2])
        if edge or beyond or (seam and k % 5 == 0):
            customers.add(k)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE supplier AS SELECT k AS s_suppkey, 'S' || k AS s_name FROM (SELECT unnest({suppliers})::BIGINT AS k)")
    con.execute(f"CREATE TABLE customer AS SELECT unnest({sorted(customers)})::BIGINT AS c_custkey")
    for t in ("supplier", "customer"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    state, n, _, _, why = compare(spark, con, name, str(tmp_path))
    assert state == "ok" and n > 40, f"{state}: {why}"


@pytest.mark.parametrize("edges, bundle", [(48, 4_096), (4, 20), (1, 2)])
def test_totals_agree_with_brute_force(spark, monkeypatch, edges, bundle):
    """Units with holes, in parts, over 180 degrees and given twice; points on borders, of one place and without a place (F1)."""
    monkeypatch.setattr(units, "_EDGES", edges)
    monkeypatch.setattr(units, "_BUNDLE", bundle)
    rnd = random.Random(bundle)
    shapes = [(f"s{k}", [star(rnd, rnd.uniform(-60, 60), rnd.uniform(-160, 160), r, n)]) for k, (r, n) in enumerate([(9, 200), (0.5, 300), (0.02, 100), (25, 40), (3, 5)])]
    shapes += [("holes", [star(rnd, 10.3, 20.7, 6, 150), star(rnd, 10.3, 20.7, 1.5, 60), star(rnd, 40, 20, 2, 9)])]
    shapes += [("across", [wrapped(star(rnd, -20, 179.2, 4, 90)), wrapped(star(rnd, -20, 179.2, 1, 30))]), ("far", [[(80.0, 1.0), (80.0, 2.0), (81.0, 2.0)]])]
    shapes += [("ring", [[(y + a, x + b) for a, b in ((-r, -r), (-r, r), (r, r), (r, -r))] for y, x, r in ((40.5, 100.5, 3.25), (40.5, 100.5, 1.25))])]
    points = []
    for _, rings in shapes[:-2]:
        r = unwrapped(rings)[0]
        (y0, y1), (x0, x1) = ((min(v), max(v)) for v in zip(*r))
        points += [(rnd.uniform(y0 - 0.1, y1 + 0.1), (rnd.uniform(x0 - 0.1, x1 + 0.1) + 180) % 360 - 180) for _ in range(150)]
        points += [(y, (x + 180) % 360 - 180) for y, x in ((y + rnd.gauss(0, 1e-3), x + rnd.gauss(0, 1e-3)) for y, x in r[:20])]
    points += [(2.0 + rnd.random() / 50, 2.0 + rnd.random() / 50) for _ in range(200)]
    inner = [(40.5 + a, 100.5 + b) for a in (-2.0, 0.0, 2.0) for b in (-2.25, 2.0)] + [(39.25, 100.5), (41.75, 101.75)]  # in "ring", two on its hole
    want = {}
    for k, unit in plain(points, shapes) | {(len(points) + k, "ring") for k in range(len(inner))}:
        want.setdefault(unit, []).append(k)
    places = points + inner + [(37.25, 100.5), (40.5, 103.75), (40.5, 100.5)]  # on the border of "ring" and in its hole
    pts, shaped = frames(spark, places, shapes)
    nowhere = spark.createDataFrame([(1, None, 2.0, "a", "b", "c"), (2, 2.0, None, "a", "b", "c")], POINTS)
    totals = {"n": F.lit(1), "ids": F.col("id"), "none": F.lit(None).cast("double")}
    got = units.within_units(pts.unionByName(pts).unionByName(nowhere), shaped.unionByName(shaped.filter("unit = 's0'")), totals=totals)
    assert got.columns == ["unit", "x0", "base", "n", "ids", "none"]
    twice = lambda u: 4 if u == "s0" else 2
    assert {r.unit: (r.n, r.ids, r.none) for r in got.collect()} == {u: (len(v) * twice(u), sum(v) * twice(u), None) for u, v in want.items()}
    assert units.within_units(pts, shaped.limit(0), totals=totals).count() == units.within_units(pts.limit(0), shaped, totals=totals).count() == 0


def joined(plan):
    """Rows that the joins of a plan that ran gave out."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return joined(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return joined(plan.plan())
    kids = plan.children()
    rows = [n for k in range(kids.size()) for n in joined(kids.apply(k))]
    return rows + ([plan.metrics().get("numOutputRows").get().value()] if "Join" in plan.nodeName() else [])


def test_units_across_180_takes_totals_of_cells(spark, tmp_path):
    """No join pairs the customers with the units they are in, whose number grows with the product of both (F1)."""
    con = duckdb.connect()
    con.execute("CREATE TABLE supplier AS SELECT k AS s_suppkey, 'S' || k % 250 AS s_name FROM range(300) r(k)")
    con.execute("CREATE TABLE customer AS SELECT k AS c_custkey FROM range(30000) r(k) UNION ALL SELECT NULL")
    for t in ("supplier", "customer"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet'")
    df = joining.units_across_180(spark, str(tmp_path))
    got = {(r.what, r.unit): (r.n, r["keys"]) for r in df.collect()}
    want = {r[:2]: r[2:] for r in con.execute(ORACLES["units_across_180"]).fetchall()}
    assert got == want and len(got) == 500
    rows = joined(df._jdf.queryExecution().executedPlan())
    assert len(rows) >= 4 and max(rows) < sum(n for n, _ in want.values()) / 8
