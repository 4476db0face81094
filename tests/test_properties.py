"""Properties that must hold for any data."""

import random

import pytest
from pyspark.sql import functions as F

from hallowgrid import vocab
from hallowgrid.functions import geo, text
from hallowgrid.operators import dedup, gate, grid, merge, spatial, units
from hallowgrid.session import shared_dir
from hallowgrid.streaming import wire


def _cloud(seed, n, dense):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        c = rnd.random()
        if c < 0.3:
            out.append((rnd.uniform(-90, 90), rnd.uniform(-180, 180)))
        elif c < 0.5:
            out.append((rnd.choice([-1, 1]) * rnd.uniform(89.99, 90), rnd.uniform(-180, 180)))
        elif c < 0.7:
            out.append((rnd.uniform(60, 60.02), (179.99 + rnd.uniform(0, 0.02) + 180) % 360 - 180))
        else:
            out.append((51 + round(rnd.uniform(0, dense), 5), 0.1 + round(rnd.uniform(0, dense), 5)))
    return out


@pytest.mark.parametrize("radius,dense", [(250.0, 0.01), (250.0, 0.002), (2000.0, 0.05), (30.0, 0.001)])
def test_radius_join_equals_brute_force(spark, radius, dense):
    sites, points = _cloud(1, 250, dense), _cloud(2, 250, dense) + [(51.0, 0.1)] * 40
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(sites)], "id int, lat double, lng double")
    right = spark.createDataFrame([(f"n{i:03d}", *p) for i, p in enumerate(points)], "name string, lat double, lng double")
    got = {r.id: (round(r.dist_m, 6), r.near_name) for r in spatial.nearest_within(left, right, radius).collect()}
    want = {}
    for i, a in enumerate(sites):
        near = [(spatial.metres_literal(*a, *b), f"n{j:03d}") for j, b in enumerate(points)]
        near = [x for x in near if x[0] <= radius]
        if near:
            want[i] = (round(min(near)[0], 6), min(near)[1])
    assert got == want and want


def test_radius_join_keeps_copies_of_left_rows(spark):
    left = spark.createDataFrame([(i, 10.0, 10.0) for i in range(100)], "id int, lat double, lng double")
    right = spark.createDataFrame([(f"p{i:04d}", 10.0, 10.001) for i in range(500)], "name string, lat double, lng double")
    got = spatial.nearest_within(left, right, 250.0).collect()
    assert len(got) == 100 and {r.near_name for r in got} == {"p0000"}


def test_gate_is_idempotent_and_never_leaks(spark):
    kinds = list(vocab.KINDS) + ["odd", None]
    d = spark.range(4000).select(
        F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("id") % len(kinds) + 1).cast("int")).alias("kind"),
        (F.rand(1) * 180 - 90).alias("y"), (F.rand(2) * 360 - 180).alias("x"), F.element_at(F.array(*[F.lit(g) for g in ("exact", "area", "admin")]), (F.col("id") % 3 + 1).cast("int")).alias("g"),
    ).persist()
    once = gate.place(d, F.col("y"), F.col("x"), F.col("g"))
    leaked = once.filter(gate.must_coarsen(F.col("kind")) & F.col("geo").isin("exact", "area"))
    assert leaked.count() == 0
    moved = once.filter("geo = 'coarsened'").agg(F.max(F.abs(F.col("lat") - F.col("y"))).alias("a"), F.max(F.abs(F.col("lng") - F.col("x"))).alias("b")).first()
    assert moved.a <= 0.02501 and moved.b <= 0.02501
    again = gate.audit(once)
    assert again.exceptAll(once).count() == 0
    d.unpersist()


def test_audit_reports_repairs(spark):
    from pyspark.sql import Observation

    d = spark.createDataFrame([("mass-grave", 1.234, 5.678, "exact"), ("holding", 1.234, 5.678, "exact")], "kind string, lat double, lng double, geo string")
    seen = Observation("repairs")
    slipped = gate.must_coarsen(F.col("kind")) & F.col("geo").isin("exact", "area")
    got = gate.audit(d.observe(seen, F.count_if(slipped).alias("n"))).collect()
    assert seen.get["n"] == 1 and {r.geo for r in got} == {"coarsened", "exact"}


def test_dedup_is_deterministic_and_skew_safe(spark):
    d = spark.range(5000).select(
        F.lit("Same  name").alias("name"), F.when(F.col("id") < 3000, 1.0005).otherwise(F.col("id") / 1000.0).alias("lat"), F.lit(2.0).alias("lng"),
        F.lit(0).alias("source_ord"), (F.lit(5000) - F.col("id")).alias("row_ord"),
    )
    one = dedup.dedup_records(d).select("lat", "row_ord")
    two = dedup.dedup_records(d.repartition(13)).select("lat", "row_ord")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    # hot keys are reduced before the exchange: the plan has a partial aggregation and no window
    plan = dedup.dedup_records(d)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_first_n_limits_before_the_exchange(spark):
    d = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    out = dedup.first_n(d, ["g"], ["id"], 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and out.count() == 15


def test_shards_cover_exactly_once(spark):
    d = spark.range(1000)
    parts = [merge.shard(d, F.col("id"), k, 7) for k in range(7)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    assert whole.exceptAll(d).count() == 0 and whole.count() == 1000


def test_adaptive_tiles_hold_all_points(spark):
    pts = spark.createDataFrame(_cloud(3, 2000, 0.05), "lat double, lng double")
    tiles = grid.adaptive_tiles(pts, 50, levels=6).collect()
    assert sum(t.n_rows for t in tiles) == 2000
    assert all(t.n_rows <= 50 or t.level == 5 for t in tiles)


def test_polygon_holes_and_multipart(spark):
    def ring(y, x, r):
        return [(y - r, x - r), (y - r, x + r), (y + r, x + r), (y + r, x - r)]

    shapes = spark.createDataFrame([("u", [ring(10.0, 10.0, 5.0), ring(10.0, 10.0, 2.0), ring(30.0, 10.0, 1.0)])], "unit string, rings array<array<struct<lat:double,lng:double>>>")
    pts = spark.createDataFrame([("in", 6.0, 6.0), ("hole", 10.5, 10.5), ("part", 30.2, 9.5), ("out", 20.0, 10.0), ("bbox", 25.0, 14.0)], "p string, lat double, lng double")
    assert sorted(r.p for r in units.within_units(pts, shapes).collect()) == ["in", "part"]


def test_alternation_equals_containment(spark):
    terms = [*vocab.NEWS_ALLOW, "a.b", "c++", "x-y", "(z)"]
    texts = [f"q{t}w" for t in terms] + ["nothing here", "axb", "cc", "burial groun", "mass grav"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in d.select(F.col("t").rlike(text.alternation(terms)).alias("v")).collect()]
    assert got == [any(x in t for x in terms) for t in texts]


def test_factored_pattern_equals_flat(spark):
    flat = r"(?iU)\b(?:" + "|".join(vocab.TOPIC_ALLOW) + r")\b"
    words = "grave graves graveyard graveyards gravesite burial burials burial ground reburial interment tomb tombs tumuli mezar mezarlık makam potter's field potters field cemetery cemeter".split(" ")
    d = spark.createDataFrame([(w,) for w in words] + [("the Burial Ground of",), ("mass  grave",), ("mass grave",), ("ossada!",)], "t string")
    rows = d.select(F.col("t").rlike(flat).alias("a"), F.col("t").rlike(text.whole_words(vocab.TOPIC_ALLOW)).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


@pytest.mark.parametrize("files", [1, 5])
def test_stream_gives_the_batch_answer(spark, files):
    base = shared_dir(spark)
    d = spark.range(300).select(
        (F.col("id") % 40).cast("string").alias("link_key"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("event_ts"), F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("topic")
    )
    for i in range(files):
        d.filter(F.col("link_key").cast("int") % files == i).coalesce(1).write.mode("append").parquet(f"{base}/in")
    s = wire.file_stream(spark, f"{base}/in", d.schema, files_per_batch=1)
    wire.append_available(wire.distinct_links(s, ts="event_ts").select("link_key"), f"{base}/links", f"{base}/c1")
    assert sorted(r.link_key for r in spark.read.parquet(f"{base}/links").collect()) == sorted(str(i) for i in range(40))
    wire.store_counts(s, f"{base}/counts", f"{base}/c2", "topic")
    got = {tuple(r) for r in wire.latest_counts(spark, f"{base}/counts", "topic").collect()}
    want = {tuple(r) for r in d.groupBy(F.to_date("event_ts").alias("day"), "topic").count().collect()}
    assert got == want


def test_distance_formula(value):
    assert value(geo.metres, 10.0, 179.999, 10.0, -179.999) == pytest.approx(spatial.metres_literal(10.0, 179.999, 10.0, -179.999))
