"""Plans of queries that once scanned twice or joined everything to everything."""

import pytest
from pyspark.sql import functions as F

from hallowgrid import vocab
from hallowgrid.functions import text
from hallowgrid.operators import gate, ordering, service, spatial
from hallowgrid.operators.counters import Counters
from hallowgrid.plans.catalog import QUERIES
from hallowgrid.plans.catalog.records import facility_elements
from hallowgrid.sources import normalise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["source_yields", "busiest_countries", "sharded_orders"])
def test_one_scan_and_no_cross_join(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in p and "NestedLoop" not in p
    assert p.count("FileScan") == 1


def test_one_pass_of_the_matcher_for_all_names(spark):
    names = [s[1] for s in vocab.STATES]
    p = plan(spark.range(3).select(text.only_place(F.col("id").cast("string"), names).alias("v")))
    assert p.lower().count("regexp_extract_all") == 1 and "RLIKE" not in p


def test_global_items_are_not_joined_to_units(spark):
    units = spark.createDataFrame([(f"A/{i}",) for i in range(50)], "path string")
    items = spark.createDataFrame([("x", "GLOBAL", None), ("m", "A/3", True), ("y", "A", False)], "title string, serves string, located boolean")
    local = service.attach_by_area(units, items).collect()
    assert len(local) == 51 and {(r.title, r.relation) for r in local} == {("m", "located here"), ("y", "serves")}
    assert [tuple(r) for r in service.global_shelf(items).collect()] == [("x", "serves")]


def test_items_meet_distinct_paths_not_units(spark):
    """Totals equal those of all pairs of units and items, and pairs are made once for each path (F1)."""
    units = spark.range(600).select("id", F.concat(F.lit("A/"), (F.col("id") % 3).cast("string")).alias("path"))
    items = spark.range(40).select(F.col("id").alias("item"), F.array(F.lit("A"), F.concat(F.lit("A/"), (F.col("id") % 4).cast("string"))).alias("serves"), (F.col("id") % 2 == 0).alias("located"))
    made, _ = service._own_items(units, items, "path", "serves")
    assert made.count() == 3 * 40 and service.attach_by_area(units, items).count() == 600 * 40
    by, totals = ["rank", "relation"], [F.count(F.lit(1)).alias("n"), F.sum("item").alias("items")]
    want = service.attach_by_area(units, items).groupBy("id", *by).agg(*totals)
    got = service.totals_by_area(units, items, by, totals).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("name", ["scan_geojson", "normalise_permits"])
def test_text_work_is_spread_though_one_split_holds_all_rows(spark, sf, name):
    """A file of one row group does not keep the work behind it in one task (F6, F8)."""
    tasks = QUERIES[name](spark, sf).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) <= sum(r["count"] for r in tasks) / 2


def test_positions_over_many_ranges(spark):
    d = spark.range(5000).select(F.xxhash64("id").alias("date"), (F.col("id") % 3).alias("sig"), F.col("id").alias("row_ord")).repartition(7)
    rows = ordering.numbered(d, ordering.newest_order()).collect()
    want = sorted(((-r.date, -r.sig, r.row_ord) for r in rows))
    assert [r.row_ord for r in sorted(rows, key=lambda r: r.pos)] == [w[2] for w in want]
    assert sorted(r.pos for r in rows) == list(range(1, 5001))


def test_crowded_bin_equals_brute_force(spark):
    import random

    rnd = random.Random(2)
    spot = lambda: (50.00005 + rnd.random() * 0.0002, 10.00005 + rnd.random() * 0.0002)
    sites = [(i, *spot()) for i in range(150)]
    points = [(f"p{i}", *spot()) for i in range(600)]
    got = spatial.nearest_within(
        spark.createDataFrame(sites, "k long, lat double, lng double"), spark.createDataFrame(points, "name string, lat double, lng double")
    ).collect()
    best = {k: min((spatial.metres_literal(y, x, b, c), n) for n, b, c in points) for k, y, x in sites}
    assert {r.k: (pytest.approx(r.dist_m), r.near_name) for r in got} == {k: v for k, v in best.items()}


def test_counted_texts_are_searched_once(spark, sf):
    """Counting tagged cases and refused sites does not search the texts and tags again (F7)."""
    d = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in ("name", "desc", "kind", "posture")])
    p = plan(gate.label_individual_cases(d, metric=Counters().part()))
    assert p.count(vocab.SINGLE_CASE[0]) == 1
    p = plan(normalise.facilities(facility_elements(spark, sf), Counters().part()))
    assert p.count("exists(") == 1


def test_plain_tags_are_not_rewritten(spark):
    """Tags whose keys are in lower case are judged as they stand, others as before (F7)."""
    rows = [
        ("map('amenity', 'Mortuary', 'name', cast(null AS string))", "mortuary", False), ("map('Amenity', 'museum', 'amenity', 'mortuary')", "mortuary", False),
        ("map('amenity', 'mortuary', 'Amenity', 'bench')", None, False), ("map('amenity', 'mortuary', 'HISTORIC', 'yes')", "mortuary", True),
        ("map('tourism', 'museum', 'x:was:y', 'z')", "museum", False), ("map('tourism', 'museum', 'Disused:shop', 'z')", "museum", True),
        ("map('tourism', 'museum', 'Ruins', 'Tomb')", "museum", True), ("map('tourism', 'museum', 'historic', cast(null AS string))", "museum", False),
        ("map('tourism', 'museum', 'hist', 'a', 'oric', 'b')", "museum", False), ("cast(null AS map<string,string>)", None, False),
    ]
    for tags, ftype, refused in rows:
        d = spark.range(1).select(F.expr(tags).alias("t")).withColumn("f", text.facility_type(F.col("t")))
        assert tuple(d.select("f", text.refused_site(F.col("t"), F.col("f"))).first()) == (ftype, refused), tags


def test_many_terms_are_found_at_any_head(spark):
    """More terms than substring scans serve: the first characters only tell where a term may begin (F7)."""
    terms = [*vocab.NEWS_ALLOW, "]a", "^b", "-c", "&&d", "\\\\e", "[f", " g", "\u00e9h", "\u6c34", "\U0001f480x"]
    texts = [f"q{t}w" for t in terms] + ["nothing here", "]b", "&d", "\U0001f480y"]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in d.select(text.contains_any(F.col("t"), terms).alias("v")).collect()]
    assert got == [any(x in t for x in terms) for t in texts]
