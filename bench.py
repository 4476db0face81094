"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hallowgrid.functions import scalar, text  # noqa: E402
from hallowgrid.operators import aggregates, grid, spatial  # noqa: E402
from hallowgrid.plans.catalog import QUERIES  # noqa: E402
from hallowgrid.plans.catalog.base import documents, table  # noqa: E402
from hallowgrid.session import build_session, spread  # noqa: E402


def fine_point(key):
    """Stand-in coordinates on a 1e-4 degree lattice (11 m)."""
    return (
        (F.pmod(key * 7919, F.lit(1440000)).cast("double") / 10000 - 60).alias("lat"),
        (F.pmod(key * 104729, F.lit(3600000)).cast("double") / 10000 - 180).alias("lng"),
    )


def line_points(spark, sf):
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    lines = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber")
    return lines.select(F.lpad(key.cast("string"), 12, "0").alias("name"), *fine_point(key))


def radius_join(spark, sf):
    """Baseline: 200,000 points x 20,000 projects at 250 m.  Here 600,000 x 20,000 at sf0.1."""
    projects = table(spark, sf, "part").select("p_partkey", *fine_point(F.col("p_partkey")))
    return spatial.nearest_within(projects, line_points(spark, sf), 250.0)


def radius_join_published(spark, sf):
    """The baseline's own size: at most 200,000 points and 20,000 projects at 250 m."""
    projects = table(spark, sf, "part").select("p_partkey", *fine_point(F.col("p_partkey")))
    return spatial.nearest_within(projects, line_points(spark, sf).limit(200_000), 250.0)


def radius_join_one_bin(spark, sf):
    """All projects and as many distinct points inside 20 metres."""
    k = F.col("p_partkey")

    def spot(seed):
        part = lambda s: F.pmod(F.xxhash64(k, F.lit(s)), F.lit(1_000_003)) / 1_000_003 * 0.0002
        return (F.lit(50.00005) + part(seed)).alias("lat"), (F.lit(10.00005) + part(seed + 1)).alias("lng")

    d = table(spark, sf, "part")
    return spatial.nearest_within(d.select(k, *spot(1)), d.select(k.cast("string").alias("name"), *spot(3)), 250.0)


def radius_join_dense(spark, sf):
    """A third of all points and projects inside one square kilometre."""
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")

    def hot(k, name):
        y, x = fine_point(k)
        dense = k % 3 == 0
        return (
            F.when(dense, 51 + F.pmod(k * 7919, F.lit(1000)) / 100000).otherwise(y).alias("lat"),
            F.when(dense, F.pmod(k * 104729, F.lit(1000)) / 100000).otherwise(x).alias("lng"),
        )

    lines = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber")
    points = lines.select(F.lpad(key.cast("string"), 12, "0").alias("name"), *hot(key, "l"))
    projects = table(spark, sf, "part").select("p_partkey", *hot(F.col("p_partkey"), "p"))
    return spatial.nearest_within(projects, points, 250.0)


def tile_layer(spark, sf):
    """Baseline: simulated 590,000 rows in 10-degree cells."""
    rows = grid.with_layer_cell(line_points(spark, sf)).withColumn("ftype", F.lit("cemetery"))
    return aggregates.layer_manifest(rows)


def topic_filter_default(spark, sf):
    docs = documents(spark, sf)
    return docs.groupBy("lang").agg(F.count_if(text.on_topic(F.col("text"))).alias("n"))


def news_classifiers(spark, sf):
    d = documents(spark, sf).select(scalar.fold(F.col("text")).alias("t"))
    t = F.col("t")
    return d.groupBy(text.topic(t).alias("topic"), text.news_allowed(t).alias("ok"), text.significance(t).alias("sig")).count()


BENCH = {
    "radius_join": radius_join,
    "radius_join_published": radius_join_published,
    "radius_join_one_bin": radius_join_one_bin,
    "radius_join_dense": radius_join_dense,
    "tile_layer": tile_layer,
    "topic_filter_default": topic_filter_default,
    "news_classifiers": news_classifiers,
    **{
        n: QUERIES[n]
        for n in (
            "placed_and_deduplicated", "dedup_records", "placement_gate", "points_in_units", "geo_tagged_documents", "fold_texts", "clean_pages",
            "scan_html_rows", "normalise_facilities", "normalise_notices", "adaptive_tiles", "dedup_facilities", "preserved_sources",
            "returned_rollup", "record_breakdown", "stream_daily_counts",
        )
    },
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()
    times = {}
    for name, fn in BENCH.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(3):
            t = time.time()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            took = time.time() - t
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
