"""Scans of real files, publishing, and the end-to-end jobs."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from hallowgrid.operators import grid
from hallowgrid.plans import refresh
from hallowgrid.plans.catalog import QUERIES
from hallowgrid.schema import RECORD, Config, conform
from hallowgrid.session import shared_dir
from hallowgrid.sources import scan, sinks
from hallowgrid.sources.registry import Registry
from hallowgrid.streaming import wire


@pytest.mark.parametrize("doc", [[{"name": "a", "lat": 1.0}, {"name": "b"}], {"_meta": {"count": 2}, "records": [{"name": "a", "lat": 1.0}, {"name": "b"}]}, {"projects": [{"name": "a", "lat": 1.0}, {"name": "b"}]}])
def test_record_document(spark, tmp_path, doc):
    with gzip.open(tmp_path / "r.json.gz", "wt") as f:
        json.dump(doc, f)
    got = scan.read_record_document(spark, str(tmp_path / "r.json.gz")).orderBy("name").collect()
    assert [(r.name, r.lat) for r in got] == [("a", 1.0), ("b", None)]


def test_csv_overflow(spark, tmp_path):
    wide = ",".join(str(i) for i in range(12))
    (tmp_path / "f.csv").write_text(f'SCH Number,Title\n1,"a, b"\n2,x,y,z\n3\n4,{wide}\n')
    got = {r["SCH Number"]: (r.Title, r._overflow) for r in scan.read_csv_overflow(spark, str(tmp_path / "f.csv"), ["SCH Number", "Title"]).collect()}
    assert got["1"] == ("a, b", None) and got["2"] == ("x", "y z") and got["3"] == (None, None)
    assert got["4"][0] == "0" and "11" in got["4"][1]


def test_feeds(spark, tmp_path):
    (tmp_path / "f.xml").write_text(
        "<rss><channel><item><title>A &amp; B</title><link>http://x/1</link><description>&lt;p&gt;hi&lt;/p&gt;</description><pubDate>Mon, 5 Feb 2024</pubDate></item></channel></rss>"
    )
    got = scan.read_feed_items(spark, str(tmp_path / "f.xml")).collect()
    assert [tuple(r) for r in got] == [("A & B", "http://x/1", "hi", "Mon, 5 Feb 2024")]


def test_geojson_file(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"features":[{"geometry":{"type":"Point","coordinates":[2,48]},"properties":{"name":"x","n":3}},{"geometry":null,"properties":{}}]}')
    got = scan.read_geojson(spark, str(tmp_path / "g.json")).collect()
    assert [(r.lat, r.lng, r.props) for r in got] == [(48.0, 2.0, {"name": "x", "n": "3"})]


def test_parts_skip_corrupt_files(spark, tmp_path):
    for i in range(2):
        with gzip.open(tmp_path / f"part_{i}.json.gz", "wt") as f:
            f.write(json.dumps({"name": f"n{i}", "source": "s"}) + "\n")
    (tmp_path / "part_2.json.gz").write_bytes(b"not gzip at all")
    rows = scan.read_parts(spark, str(tmp_path / "part_*.json.gz"))
    assert sorted(r.name for r in rows.collect()) == ["n0", "n1"]
    assert scan.part_coverage(rows).count() == 2
    listed = scan.part_coverage(rows, str(tmp_path / "part_*.json.gz")).collect()
    assert sum(r.n_rows == 0 and r.bytes > 0 for r in listed) == len(listed) - 2


def test_an_empty_part_is_not_lost(spark, tmp_path):
    with gzip.open(tmp_path / "part_0.json.gz", "wt") as f:
        f.write("")
    (tmp_path / "part_1.json.gz").write_bytes(b"not gzip at all")
    with gzip.open(tmp_path / "part_3.json.gz", "wt") as f:
        f.write('{"name": "n", "source": "s"}')
    glob = str(tmp_path / "part_*")
    listed = scan.part_coverage(scan.read_parts(spark, glob), glob).collect()
    assert {(r.part[-9:-8], r.n_rows, r.lost) for r in listed} == {("0", 0, False), ("1", 0, True), ("3", 1, False)}


def test_parts_of_orders_whose_first_task_has_no_rows(spark, tmp_path):
    """One row group in several splits: the first task writes an empty file, which is no unreadable part (F4)."""
    spark.range(40_000).selectExpr("id AS o_orderkey", "CAST(xxhash64(id) % 3 AS STRING) AS o_orderpriority").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        rows = QUERIES["shard_part_files"](spark, str(tmp_path)).collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert [tuple(r) for r in rows if r.source == "unreadable"] == [(3, "unreadable", 0)] and sum(r.n for r in rows) == 40_000


def _records(spark, n, source="s", lat=10.0):
    rows = spark.range(n).select(
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.lit("holding").alias("kind"), F.lit("watch").alias("posture"), (F.lit(lat) + F.col("id") / 100).alias("lat"),
        F.lit(5.0).alias("lng"), F.lit("exact").alias("geo"), F.lit(source).alias("source"), F.lit(2).alias("impact"), F.lit(0).alias("source_ord"), F.col("id").alias("row_ord"),
    )
    return conform(rows, RECORD)


def test_publish_is_guarded_and_preserves(spark):
    path = shared_dir(spark)
    first = refresh.publish_daily(spark, _records(spark, 20, "a").unionByName(_records(spark, 12, "b", 40.0)), path)
    assert first.written and first.n_rows == 32
    # source b is silent now: its rows stay; a shrinks
    second = refresh.publish_daily(spark, _records(spark, 5, "a"), path)
    assert second.written and second.n_rows == 17
    seen = {r.source: r["count"] for r in sinks.read_published(spark, path).groupBy("source").count().collect()}
    assert seen == {"a": 5, "b": 12}
    empty = sinks.publish_records(_records(spark, 0), path)
    thin = sinks.publish_records(_records(spark, 3), path)
    assert (empty.written, empty.reason, thin.written, thin.reason) == (False, "no rows", False, "thin")
    assert sinks.read_published(spark, path).count() == 17


def test_jobs_store_their_counts_with_the_version(spark):
    path = shared_dir(spark)
    rows = _records(spark, 20, "a").withColumns({"lat": F.when(F.col("row_ord") > 2, F.col("lat")), "kind": F.lit("mass-grave"), "desc": F.when(F.col("row_ord") > 12, F.lit("Cold case"))})
    done = refresh.publish_daily(spark, rows, path)
    assert done.counts == {"read": 20, "unplaced": 3, "tagged": 7, "coarsened": 17}
    stored = spark.read.json(f"{path}/_counts/{done.path.rsplit('/', 1)[-1]}")
    assert {r["name"]: r["n"] for r in stored.collect()} == done.counts
    thin = refresh.federation_merge(spark, rows.limit(2), path)
    assert thin.counts["read"] >= 2


@pytest.mark.parametrize("at", ["_mark", "_drop_staged"])
def test_a_crash_after_the_commit_publishes_nothing_twice(spark, monkeypatch, at):
    base = shared_dir(spark)
    path, checkpoint = f"{base}/out", f"{base}/checkpoint"

    def put(n, source):
        _records(spark, n, source).write.mode("append").parquet(f"{base}/in")
        rows = wire.file_stream(spark, f"{base}/in", RECORD)
        return wire.refresh_available(rows, path, checkpoint)

    assert put(12, "a").counts == {"fresh": 12, "kept": 0}
    versions = spark.read.json(f"{path}/_versions").count()
    with monkeypatch.context() as m:
        real = getattr(wire, at)

        def crash(spark, staging, upto, *rest):
            if upto > 0:
                raise RuntimeError("lost")
            return real(spark, staging, upto, *rest)

        m.setattr(wire, at, crash)
        with pytest.raises(RuntimeError):
            put(5, "b")
    assert sinks.read_published(spark, path).count() == 17
    # the next run finds the commit: nothing to publish, nothing left in staging
    rows = wire.file_stream(spark, f"{base}/in", RECORD)
    assert wire.refresh_available(rows, path, checkpoint) is None
    assert spark.read.json(f"{path}/_versions").count() == versions + 1
    assert spark.read.schema(RECORD).parquet(f"{checkpoint}-staging/rows").count() == 0
    last = put(6, "b")
    assert last.counts == {"fresh": 6, "kept": 12} and sinks.read_published(spark, path).count() == 18


def test_first_publish_refuses_nothing_but_empty(spark):
    path = shared_dir(spark)
    assert not sinks.publish_records(_records(spark, 0), path).written
    assert sinks.read_published(spark, path) is None
    assert sinks.publish_records(_records(spark, 1), path).written


def test_export_round_trip(spark):
    path = shared_dir(spark)
    sinks.export_json_lines(sinks.slim(_records(spark, 7)), path)
    line = json.loads(spark.read.text(path).first()["value"])
    assert "desc" not in line and "row_ord" not in line
    assert scan.read_record_document(spark, path).count() == 7


def test_layer_prunes_partitions(spark):
    e = spark.range(400).select(
        F.lit("node").alias("type"), F.col("id"), (F.col("id") % 140 - 55.5).cast("double").alias("lat"), (F.col("id") * 7 % 360 - 179.5).cast("double").alias("lon"),
        F.lit(None).cast("struct<lat:double,lon:double>").alias("center"), F.create_map(F.lit("landuse"), F.lit("cemetery")).alias("tags"), F.col("id").alias("row_ord"),
    )
    path = shared_dir(spark)
    done = refresh.facility_layer(e, path, Config(tile_threshold=100))
    view = grid.viewport(scan.read_layer(spark, done.path), 0.0, 0.0, 25.0, 25.0)
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell_lat" in plan
    assert view.count() == scan.read_layer(spark, done.path).filter("lat BETWEEN 0 AND 25 AND lng BETWEEN 0 AND 25").count() > 0
    manifest = spark.read.parquet(f"{path}/_manifest")
    assert {r["mode"] for r in manifest.select("mode").distinct().collect()} == {"tiled"}
    # far thinner than before: refused
    assert refresh.facility_layer(e.filter("id < 20"), path).reason == "thin"


def test_delete_stale_tiles(spark, tmp_path):
    for n in ("layer_cemetery_10_20.json.gz", "layer_cemetery_30_40.json.gz", "notes.txt"):
        (tmp_path / n).write_text("x")
    files = spark.createDataFrame([(p.name,) for p in tmp_path.iterdir() if not p.name.startswith(".")], "name string")
    manifest = spark.createDataFrame([("cemetery", "10_20", "tiled")], "ftype string, cell string, mode string")
    stale = sinks.stale_tiles(sinks.tile_listing(files, F.col("name")), manifest)
    assert sinks.delete_files(spark, stale, str(tmp_path)) == 1
    assert not (tmp_path / "layer_cemetery_30_40.json.gz").exists() and (tmp_path / "notes.txt").exists()


def test_registry_isolates_failures(spark):
    reg = Registry()
    reg.register("good", lambda s: _records(s, 3, "good"))
    reg.register("bad", lambda s: (_ for _ in ()).throw(RuntimeError("no such table")))
    reg.register("late", lambda s: _records(s, 2, "late").withColumn("name", F.raise_error(F.lit("boom")).cast("string")))
    records, status = reg.run_isolated(spark)
    assert records.count() == 3
    assert {(r.source, r.ok) for r in status.collect()} == {("good", True), ("bad", False), ("late", False)}
