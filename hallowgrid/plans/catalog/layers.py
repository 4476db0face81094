"""Queries over the grid, tiling, refresh state, publishing and viewport reads.

Queries that write do so in a fresh folder under the shared checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import grid
from ...schema import RECORD, Config, conform
from ...session import shared_dir, small_table
from ...sources import scan, sinks
from .. import refresh
from .base import COARSE_KINDS, KIND_NAMES, Q_PLACED, lat, lng, pick, q_in, q_lat, q_lng, q_pick, query, table
from .records import Q_FACILITIES, facility_elements, normalise, placed_records

lit = F.lit


@query(
    "G1, G2, FN15",
    f"""WITH b AS (SELECT i * 144 + j AS ord, -60 + i * 2.5 AS s, -180 + j * 2.5 AS w FROM range(58) a(i), range(144) b(j)),
        q AS (SELECT ord, 0 AS q, s, w, least(s + 2.5, 84) AS n, w + 2.5 AS e FROM b),
        c AS (SELECT CAST(floor(({q_lat("o_orderkey")} + 60) / 2.5) AS BIGINT) * 144 + CAST(floor(({q_lng("o_orderkey")} + 180) / 2.5) AS BIGINT) AS ord, count(*) AS points FROM orders GROUP BY 1)
        SELECT ord, CAST(s AS DOUBLE) AS s, CAST(w AS DOUBLE) AS w, CAST(n AS DOUBLE) AS n, CAST(e AS DOUBLE) AS e, CAST(round((s + n) / 2, 4) AS DOUBLE) AS mid, coalesce(points, 0) AS points FROM q LEFT JOIN c USING (ord)""",
)
def world_grid(spark, sf):
    tiles = grid.world_tiles(spark)
    mids = grid.quarters(tiles).filter("q = 3").select("ord", F.col("s").alias("mid"))
    k = F.col("o_orderkey")
    ord_ = F.floor((lat(k) + 60) / 2.5) * 144 + F.floor((lng(k) + 180) / 2.5)
    n = table(spark, sf, "orders").groupBy(ord_.alias("ord")).agg(F.count(lit(1)).alias("points"))
    return tiles.join(mids, "ord").join(n, "ord", "left").select("ord", "s", "w", "n", "e", F.round("mid", 4).alias("mid"), F.coalesce("points", lit(0)).alias("points"))


def _adaptive_sql(threshold: int, levels: int, top: float) -> str:
    fine = top / (1 << (levels - 1))
    parts = " UNION ALL ".join(
        f"SELECT i, j, n, {lv} AS level, CAST(floor(i / {1 << (levels - 1 - lv)}.0::DOUBLE) AS BIGINT) AS ti, CAST(floor(j / {1 << (levels - 1 - lv)}.0::DOUBLE) AS BIGINT) AS tj FROM base" for lv in range(levels)
    )
    return f"""WITH base AS (SELECT CAST(floor({q_lat("o_custkey")} / {fine}) AS BIGINT) AS i, CAST(floor({q_lng("o_custkey")} / {fine}) AS BIGINT) AS j, count(*) AS n FROM orders GROUP BY 1, 2),
        l AS ({parts}), s AS (SELECT level, ti, tj, CAST(sum(n) AS BIGINT) AS n_rows FROM l GROUP BY 1, 2, 3),
        f AS (SELECT l.i, l.j, min(l.level) AS level FROM l JOIN s USING (level, ti, tj) WHERE n_rows <= {threshold} OR level = {levels - 1} GROUP BY 1, 2)
        SELECT DISTINCT s.* FROM f JOIN l USING (i, j, level) JOIN s USING (level, ti, tj)"""


@query("G3", _adaptive_sql(40, 5, 10.0))
def adaptive_tiles(spark, sf):
    c = F.col("o_custkey")
    pts = table(spark, sf, "orders").select(lat(c).alias("lat"), lng(c).alias("lng"))
    return grid.adaptive_tiles(pts, 40)


def _tile_state(spark, sf):
    """Supplier rows as refresh state; customers as tiles."""
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        k.cast("string").alias("tile_key"), F.when(k % 2 == 0, "done").otherwise("empty").alias("state"),
        F.when(k % 5 > 0, F.timestamp_seconds(lit(1_700_000_000) - F.when(k % 3 == 0, 86400 * 20).otherwise(86400))).alias("ts"), k.alias("k"),
    )


@query(
    "G5, J7",
    """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier WHERE (s_suppkey % 2 = 0 AND (s_suppkey % 5 = 0 OR s_suppkey % 3 > 0)) OR (s_suppkey % 2 = 1 AND s_suppkey % 8 <> 3))""",
)
def tiles_to_refresh(spark, sf):
    tiles = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("tile_key"))
    out = grid.cells_to_refresh(
        tiles, _tile_state(spark, sf), rotation=3, now=F.timestamp_seconds(lit(1_700_000_000)), slot=F.pmod(F.col("tile_key").cast("int"), lit(8))
    )
    return out.select("c_custkey")


@query(
    "G6, U5",
    """WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS k, s_suppkey % 2 = 0 AS done FROM supplier), r AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_custkey % 4 = 0 AS nothing, c_custkey % 7 > 0 AS ok FROM customer)
       SELECT 'banked' AS run, k AS tile_key, 'empty' AS state FROM s WHERE NOT done AND k NOT IN (SELECT k FROM r WHERE ok) UNION ALL SELECT 'banked', k, 'empty' FROM r WHERE ok AND nothing
       UNION ALL SELECT 'banked', k, 'done' FROM (SELECT k FROM s WHERE done UNION SELECT k FROM r)
       UNION ALL SELECT 'complete', k, 'empty' FROM s WHERE NOT done AND k NOT IN (SELECT k FROM r WHERE ok) UNION ALL SELECT 'complete', k, 'empty' FROM r WHERE ok AND nothing""",
)
def refresh_state(spark, sf):
    c = F.col("c_custkey")
    results = table(spark, sf, "customer").select(
        c.cast("string").alias("tile_key"), F.when(c % 4 == 0, 0).otherwise(5).alias("n_rows"), (c % 7 > 0).alias("ok")
    )
    state = _tile_state(spark, sf).drop("k")
    runs = [grid.next_state(state, results, done).select(lit(n).alias("run"), "tile_key", "state") for n, done in (("banked", False), ("complete", True))]
    return runs[0].unionByName(runs[1])


# --- publishing ---------------------------------------------------------------------------
@query(
    "K1, K2, K3, SC12, FN24",
    f"""WITH {Q_PLACED}, kept AS (SELECT * FROM placed WHERE lat IS NOT NULL)
        SELECT step, written, reason, n_rows, prior_rows FROM (VALUES
          (1, true, 'ok', (SELECT count(*) FROM kept), 0), (2, false, 'no rows', 0, (SELECT count(*) FROM kept)),
          (3, false, 'thin', (SELECT count(*) FROM kept WHERE row_ord < 3), (SELECT count(*) FROM kept)),
          (4, true, 'ok', (SELECT count(*) FROM kept WHERE source <> '5-LOW'), (SELECT count(*) FROM kept)),
          (5, false, 'thin', (SELECT count(*) FROM kept WHERE source = '5-LOW'), (SELECT count(*) FROM kept WHERE source <> '5-LOW')),
          (6, true, 'visible', (SELECT count(*) FROM kept WHERE source <> '5-LOW'), (SELECT count(*) FROM kept WHERE source <> '5-LOW'))) AS v(step, written, reason, n_rows, prior_rows)""",
)
def publish_guards(spark, sf):
    from ...operators import gate

    path = shared_dir(spark)
    d = gate.only_placed(placed_records(spark, sf)).drop("raw_lat", "raw_lng", "geo_level")
    runs = [
        sinks.publish_records(d, path),
        sinks.publish_records(d.filter("row_ord < 0"), path),
        sinks.publish_records(d.filter("row_ord < 3"), path),
        sinks.publish_records(d.filter("source <> '5-LOW'"), path),
        sinks.guarded_publish(d.filter("source = '5-LOW'"), path, min_ratio=0.6),
    ]
    log = small_table(
        spark,
        [(i, r.written, r.reason, r.n_rows, r.prior_rows) for i, r in enumerate(runs, 1)], "step int, written boolean, reason string, n_rows bigint, prior_rows bigint"
    )
    # What readers see now, from the published files and from their metadata row.
    seen = sinks.read_published(spark, path).agg(F.count(lit(1)).alias("n_rows"))
    meta = spark.read.parquet(f"{path}/_meta/{runs[3].path.rsplit('/', 1)[-1]}").select(F.col("count").alias("prior_rows"))
    last = seen.withColumn("one", lit(1)).join(meta.withColumn("one", lit(1)), "one").select(
        lit(6).alias("step"), lit(True).alias("written"), lit("visible").alias("reason"), "n_rows", "prior_rows"
    )
    return log.unionByName(last)


_CASES = ["Cold case reopened", "Missing person near a mass grave", "Survey"]


@query(
    "A8, GA2, GA3",
    f"""WITH o AS (SELECT o_orderkey, {q_pick(KIND_NAMES, "o_custkey")} AS k, {q_pick(["exact", "area", "admin"], "o_orderkey")} AS g, o_orderkey % 11 > 0 AS placed,
            {q_pick(_CASES, "o_orderkey")} = 'Cold case reopened' AS single FROM orders),
        d AS (SELECT *, CASE WHEN single AND k IN ('mass-grave', 'discovery') THEN 'forensic-case' ELSE k END AS kind FROM o)
        SELECT job, name, CAST(n AS BIGINT) AS n FROM (
          SELECT 'records' AS job, 'read' AS name, count(*) AS n FROM d UNION ALL SELECT 'records', 'unplaced', count(*) FROM d WHERE NOT placed
          UNION ALL SELECT 'records', 'tagged', count(*) FROM d WHERE placed AND single
          UNION ALL SELECT 'records', 'coarsened', count(*) FROM d WHERE placed AND kind IN {q_in(COARSE_KINDS)} AND g <> 'admin'
          UNION ALL SELECT 'facilities', 'read', count(*) FROM orders UNION ALL SELECT 'facilities', 'refused', count(*) FROM orders WHERE o_orderkey % 5 = 0 AND o_custkey % 4 > 0)""",
)
def job_counters(spark, sf):
    """Counts of the record and the facility job, as stored with the versions they published."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    records = table(spark, sf, "orders").select(
        F.concat(lit("Record "), o.cast("string")).alias("name"), pick(KIND_NAMES, c).alias("kind"), pick(["exact", "area", "admin"], o).alias("geo"),
        F.when(o % 11 > 0, lat(c)).alias("lat"), lng(c).alias("lng"), pick(_CASES, o).alias("desc"), F.col("o_orderpriority").alias("source"), lit(0).alias("source_ord"), o.alias("row_ord"),
    )
    jobs = {"records": lambda p: refresh.publish_daily(spark, conform(records, RECORD), p), "facilities": lambda p: refresh.facility_layer(facility_elements(spark, sf), p)}
    found = []
    for job, run in jobs.items():
        path = shared_dir(spark)
        version = run(path).path.rsplit("/", 1)[-1]
        found.append(spark.read.schema("name string, n long").json(f"{path}/_counts/{version}").select(lit(job).alias("job"), "name", "n"))
    return found[0].unionByName(found[1])


@query(
    "K4, G4, SC10, D8, W2",
    f"""WITH {Q_FACILITIES}, r AS (SELECT *, row_number() OVER (PARTITION BY ftype, CAST(floor(lat * 10000 + 0.5) AS BIGINT), CAST(floor(lng * 10000 + 0.5) AS BIGINT) ORDER BY row_ord) AS rn FROM fac)
        SELECT row_ord, ftype, lat, lng FROM r WHERE rn = 1 AND lat BETWEEN -35.5 AND 28 AND (lng >= 151 OR lng <= -120)""",
)
def layer_viewport(spark, sf):
    path = shared_dir(spark)
    # The stand-in points are spread evenly over the world; 40-degree cells give files
    # of a sensible size for them.
    done = refresh.facility_layer(facility_elements(spark, sf), path, Config(layer_tile_deg=40))
    layer = scan.read_layer(spark, done.path)
    return grid.viewport(layer, -35.5, 151.0, 28.0, -120.0, deg=40).select("row_ord", "ftype", "lat", "lng")


@query(
    "SC12, U4",
    """SELECT CAST(o_orderkey % 3 AS INTEGER) AS part, o_orderpriority AS source, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 3, 'unreadable', 0""",
)
def shard_part_files(spark, sf):
    path = shared_dir(spark)
    o = table(spark, sf, "orders")
    for k in range(3):
        part = o.filter(f"o_orderkey % 3 = {k}").select(F.col("o_orderkey").alias("row_ord"), F.col("o_orderpriority").alias("source"), lit(k).alias("count"))
        part.write.option("compression", "gzip").json(f"{path}/part_{k}")
    # a part that is no JSON file although it is named like one
    o.select(F.col("o_orderpriority").alias("value")).coalesce(1).write.text(f"{path}/text")
    _copy_as(spark, f"{path}/text", f"{path}/part_3/broken.json.gz")
    rows = scan.read_parts(spark, f"{path}/part_*")
    number = F.regexp_extract("part", r"part_(\d+)", 1).cast("int").alias("part")
    lost = scan.part_coverage(rows, f"{path}/part_*").filter("lost")
    good = rows.groupBy(number, "source").agg(F.count(lit(1)).alias("n"))
    return good.unionByName(lost.select(number, lit("unreadable").alias("source"), F.col("n_rows").alias("n")))


def _copy_as(spark, folder: str, target: str) -> None:
    """Copy the one part file of a folder under another name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    part = next(s.getPath() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-"))
    fs.mkdirs(path(target).getParent())
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, part, fs, path(target), False, conf)


@query(
    "K5, J8",
    f"""WITH {Q_FACILITIES}, c AS (SELECT ftype, cell, min(row_ord) AS f, count(*) AS n FROM fac GROUP BY 1, 2)
        SELECT 'layer_' || ftype || '_' || cell || '.json.gz' AS file, ftype, cell FROM c WHERE n % 3 = 0 OR ftype = 'mortuary' UNION ALL SELECT 'layer_museum.json.gz', 'museum', NULL""",
)
def stale_tiles(spark, sf):
    f = normalise.facilities(facility_elements(spark, sf))
    cells = f.groupBy("ftype", "cell").agg(F.count(lit(1)).alias("n"))
    name = F.concat(lit("layer_"), F.col("ftype"), lit("_"), F.col("cell"), lit(".json.gz"))
    extra = small_table(spark, [("layer_museum.json.gz",), ("layer_mortuary.json.gz",), ("notes_0_0.txt",)], "name string")
    listing = sinks.tile_listing(cells.select(name.alias("name")).unionByName(extra), F.col("name"))
    mode = F.when(F.col("ftype") == "mortuary", "single").otherwise("tiled")
    return sinks.stale_tiles(listing, cells.filter("n % 3 <> 0").withColumn("mode", mode))


@query(
    "X1, U1",
    """SELECT source, source_ord, count(*) AS n, true AS ok FROM (SELECT 'alpha' AS source, 0 AS source_ord FROM orders UNION ALL SELECT 'gamma', 2 FROM customer) GROUP BY ALL
       UNION ALL SELECT 'beta', 1, 0, false""",
)
def isolated_sources(spark, sf):
    from ...sources.registry import Registry

    reg = Registry()
    reg.register("alpha", lambda s: table(s, sf, "orders").select(lit("alpha").alias("source"), F.col("o_orderkey").alias("row_ord")))
    reg.register("beta", lambda s: table(s, sf, "orders").select(F.raise_error(lit("beta is down")).cast("string").alias("name")))
    reg.register("gamma", lambda s: table(s, sf, "customer").select(lit("gamma").alias("source"), F.col("c_custkey").alias("row_ord")))
    records, status = reg.run_isolated(spark)
    n = records.groupBy("source").agg(F.count(lit(1)).alias("n"))
    return status.join(n, "source", "left").select("source", "source_ord", F.coalesce("n", lit(0)).alias("n"), "ok")




@query(
    "K5, K1",
    "SELECT v AS version, v > 1 AS data_left, v > 1 AS visible FROM (VALUES (0), (1), (2), (3)) AS t(v) WHERE (SELECT count(*) FROM orders) > 0",
)
def pruned_versions(spark, sf):
    """Publish a layer four times and prune: the data of the last two versions stay, each with its manifest."""
    base, paths = shared_dir(spark), []
    rows = table(spark, sf, "orders").select(
        F.element_at(F.array(lit("cemetery"), lit("museum")), (F.col("o_orderkey") % 2 + 1).cast("int")).alias("ftype"), lat(F.col("o_custkey")).alias("lat"), lng(F.col("o_custkey")).alias("lng")
    )
    for _ in range(4):
        paths.append(sinks.publish_layer(rows, base).path.rsplit("/", 1)[-1])
    gone = sinks.prune_versions(spark, base)
    there = spark.read.parquet(f"{base}/data").select(F.col("v").cast("string").alias("v")).distinct()
    log = small_table(spark, [(i, p[2:], p not in gone) for i, p in enumerate(paths)], "version int, v string, data_left boolean")
    return log.join(there.withColumn("visible", lit(True)), "v", "left").select("version", "data_left", F.coalesce("visible", lit(False)).alias("visible"))
