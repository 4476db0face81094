"""Queries over deduplication, aggregation, ordering and merging."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F


from ...session import small_table
from ...operators import aggregates, dedup, merge, ordering
from .base import Q_DEDUPED, Q_PLACED, query, quoted, table
from .records import Q_FACILITIES, Q_NEWS, facility_elements, news_rows, normalise, placed_records
from .classify import Q_LINK, link_probes

lit = F.lit


@query(
    "W1",
    """SELECT min(o_orderkey) AS row_ord, o_custkey % 50 AS place, o_orderkey % 3 AS variant FROM orders GROUP BY 2, 3""",
)
def dedup_long_names(spark, sf):
    """Names that differ from the fiftieth character on stay apart."""
    place, variant = F.col("o_custkey") % 50, F.col("o_orderkey") % 3
    d = table(spark, sf, "orders").select(
        F.concat(lit("Notice of Inventory Completion for the County Museum of Natural History "), variant.cast("string")).alias("name"),
        (lit(10.0) + place / 10).alias("lat"), lit(20.0).alias("lng"), F.col("o_orderkey").alias("row_ord"), place.alias("place"), variant.alias("variant"),
    )
    return dedup.dedup_records(d, order=("row_ord",)).select("row_ord", "place", "variant")


@query("J3", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'GB' WHEN 1 THEN 'TZ' END AS iso FROM orders")
def long_aliases(spark, sf):
    """Place names of up to seven words are found whole."""
    from ...operators import joins

    names = {"GB": ["united kingdom of great britain and ireland"], "TZ": ["the united republic of tanzania"]}
    texts = F.element_at(F.array(*[lit(f"graves in {t}, a report") for t in (*[v[0] for v in names.values()], "the united kingdom of nowhere", "no place")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    d = table(spark, sf, "orders").select("o_orderkey", texts.alias("folded"))
    return joins.geo_tag(d, "o_orderkey", F.col("folded"), joins.gazetteer_from(spark, {}, names)).select("o_orderkey", "iso")


@query("N7, T5", "SELECT o_orderkey % 3 AS dataset, count(*) AS n, max(o_orderkey // 3) AS last FROM orders GROUP BY 1")
def large_datasets(spark, sf):
    """Every feature of a dataset becomes a record, however many it has."""
    k = F.col("o_orderkey")
    features = table(spark, sf, "orders").select(
        F.concat(lit("http://r/"), F.pmod(k, lit(3)).cast("string")).alias("resource"), (k / 3).cast("int").alias("feature_pos"),
        lit(10.0).alias("lat"), lit(20.0).alias("lng"), F.create_map(lit("name"), F.concat(lit("grave "), k.cast("string"))).alias("props"),
    )
    datasets = small_table(
        spark, [(f"Cemetery graves {i}", "burial ground register", f"http://page/{i}", "X", f"http://r/{i}", None) for i in range(3)],
        "title string, notes string, page string, country string, geojson string, resources array<struct<format:string,url:string>>",
    )
    d = normalise.portal_records(datasets, features, "ckan_portals")
    n = F.regexp_extract("name", "([0-9]+)", 1).cast("bigint")
    return d.groupBy(F.substring("url", -1, 1).cast("bigint").alias("dataset")).agg(F.count(lit(1)).alias("n"), F.max(F.floor(n / 3)).alias("last"))


# --- W1-W7 ------------------------------------------------------------------------------
@query("W1", f"WITH {Q_DEDUPED} SELECT row_ord, name, lat, lng FROM deduped")
def dedup_records(spark, sf):
    from ...operators import gate

    return dedup.dedup_records(gate.only_placed(placed_records(spark, sf))).select("row_ord", "name", "lat", "lng")


_K4 = "CAST(floor(lat * 10000 + 0.5) AS BIGINT), CAST(floor(lng * 10000 + 0.5) AS BIGINT)"


@query(
    "W2",
    f"WITH {Q_FACILITIES}, r AS (SELECT *, row_number() OVER (PARTITION BY ftype, {_K4} ORDER BY row_ord) AS rn FROM fac) SELECT row_ord, ftype, lat, lng FROM r WHERE rn = 1",
)
def dedup_facilities(spark, sf):
    f = normalise.facilities(facility_elements(spark, sf))
    return dedup.dedup_facilities(f, by=("ftype",)).select("row_ord", "ftype", "lat", "lng")


@query(
    "W3, FN21",
    f"WITH {Q_NEWS}, r AS (SELECT *, row_number() OVER (PARTITION BY link_key ORDER BY row_ord) AS rn FROM news) SELECT link_key, row_ord, topic FROM r WHERE rn = 1",
)
def dedup_news(spark, sf):
    return dedup.dedup_news(news_rows(spark, sf)).select("link_key", "row_ord", "topic")


@query("W4", "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1")
def dedup_by_id(spark, sf):
    return dedup.first_wins(table(spark, sf, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "W6, T5",
    "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn <= 20",
)
def per_query_cap(spark, sf):
    return dedup.first_n(table(spark, sf, "events"), ["event_type"], ["event_id"], 20).select("event_type", "event_id")


@query(
    "W7, P16, K6",
    f"""WITH p AS (SELECT page_id, 'site ' || (page_id % 40) AS name, {Q_LINK} AS state FROM pages)
        SELECT name, arg_max(state, page_id) AS state FROM p GROUP BY 1""",
)
def link_status_entries(spark, sf):
    from ..refresh import link_report

    d = link_probes(spark, sf).withColumn("name", F.concat(lit("site "), F.pmod("page_id", lit(40)).cast("string")))
    entries, _ = link_report(d.withColumnRenamed("page_id", "row_ord"))
    return entries.select("name", "state")


@query("W7", "SELECT l_suppkey, max(l_orderkey * 10 + l_linenumber) AS ord, arg_max(l_returnflag, l_orderkey * 10 + l_linenumber) AS l_returnflag FROM lineitem GROUP BY 1")
def last_row_per_key(spark, sf):
    d = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), "l_returnflag")
    # several rows may share an order/line pair; the flag is taken from the highest
    d = d.groupBy("l_suppkey", "ord").agg(F.max("l_returnflag").alias("l_returnflag"))
    return dedup.last_wins(d, ["l_suppkey"], ["ord"])


# --- A1-A6 ------------------------------------------------------------------------------
_ROSTER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NEVER"]
_Q_ROSTER = "(VALUES " + ", ".join(f"({quoted(s)})" for s in _ROSTER) + ") AS r(source)"


@query(
    "A1",
    f"""WITH y AS (SELECT source, count(o_orderkey) AS n FROM {_Q_ROSTER} LEFT JOIN orders ON o_orderpriority = source GROUP BY 1)
        SELECT source, n, CAST((SELECT sum(n) FROM y) AS BIGINT) AS total, (SELECT count(*) FROM y WHERE n > 0) AS active, (SELECT count(*) FROM y) AS listed FROM y""",
)
def source_yields(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("source"))
    y = aggregates.source_yields(d, small_table(spark, [(s,) for s in _ROSTER], "source string"))
    whole = Window.partitionBy(lit(0))  # one row per listed source
    return y.withColumns({"total": F.sum("n").over(whole), "active": F.count_if(F.col("n") > 0).over(whole), "listed": F.count(lit(1)).over(whole)})


@query(
    "A2",
    f"""WITH {Q_PLACED} SELECT 'geo' AS dim, coalesce(geo, '?') AS value, count(*) AS n FROM placed GROUP BY 2 UNION ALL SELECT 'posture', coalesce(posture, '?'), count(*) FROM placed GROUP BY 2
        UNION ALL SELECT 'total', 'total', count(*) FROM placed""",
)
def record_breakdown(spark, sf):
    return aggregates.breakdown(placed_records(spark, sf), "geo", "posture")


@query(
    "A2, K1",
    f"""WITH {Q_PLACED}, g AS (SELECT coalesce(geo, '?') AS geo, count(*) AS n FROM placed GROUP BY 1)
        SELECT (SELECT count(*) FROM placed) AS "count", (SELECT n FROM g WHERE geo = 'coarsened') AS coarsened, (SELECT count(*) FROM placed WHERE posture = 'redress') AS redress,
          '1 .. 5 by number of individuals and irreversibility' AS rating_scale, 'Licensed excavation' AS label""",
)
def record_metadata(spark, sf):
    m = aggregates.meta_row(placed_records(spark, sf))
    return m.select(
        "count", F.element_at("geo_breakdown", "coarsened").alias("coarsened"), F.element_at("posture_breakdown", "redress").alias("redress"),
        "rating_scale", F.element_at("kinds", "excavation").alias("label"),
    )


@query(
    "A3, T3",
    f"WITH {Q_NEWS} SELECT topic, count(*) AS items, count(iso) AS tagged, count(DISTINCT iso) AS countries FROM news GROUP BY 1",
)
def news_by_topic(spark, sf):
    d = news_rows(spark, sf)
    return d.groupBy("topic").agg(F.count(lit(1)).alias("items"), F.count("iso").alias("tagged"), F.count_distinct("iso").alias("countries"))


@query(
    "A3, T3",
    """WITH e AS (SELECT CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'C' || (user_id % 40) END AS iso FROM events), t AS (SELECT iso, count(*) AS n FROM e WHERE iso IS NOT NULL GROUP BY 1 ORDER BY n DESC, iso LIMIT 12)
       SELECT iso, n, (SELECT count(*) FROM e) AS items, (SELECT count(iso) FROM e) AS tagged, (SELECT count(DISTINCT iso) FROM e) AS countries FROM t""",
)
def busiest_countries(spark, sf):
    iso = F.when(F.col("user_id") % 7 == 0, "").otherwise(F.concat(lit("C"), F.pmod("user_id", lit(40)).cast("string")))
    d = table(spark, sf, "events").select(iso.alias("iso"))
    return aggregates.countries_with_totals(d)


@query(
    "A5, G4",
    f"""WITH {Q_FACILITIES}, c AS (SELECT ftype, cell, count(*) AS n_rows FROM fac GROUP BY 1, 2), t AS (SELECT ftype, sum(n_rows) AS type_rows, max(n_rows) AS largest FROM c GROUP BY 1)
        SELECT ftype, cell, n_rows, CAST(type_rows AS BIGINT) AS type_rows, largest, CASE WHEN type_rows < 3200 THEN 'single' ELSE 'tiled' END AS mode FROM c JOIN t USING (ftype)""",
)
def facility_manifest(spark, sf):
    f = normalise.facilities(facility_elements(spark, sf))
    return aggregates.layer_manifest(f, 3200).drop("cell_lat", "cell_lng")


@query(
    "A10",
    """SELECT l_returnflag AS state, l_linestatus AS institution, CAST(sum(l_linenumber) AS BIGINT) AS not_available, CAST(count(*) AS BIGINT) AS made_available, CAST(sum(l_linenumber) + count(*) AS BIGINT) AS total
       FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
def returned_rollup(spark, sf):
    d = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("state"), F.col("l_linestatus").alias("institution"), F.col("l_linenumber").alias("not_available"), lit(1).alias("made_available")
    )
    return aggregates.holdings_rollup(d).drop("level", "shown")


# --- T1, T2 -----------------------------------------------------------------------------
@query(
    "T1, T4",
    f"WITH {Q_PLACED}, s AS (SELECT row_number() OVER (ORDER BY impact DESC, row_ord) AS pos, row_ord, impact FROM placed) SELECT * FROM s",
)
def records_by_impact(spark, sf):
    return ordering.numbered(placed_records(spark, sf), ordering.impact_order()).select("pos", "row_ord", "impact")


@query(
    "T2",
    f"""WITH {Q_NEWS}, s AS (SELECT row_number() OVER (ORDER BY date DESC NULLS LAST, sig DESC, row_ord) AS pos, row_ord, date, sig FROM news) SELECT * FROM s""",
)
def newest_news(spark, sf):
    return ordering.numbered(news_rows(spark, sf), ordering.newest_order()).select("pos", "row_ord", "date", "sig")


# --- U1-U6 ------------------------------------------------------------------------------
@query(
    "U1",
    """SELECT 0 AS source_ord, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 1, l_linestatus, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 2, event_type, count(*) FROM events GROUP BY 2""",
)
def union_of_sources(spark, sf):
    frames = [
        table(spark, sf, "orders").select(F.col("o_orderstatus").alias("s")),
        table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("s"), lit(1).alias("extra")),
        table(spark, sf, "events").select(F.col("event_type").alias("s")),
    ]
    return merge.union_in_order(frames).groupBy("source_ord", "s").agg(F.count(lit(1)).alias("n"))


def _snapshots(spark, sf, drop=()):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("source"), "o_orderdate")
    cut = F.col("o_orderdate") < lit("1998-01-01").cast("timestamp_ntz")
    prior, fresh = o.filter(cut).drop("o_orderdate"), o.filter(~cut).drop("o_orderdate")
    return prior, fresh.filter(~F.col("source").isin(*drop)) if drop else fresh


@query(
    "U2",
    "SELECT o_orderpriority AS source, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR o_orderpriority IN ('2-HIGH', '5-LOW') GROUP BY 1",
)
def carried_sources(spark, sf):
    prior, fresh = _snapshots(spark, sf)
    return merge.carry_forward(fresh, prior, F.col("source").isin("2-HIGH", "5-LOW")).groupBy("source").agg(F.count(lit(1)).alias("n"))


@query(
    "U2, W1",
    """SELECT o_custkey AS place, CASE WHEN bool_or(o_orderkey % 4 > 0) THEN 'fresh' ELSE 'carried' END AS run,
              CASE WHEN bool_or(o_orderkey % 4 > 0) THEN min(CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey END) ELSE min(o_orderkey) END AS row_ord FROM orders GROUP BY 1""",
)
def fresh_before_carried(spark, sf):
    """A fresh row wins over a carried one of the same place, though its source stands later in the roster."""
    k = F.col("o_orderkey")
    d = table(spark, sf, "orders").select(
        lit("a").alias("name"), (F.col("o_custkey") / 1000).alias("lat"), lit(1.0).alias("lng"), k.alias("row_ord"), F.col("o_custkey").alias("place"),
        F.when(k % 4 > 0, "fresh").otherwise("carried").alias("run"), F.when(k % 4 > 0, 9).otherwise(0).alias("source_ord"),
    )
    both = merge.carry_forward(d.filter("run = 'fresh'"), d.filter("run = 'carried'"), lit(True))
    return dedup.dedup_records(both).select("place", "run", "row_ord")


@query(
    "U3, J9",
    """SELECT o_orderpriority AS source, count(*) AS n FROM orders WHERE (o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate < TIMESTAMP '1998-01-01')
       OR (o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_orderdate >= TIMESTAMP '1998-01-01') GROUP BY 1""",
)
def preserved_sources(spark, sf):
    prior, fresh = _snapshots(spark, sf, ("1-URGENT", "5-LOW"))
    return merge.preserve_silent(fresh, prior).groupBy("source").agg(F.count(lit(1)).alias("n"))


@query(
    "U4",
    """SELECT 'parts' AS run, o_orderpriority AS source, count(*) AS n FROM orders WHERE (o_orderpriority = '2-HIGH' AND o_orderdate >= TIMESTAMP '1998-01-01') OR (o_orderpriority NOT IN ('2-HIGH', '5-LOW') AND o_orderdate < TIMESTAMP '1998-01-01') GROUP BY 2
       UNION ALL SELECT 'none', o_orderpriority, count(*) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 2""",
)
def merged_parts(spark, sf):
    prior, fresh = _snapshots(spark, sf)
    fed = ("2-HIGH", "5-LOW")
    parts = fresh.filter("source = '2-HIGH'")

    def run(name, p):
        return merge.merge_parts(p, prior, fed).groupBy("source").agg(F.count(lit(1)).alias("n")).select(lit(name).alias("run"), "source", "n")

    return run("parts", parts).unionByName(run("none", fresh.filter("source = 'nobody'")))


@query("U5", "SELECT o_custkey AS tile_key, o_orderstatus AS state FROM orders GROUP BY ALL")
def merged_states(spark, sf):
    d = table(spark, sf, "orders").select(F.col("o_custkey").alias("tile_key"), F.col("o_orderstatus").alias("state"), F.col("o_orderkey").alias("k"))
    return merge.union_states([d.filter(f"k % 3 = {i}").drop("k") for i in range(3)])


@query("U6", "SELECT o_orderkey % 6 AS shard, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def sharded_orders(spark, sf):
    shard = merge.shard_of(F.col("o_orderkey"), 6).cast("bigint").alias("shard")
    return table(spark, sf, "orders").groupBy(shard).agg(F.count(lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))
