"""Queries over the location gate, the rating and the source normalisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import vocab

from ...operators import gate
from ...session import dealt
from ...sources import normalise, scan
from .. import refresh
from .base import (
    CITIES, COARSE_KINDS, KIND_NAMES, Q_DEDUPED, Q_PLACED, Q_STATES, STATE_CODES, STATE_NAMES, documents, lat, lng, pick, q_case,
    q_impact, q_in, q_lat, q_lng, q_pick, q_snap, query, quoted, raw_records, table,
)

lit = F.lit


def placed_records(spark, sf):
    d = raw_records(spark, sf)
    return gate.rate(gate.place(d, F.col("raw_lat"), F.col("raw_lng"), F.col("geo_level")))


@query(
    "GA1, W1, A2, FN14, FN20, P18",
    f"WITH {Q_DEDUPED} SELECT kind, geo, impact, count(*) AS n FROM deduped GROUP BY kind, geo, impact",
)
def placed_and_deduplicated(spark, sf):
    done = refresh.finish(placed_records(spark, sf))
    return done.groupBy("kind", "geo", "impact").agg(F.count(lit(1)).alias("n"))


@query("GA1, FN14", f"WITH {Q_PLACED} SELECT row_ord, kind, lat, lng, geo, impact FROM placed")
def placement_gate(spark, sf):
    return placed_records(spark, sf).select("row_ord", "kind", "lat", "lng", "geo", "impact")


@query(
    "GA2, A8",
    f"""SELECT o_orderkey, CASE WHEN k IN {q_in(COARSE_KINDS)} AND g <> 'admin' THEN {q_snap("y")} ELSE y END AS lat,
          CASE WHEN k IN {q_in(COARSE_KINDS)} AND g <> 'admin' THEN {q_snap("x")} ELSE x END AS lng,
          CASE WHEN k IN {q_in(COARSE_KINDS)} AND g <> 'admin' THEN 'coarsened' ELSE g END AS geo
        FROM (SELECT o_orderkey, {q_pick(KIND_NAMES, "o_custkey")} AS k, {q_pick(["exact", "area", "admin"], "o_orderkey")} AS g, {q_lat("o_custkey")} AS y, {q_lng("o_custkey")} AS x FROM orders)""",
)
def placement_audit(spark, sf):
    c = F.col("o_custkey")
    d = table(spark, sf, "orders").select(
        "o_orderkey", pick(KIND_NAMES, c).alias("kind"), pick(["exact", "area", "admin"], F.col("o_orderkey")).alias("geo"), lat(c).alias("lat"), lng(c).alias("lng")
    )
    return gate.audit(gate.audit(d)).drop("kind")


_HIT = "(contains(lower(text), 'tion th') OR contains(lower(text), 'eau ')) AND NOT (contains(lower(text), 'inin') OR contains(lower(text), 'vi '))"
_K3 = q_pick(["mass-grave", "discovery", "review", "holding"], "doc_id")


@query(
    "GA3",
    f"""SELECT doc_id, CASE WHEN {_HIT} AND {_K3} IN ('mass-grave', 'discovery') THEN 'forensic-case' ELSE {_K3} END AS kind,
        CASE WHEN {_HIT} AND {_K3} IN ('mass-grave', 'discovery') THEN 'redress' ELSE 'watch' END AS posture FROM documents""",
)
def individual_case_labels(spark, sf):
    d = documents(spark, sf).select(
        "doc_id", pick(["mass-grave", "discovery", "review", "holding"], F.col("doc_id")).alias("kind"), lit("watch").alias("posture"),
        lit(None).cast("string").alias("name"), F.col("text").alias("desc"),
    )
    return gate.label_individual_cases(d, single=("tion th", "eau "), group=("inin", "vi ")).select("doc_id", "kind", "posture")


# --- N1, N2 ------------------------------------------------------------------------------
_PHRASES = [p for p, _ in vocab.NOTICE_FAMILIES] + ["Notice of something else"]
_N_CODES = STATE_CODES + ["ZZ"]


def notice_table(spark, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    title = F.concat(
        pick(_PHRASES, o), lit(": Museum "), F.col("o_orderpriority"), lit(" of "), pick(CITIES, c),
        F.when(c % 7 > 0, F.concat(lit(", "), pick(CITIES, c), F.when(o % 2 == 0, ",").otherwise(""), lit(" "), pick(_N_CODES, c))).otherwise(""),
    )
    agencies = F.array(F.struct(F.concat(lit("Agency "), F.col("o_orderstatus")).alias("name")))
    return table(spark, sf, "orders").select(
        title.alias("title"),
        F.concat(lit("The remains of at least "), F.pmod(c, lit(30)).cast("string"), lit(" individuals")).alias("abstract"),
        agencies.alias("agencies"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"),
        F.concat(lit("https://fr.example/"), o.cast("string")).alias("html_url"),
        lit(None).cast("string").alias("comments_close_on"),
        o.cast("string").alias("document_number"),
        o.alias("row_ord"),
    )


def _elsewhere(c):
    """Four in five gazetteer names are of places that no record names."""
    return F.when(c % 5 == 0, "").otherwise(" Falls")


_Q_ELSEWHERE = "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE ' Falls' END"


def city_gazetteer(spark, sf):
    c = F.col("c_custkey")
    return (
        table(spark, sf, "customer")
        .groupBy(F.concat(pick(CITIES, c), _elsewhere(c), lit(", "), pick(STATE_NAMES, c)).alias("q"))
        .agg(F.min(lat(c)).alias("lat"), F.min(lng(c)).alias("lng"))
    )


_Q_GAZ = f"""g AS (SELECT {q_pick(CITIES, "c_custkey")} || {_Q_ELSEWHERE} || ', ' || {q_pick(STATE_NAMES, "c_custkey")} AS q, min({q_lat("c_custkey")}) AS glat, min({q_lng("c_custkey")}) AS glng
          FROM customer GROUP BY 1)"""


@query(
    "N1, J1, J2, J4, FN18",
    f"""WITH {_Q_GAZ}, f(i, phrase, kind) AS (VALUES {", ".join(f"({i}, {quoted(p)}, {quoted(k)})" for i, (p, k) in enumerate(vocab.NOTICE_FAMILIES))}),
        n AS (SELECT o_orderkey, o_orderpriority, o_custkey AS c, {q_pick(_PHRASES, "o_orderkey")} AS ph, {q_pick(CITIES, "o_custkey")} AS city, o_orderdate, {q_pick(_N_CODES, "o_custkey")} AS code FROM orders WHERE o_custkey % 7 > 0)
        SELECT o_orderkey + i * 1000000000000000 AS row_ord, kind, st.state AS region, CAST(c % 30 AS INTEGER) AS count, 'Museum ' || o_orderpriority || ' of ' || city AS held_by,
          round(coalesce(glat, slat), 4) AS lat, round(coalesce(glng, slng), 4) AS lng, CASE WHEN glat IS NULL THEN 'admin' ELSE 'exact' END AS geo,
          strftime(o_orderdate, '%Y-%m-%d') AS date, {q_impact("kind", "(c % 30)")} AS impact,
          {q_case({k: v[0] for k, v in vocab.KINDS.items()}, "kind")} || '. Held at ' || city || ', ' || st.state || '. ' || CASE WHEN glat IS NULL THEN {quoted(vocab.GEO_NOTE["admin"])} ELSE {quoted(vocab.GEO_NOTE["exact"])} END AS "desc"
        FROM n JOIN f ON contains(lower(ph), lower(phrase)) JOIN {Q_STATES} ON st.abbr = code LEFT JOIN g ON g.q = city || ', ' || st.state""",
)
def normalise_notices(spark, sf):
    out = normalise.notices(notice_table(spark, sf), city_gazetteer(spark, sf))
    return out.select("row_ord", "kind", "region", "count", "held_by", "lat", "lng", "geo", "date", "impact", "desc")


@query(
    "A6",
    f"""WITH f(i, phrase) AS (VALUES {", ".join(f"({i}, {quoted(p)})" for i, (p, _) in enumerate(vocab.NOTICE_FAMILIES))}),
        n AS (SELECT {q_pick(_PHRASES, "o_orderkey")} AS ph FROM orders)
        SELECT i AS phrase_ord, phrase, count(ph) AS n FROM f LEFT JOIN n ON contains(lower(ph), lower(phrase)) GROUP BY ALL""",
)
def notice_family_counts(spark, sf):
    from ...operators import aggregates, joins

    d = notice_table(spark, sf)
    return aggregates.family_counts(joins.explode_phrases(d, F.col("title"), vocab.NOTICE_FAMILIES))


_R_TEXT = ["A quarry over a burial ground", "Highway works, unmarked grave", "Cable burial and a graveyard", "Road works"]


@query(
    "N2, P1, P4, P5, W4",
    f"""WITH r AS (SELECT o_custkey AS dn, o_orderkey, {q_pick(_R_TEXT, "o_orderkey")} AS t, {q_pick(STATE_NAMES, "o_custkey")} AS st1, {q_pick(STATE_NAMES, "o_orderkey")} AS st2, o_orderstatus FROM orders),
        k AS (SELECT *, CASE WHEN o_orderkey % 5 > 0 OR st1 = st2 THEN CASE WHEN st1 <> 'West Virginia' THEN st1 END END AS region FROM r
              WHERE t IN ('A quarry over a burial ground', 'Highway works, unmarked grave') AND o_orderkey % 11 > 0),
        w AS (SELECT *, row_number() OVER (PARTITION BY dn ORDER BY o_orderkey) AS rn FROM k WHERE region IS NOT NULL)
        SELECT o_orderkey AS row_ord, region, CASE t WHEN 'A quarry over a burial ground' THEN 'extraction' ELSE 'infrastructure' END AS "trigger", 'Agency ' || o_orderstatus AS actor, 2 AS impact, slat AS lat, slng AS lng
        FROM w JOIN {Q_STATES} ON st.state = region WHERE rn = 1""",
)
def normalise_reviews(spark, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    body = F.concat(
        lit("In "), pick(STATE_NAMES, c), F.when((o % 5 == 0) & (pick(STATE_NAMES, c) != pick(STATE_NAMES, o)), F.concat(lit(" or "), pick(STATE_NAMES, o))).otherwise("")
    )
    head = F.when(o % 11 == 0, F.concat(lit("Notice of Inventory Completion: "), pick(_R_TEXT, o))).otherwise(pick(_R_TEXT, o))
    raw = table(spark, sf, "orders").select(
        head.alias("title"), body.alias("abstract"),
        F.array(F.struct(F.concat(lit("Agency "), F.col("o_orderstatus")).alias("name"))).alias("agencies"),
        lit("2024-01-02").alias("publication_date"), lit("u").alias("html_url"), lit(None).cast("string").alias("comments_close_on"),
        c.alias("document_number"), o.alias("row_ord"),
    )
    # A two-state text that contains "Virginia" and "West Virginia" is ambiguous; the
    # oracle skips West Virginia, which always is.
    out = normalise.reviews(raw)
    return out.select("row_ord", "region", "trigger", "actor", "impact", "lat", "lng")


# --- N3-N6 --------------------------------------------------------------------------------
_PERMIT = ["Issued", "Surrendered", "", "Current"]


@query(
    "N3, FN1, FN3, FN4, FN12, P14",
    f"""SELECT p_partkey AS row_ord, 'AHIP ' || p_partkey || ' — ' || p_name || ' mine' AS name, 'extraction' AS "trigger",
          CASE WHEN p_partkey % 4 = 2 THEN 'Issued' ELSE {q_pick(_PERMIT, "p_partkey")} END AS status, p_brand AS actor, '2021-03-04' AS date, '2023-11-14' AS deadline,
          round({q_lat("p_partkey")} + 1, 4) AS lat, round({q_lng("p_partkey")} + 1, 4) AS lng, 'area' AS geo, 3 AS impact FROM part WHERE p_partkey % 4 <> 1""",
)
def normalise_permits(spark, sf):
    k = F.col("p_partkey")
    y, x = lat(k), lng(k)
    corner = lambda a, b: F.concat(lit("["), (x + b).cast("string"), lit(","), (y + a).cast("string"), lit("]"))
    g = F.concat(lit('{"type":"Polygon","coordinates":[['), F.concat_ws(",", corner(0, 0), corner(2, 0), corner(2, 2), corner(0, 2)), lit("]]}"))
    props = F.create_map(
        lit("PermitNumber"), k.cast("string"), lit("STATUS"), pick(_PERMIT, k), lit("Holder"), F.col("p_brand"),
        lit("Activity"), F.concat("p_name", lit(" mine")), lit("IssueDate"), lit("3/4/2021"), lit("ExpiryDate"), lit("1700000000000"),
    )
    parts = dealt(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey")
    raw = parts.select(g.alias("geometry"), props.alias("props"), k.alias("row_ord"))
    out = normalise.permits(raw)
    return out.select("row_ord", "name", "trigger", "status", "actor", "date", "deadline", F.round("lat", 4).alias("lat"), F.round("lng", 4).alias("lng"), "geo", "impact")


@query(
    "N4, SC3, J2",
    f"""WITH {_Q_GAZ.replace("', ' || ", "' County, California' || ").replace("|| " + q_pick(STATE_NAMES, "c_custkey"), "")}
        SELECT o_orderkey AS row_ord, round(CASE WHEN o_orderkey % 3 = 0 THEN {q_lat("o_custkey")} ELSE coalesce(glat, 37.18) END, 4) AS lat,
          round(CASE WHEN o_orderkey % 3 = 0 THEN {q_lng("o_custkey")} ELSE coalesce(glng, -119.47) END, 4) AS lng, CASE WHEN o_orderkey % 3 = 0 THEN 'area' ELSE 'admin' END AS geo,
          'Graveyard works ' || o_orderkey AS name, 'Agency ' || o_orderstatus AS actor, 'https://ceqanet.lci.ca.gov/' || o_orderkey AS url,
          'California CEQA filing naming burials or human remains' || CASE WHEN o_orderkey % 4 > 0 THEN ' in ' || {q_pick(CITIES, "o_custkey")} || ' County. ' ELSE '. ' END
            || CASE WHEN o_orderkey % 3 = 0 THEN {quoted(vocab.GEO_NOTE["area"])} ELSE {quoted(vocab.GEO_NOTE["admin"])} END AS "desc"
        FROM orders LEFT JOIN g ON o_orderkey % 3 > 0 AND o_orderkey % 4 > 0 AND g.q = {q_pick(CITIES, "o_custkey")} || ' County, California' WHERE o_orderkey % 5 > 0""",
)
def normalise_filings(spark, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    g = (
        table(spark, sf, "customer").groupBy(F.concat(pick(CITIES, F.col("c_custkey")), _elsewhere(F.col("c_custkey")), lit(" County, California")).alias("q"))
        .agg(F.min(lat(F.col("c_custkey"))).alias("lat"), F.min(lng(F.col("c_custkey"))).alias("lng"))
    )
    raw = table(spark, sf, "orders").select(
        o.cast("string").alias("SCH Number"),
        F.concat(F.when(o % 5 > 0, "Graveyard works ").otherwise("Road works "), o.cast("string")).alias("Title"),
        F.when(o % 4 > 0, pick(CITIES, c)).otherwise("").alias("County"),
        F.concat(lit("Agency "), F.col("o_orderstatus")).alias("Lead Agency"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("Received"),
        F.when(o % 3 == 0, lat(c).cast("string")).otherwise("n/a").alias("Latitude"),
        F.when(o % 3 == 0, lng(c).cast("string")).alias("Longitude"),
        lit(None).cast("string").alias("_overflow"),
        o.alias("row_ord"),
    )
    out = normalise.filings(raw, g)
    return out.select("row_ord", "lat", "lng", "geo", "name", "actor", "url", "desc")


@query(
    "N5, FN22, GA1",
    f"""SELECT p_partkey AS row_ord, 'Extension over burial ground at ' || p_name AS name, 'Council ' || p_brand AS region, 'Application lodged' AS status, '2024-05-06' AS date,
          {q_snap(q_lat("p_partkey"))} AS lat, {q_snap(q_lng("p_partkey"))} AS lng, 'coarsened' AS geo, 3 AS impact FROM part WHERE p_partkey % 3 > 0""",
)
def normalise_planning(spark, sf):
    k = F.col("p_partkey")
    g = F.concat(lit('{"type":"Point","coordinates":['), lng(k).cast("string"), lit(","), lat(k).cast("string"), lit("]}"))
    props = F.create_map(
        lit("description"), F.concat(F.when(k % 3 > 0, "Extension over burial ground at ").otherwise("Extension at "), F.col("p_name")),
        lit("authority"), F.concat(lit("Council "), F.col("p_brand")), lit("start_date"), lit("2024-05-06"),
    )
    out = normalise.planning(table(spark, sf, "part").select(g.alias("geometry"), props.alias("props"), k.alias("row_ord")))
    return out.select("row_ord", "name", "region", "status", "date", "lat", "lng", "geo", "impact")


_LIFE = [k for k, _ in vocab.REMOVED_TAGS] + ["landuse"]


def elements(spark, sf):
    k = F.col("c_custkey")
    tag = pick(_LIFE, k)
    value = F.when(F.contains(tag, lit("amenity")), "grave_yard").otherwise("cemetery")
    tags = F.map_concat(F.create_map(tag, value), F.when(k % 4 > 0, F.create_map(lit("old_name"), F.col("c_name"))).otherwise(F.create_map(lit("x"), lit("y"))))
    node = k % 2 == 0
    return table(spark, sf, "customer").select(
        F.when(node, "node").otherwise("way").alias("type"), k.alias("id"), F.when(node, lat(k)).alias("lat"), F.when(node, lng(k)).alias("lon"),
        F.when(~node & (k % 10 != 9), F.struct(lat(k).alias("lat"), lng(k).alias("lon"))).alias("center"), tags.alias("tags"), k.alias("row_ord"),
    )


@query(
    "N6",
    f"""WITH e AS (SELECT c_custkey, c_name, {q_pick(_LIFE, "c_custkey")} AS tag, {q_lat("c_custkey")} AS y, {q_lng("c_custkey")} AS x FROM customer WHERE c_custkey % 10 <> 9)
        SELECT c_custkey AS row_ord, CASE WHEN c_custkey % 4 > 0 THEN c_name ELSE 'Unnamed burial ground' END AS name, 'Recorded in OpenStreetMap as ' || split_part(tag, ':', 1) AS status,
          'https://www.openstreetmap.org/' || CASE WHEN c_custkey % 2 = 0 THEN 'node/' ELSE 'way/' END || c_custkey AS url,
          CASE WHEN y = 0 THEN 0.025 ELSE {q_snap("y")} END AS lat, {q_snap("x")} AS lng, 'coarsened' AS geo FROM e WHERE tag <> 'landuse' AND (c_custkey % 2 = 1 OR (y <> 0 AND x <> 0))""",
)
def normalise_removed_grounds(spark, sf):
    return normalise.removed_grounds(elements(spark, sf)).select("row_ord", "name", "status", "url", "lat", "lng", "geo")


# --- N7-N10 ---------------------------------------------------------------------------------
_TITLES = ["Cemetery excavations", "Old graveyard", "Wahi tapu and burial sites", "Road works"]


def _datasets(spark, sf, ods: bool):
    k = F.col("s_suppkey")
    res = F.array(
        F.struct(lit("CSV").alias("format"), lit("http://x").alias("url")),
        F.struct(lit("geoJSON").alias("format"), F.concat(lit("http://r/"), k.cast("string")).alias("url")),
        F.struct(lit("GeoJSON").alias("format"), lit("http://second").alias("url")),
    )
    link = F.concat(lit("http://r/"), k.cast("string"))
    return table(spark, sf, "supplier").select(
        pick(_TITLES, k).alias("title"), F.col("s_name").alias("notes"), F.concat(lit("http://page/"), k.cast("string")).alias("page"), lit("France").alias("country"),
        (link if ods else lit(None).cast("string")).alias("geojson"), (lit(None).cast(res_type) if ods else res).alias("resources"),
    )


res_type = "array<struct<format:string,url:string>>"


def _features(spark, sf):
    k = F.col("c_custkey")
    g = F.concat(lit('{"type":"Point","coordinates":['), lng(k).cast("string"), lit(","), lat(k).cast("string"), lit("]}"))
    d = table(spark, sf, "customer").select(
        F.concat(lit("http://r/"), F.pmod(k, lit(100)).cast("string")).alias("resource"), (k / 100).cast("int").alias("feature_pos"),
        lat(k).alias("lat"), lng(k).alias("lng"), F.create_map(lit("nom"), F.when(k % 3 > 0, F.col("c_name")).otherwise(""), lit("seg"), F.col("c_mktsegment")).alias("props"), g.alias("g"),
    )
    return d.drop("g")


def _portal_sql(source: str) -> str:
    t = q_pick(_TITLES, "s_suppkey")
    return f"""SELECT {quoted(source)} AS source, CASE WHEN c_custkey % 3 > 0 THEN c_name ELSE {t} END AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'excavation' ELSE 'removed-ground' END AS kind,
          'harm' AS posture, 'http://page/' || s_suppkey AS url, {q_snap(q_lat("c_custkey"))} AS lat, {q_snap(q_lng("c_custkey"))} AS lng, 'coarsened' AS geo,
          'From “' || {t} || '”. ' || {quoted(vocab.GEO_NOTE["coarsened"])} AS "desc"
        FROM supplier JOIN customer ON c_custkey % 100 = s_suppkey WHERE s_suppkey % 4 < 2"""


def _portal(spark, sf, source, ods):
    out = normalise.portal_records(_datasets(spark, sf, ods), _features(spark, sf), source)
    return out.select("source", "name", "kind", "posture", "url", "lat", "lng", "geo", "desc")


@query("N7, N10, P1, P2, P15, SC2, W6", _portal_sql("ckan_portals"))
def normalise_ckan(spark, sf):
    return _portal(spark, sf, "ckan_portals", False)


@query("N8, N10", _portal_sql("ods_portals"))
def normalise_ods(spark, sf):
    return _portal(spark, sf, "ods_portals", True)


@query("N9, N10", _portal_sql("geonode_portals"))
def normalise_geonode(spark, sf):
    return _portal(spark, sf, "geonode_portals", True)


# --- N11-N13 ----------------------------------------------------------------------------------
@query(
    "N11, FN10",
    f"""SELECT c_custkey AS row_ord, c_name || ' — inventories' AS name, st.state AS region, CAST(CASE c_custkey % 3 WHEN 0 THEN 1000 + c_custkey WHEN 1 THEN c_custkey END AS INTEGER) AS count,
          slat AS lat, slng AS lng, {q_impact("'holding'", "CASE c_custkey % 3 WHEN 0 THEN 1000 + c_custkey WHEN 1 THEN c_custkey END")} AS impact
        FROM customer JOIN {Q_STATES} ON st.abbr = {q_pick(_N_CODES, "c_custkey")}""",
)
def normalise_holdings_grid(spark, sf):
    k = F.col("c_custkey")
    raw = table(spark, sf, "customer").select(
        F.concat(lit(" "), F.col("c_name")).alias("MuseumName"), F.lower(pick(_N_CODES, k)).alias("State"),
        F.when(k % 3 == 0, F.format_number(k + 1000, 0)).when(k % 3 == 1, "-").otherwise("many").alias("Individuals"),
        F.when(k % 3 == 1, F.concat(k.cast("string"), lit(".7"))).alias("Count"), k.alias("row_ord"),
    )
    out = normalise.holdings_grid(raw)
    return out.select("row_ord", "name", "region", "count", "lat", "lng", "impact")


_P_DESC = ["Human remains found at burial ground", "burial ground memorial", "Burial ground works", "New cemetery with mass grave", "Cemetery relocation", "offices"]
_P_KIND = ["discovery", "review", "removed-ground", None, "exhumation", None]


def projects(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        F.col("p_name").alias("name"), pick(_P_DESC, k).alias("desc"), F.col("p_type").alias("type"), lit(None).cast("string").alias("status"),
        F.col("p_brand").alias("company"), lit("S").alias("state"), lit("u").alias("url"), lit("2024-01-01").alias("date"), lit("").alias("deadline"),
        F.when(k % 2 == 0, "feed").alias("source"), F.when(k % 9 > 0, lat(k)).alias("lat"), lng(k).alias("lng"), (k % 2 == 0).alias("precise"), k.alias("row_ord"),
    )


@query(
    "N12, J4",
    f"""WITH p AS (SELECT p_partkey, p_name, {q_pick([x or "" for x in _P_KIND], "p_partkey")} AS kind, {q_pick(_P_DESC, "p_partkey")} AS d, p_partkey % 2 = 0 AS precise, {q_lat("p_partkey")} AS y, {q_lng("p_partkey")} AS x FROM part WHERE p_partkey % 9 > 0)
        SELECT p_partkey AS row_ord, p_name AS name, kind, {q_case({k: v[1] for k, v in vocab.KINDS.items()}, "kind")} AS posture, {q_impact("kind", "0")} AS impact,
          CASE WHEN kind = 'review' THEN round(y, 4) ELSE {q_snap("y")} END AS lat, CASE WHEN kind = 'review' THEN round(x, 4) ELSE {q_snap("x")} END AS lng,
          CASE WHEN kind <> 'review' THEN 'coarsened' WHEN precise THEN 'exact' ELSE 'area' END AS geo,
          'From the projects feed (' || CASE WHEN precise THEN 'feed' ELSE 'unknown source' END || '). ' || d AS "desc" FROM p WHERE kind <> ''""",
)
def normalise_project_texts(spark, sf):
    out = normalise.projects_naming_graves(projects(spark, sf))
    return out.select("row_ord", "name", "kind", "posture", "impact", "lat", "lng", "geo", "desc")


@query(
    "N13, J5",
    f"""WITH l AS (SELECT p_partkey AS k, {q_lat("p_partkey")} AS a, {q_lng("p_partkey")} AS b FROM part WHERE p_partkey % 9 > 0),
        r AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS nm, {q_lat("c_custkey")} AS c, {q_lng("c_custkey")} AS d FROM customer),
        m AS (SELECT k, a, b, nm, sqrt(((c - a) * 111320) ** 2 + ((CASE WHEN d - b > 180 THEN d - b - 360 WHEN d - b < -180 THEN d - b + 360 ELSE d - b END) * 111320 * cos(radians((a + c) / 2))) ** 2) AS m
              FROM l JOIN r ON c BETWEEN a - 0.06 AND a + 0.06),
        b AS (SELECT k, a, b, min(m) AS m, min_by(nm, (m, nm)) AS nm FROM m WHERE m <= 5000 GROUP BY ALL)
        SELECT k AS row_ord, 'review' AS kind, 'proximity' AS "trigger", 2 AS impact, round(a, 4) AS lat, round(b, 4) AS lng, CASE WHEN k % 2 = 0 THEN 'exact' ELSE 'area' END AS geo,
          'PROXIMITY FLAG, not a finding: this project sits about ' || CAST(round(m) AS BIGINT) || ' m from ' || CASE WHEN nm = '' THEN 'a recorded burial ground' ELSE nm END || ' in the burial-ground layer.' AS head FROM b""",
)
def normalise_project_proximity(spark, sf):
    k = F.col("c_custkey")
    layer = table(spark, sf, "customer").select(
        lit("cemetery").alias("ftype"), F.when(k % 3 > 0, F.col("c_name")).alias("name"), lat(k).alias("lat"), lng(k).alias("lng")
    )
    from ...schema import Config

    out = refresh.projects_on_grounds(projects(spark, sf), layer, Config(radius_m=5000.0))
    head = F.concat(F.substring_index("desc", " layer.", 1), lit(" layer."))
    return out.select("row_ord", "kind", "trigger", "impact", "lat", "lng", "geo", head.alias("head"))


# --- N14-N16 --------------------------------------------------------------------------------------
_C_IDS = [c[0] for c in vocab.COURTS[:9]] + ["nowhere"]
_Q_COURTS = "(VALUES " + ", ".join(f"({quoted(c)}, {y!r}::DOUBLE, {x!r}::DOUBLE)" for c, y, x in vocab.COURTS) + ") AS ct(id, clat, clng)"


def case_hits(spark, sf):
    o = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(o % 17 > 0, F.col("o_custkey")).alias("cluster_id"), F.concat(lit("Case "), o.cast("string")).alias("caseName"), lit(None).cast("string").alias("suitNature"),
        F.upper(pick(_C_IDS, F.col("o_custkey"))).alias("court_id"), pick(_C_IDS, F.col("o_custkey")).alias("court"), lit("Published").alias("status"),
        F.concat(lit("/op/"), o.cast("string")).alias("absolute_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateFiled"), lit("12-3").alias("docketNumber"),
        F.when(o % 3 > 0, F.array(F.struct(lit("the <mark>graves</mark>\nof").alias("snippet")), F.struct(lit(None).cast("string").alias("snippet")))).alias("opinions"), o.alias("row_ord"),
    )


@query(
    "N14, W4, J1",
    f"""WITH h AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderkey % 17 > 0 AND o_orderkey % 3 > 0)
        SELECT o_orderkey AS row_ord, 'Case ' || o_orderkey AS name, coalesce(clat, 39.8283) AS lat, coalesce(clng, -98.5795) AS lng, CASE WHEN clat IS NULL THEN 'admin' ELSE 'exact' END AS geo,
          {quoted(vocab.TEXT["case_desc"])} || {q_pick(_C_IDS, "o_custkey")} || ', docket 12-3. the graves of' AS "desc" FROM h LEFT JOIN {_Q_COURTS} ON id = {q_pick(_C_IDS, "o_custkey")} WHERE rn = 1""",
)
def normalise_cases(spark, sf):
    return normalise.cases(case_hits(spark, sf)).select("row_ord", "name", "lat", "lng", "geo", "desc")


@query(
    "A7, T3",
    f"""SELECT coalesce(k, '?') AS key, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'c' || (o_custkey % 40) ELSE {q_pick(_C_IDS, "o_custkey")} END AS k FROM orders)
        WHERE k IS NULL OR k NOT IN {q_in([c[0] for c in vocab.COURTS])} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 12""",
)
def unmapped_courts(spark, sf):
    from ...operators.aggregates import unmapped_tally

    o, c = F.col("o_orderkey"), F.col("o_custkey")
    k = F.when(o % 4 == 1, F.concat(lit("c"), F.pmod(c, lit(40)).cast("string"))).when(o % 4 > 1, pick(_C_IDS, c))
    d = table(spark, sf, "orders").select(k.alias("k"))
    return unmapped_tally(d, F.col("k"), F.col("k").isin(*[x[0] for x in vocab.COURTS]))


_A_IDS = ["doi", "BLM", "XYZ"]
_T = ["Comment submitted by Navajo Nation.", "Navajo Nation objection to the mine", "Comment from Acme Mining Corp", ""]


@query(
    "N15, FN11, FN26, P10, W4",
    f"""WITH h AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderkey % 4 < 2)
        SELECT o_orderkey AS row_ord, 'Objection filed: Navajo Nation' AS name, upper({q_pick(_A_IDS, "o_orderkey")}) AS actor, strftime(o_orderdate, '%Y-%m-%d') AS date,
          CASE WHEN o_orderkey % 3 = 2 THEN 38.8951::DOUBLE ELSE 38.8938::DOUBLE END AS lat, CASE WHEN o_orderkey % 3 = 2 THEN -77.0364::DOUBLE ELSE -77.0426::DOUBLE END AS lng,
          CASE WHEN o_orderkey % 3 = 2 THEN 'admin' ELSE 'exact' END AS geo, 2 AS impact FROM h WHERE rn = 1""",
)
def normalise_comments(spark, sf):
    o = F.col("o_orderkey")
    attrs = F.struct(pick(_T, o).alias("title"), pick(_A_IDS, o).alias("agencyId"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("postedDate"))
    raw = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("id"), attrs.alias("attributes"), o.alias("row_ord"))
    return normalise.comments(raw, "NAGPRA").select("row_ord", "name", "actor", "date", "lat", "lng", "geo", "impact")


@query(
    "N16, SC6, FN2",
    """SELECT c_custkey AS row_ord, c_name || ' graves' AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS region, 'Open' AS status,
         'https://sahris.sahra.org.za/node/' || c_custkey AS url, '2019-05' AS date, -28.5::DOUBLE AS lat, 24.7::DOUBLE AS lng, 'admin' AS geo FROM customer WHERE c_custkey % 5 > 1""",
)
def normalise_heritage_cases(spark, sf):
    k = F.col("c_custkey")
    title = F.concat(F.when(k % 5 == 1, "Wahi tapu ").otherwise(""), F.col("c_name"), F.when(k % 5 == 0, " road").otherwise(" graves"))
    attrs = F.concat(
        lit('{"title":[{"value":"'), title, lit('"}],"nid":"'), k.cast("string"), lit('","field_province":'),
        F.when(k % 2 == 0, F.concat(lit('{"value":"'), F.col("c_mktsegment"), lit('"}'))).otherwise("null"), lit(',"field_case_status":"Open","changed":"2019-05"}'),
    )
    doc = F.when(k % 3 == 0, F.concat(lit('{"nodes":[{"node":'), attrs, lit("}]}"))).when(k % 3 == 1, F.concat(lit('{"data":[{"attributes":'), attrs, lit("}]}"))).otherwise(F.concat(lit("["), attrs, lit("]")))
    rows = scan.unwrap_payloads(table(spark, sf, "customer").select(k.alias("row_ord"), doc.alias("doc")), F.col("doc"), vocab.NODE_ROW_KEYS)
    return normalise.heritage_cases(rows).select("row_ord", "name", "region", "status", "url", "date", "lat", "lng", "geo")


# --- N17-N19 -----------------------------------------------------------------------------------------
def _holding_sql(tail: str) -> str:
    return f"""WITH {_Q_GAZ.replace("', ' || ", "' Museum, ' || ")},
        h AS (SELECT o_orderkey, {q_pick(CITIES, "o_custkey")} || ' Museum' AS inst, {q_pick(STATE_NAMES, "o_custkey")} AS s, 1000 + o_custkey AS a, o_orderkey % 50 AS b FROM orders WHERE o_orderkey % 6 > 0),
        w AS (SELECT *, row_number() OVER (PARTITION BY lower(inst), s ORDER BY o_orderkey) AS rn FROM h) {tail}"""


def holding_pages(spark, sf):
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.concat(pick(CITIES, c), lit("  Museum"))
    row = F.concat(
        lit("<tr><td><a>"), F.when(o % 6 == 0, "Total held").otherwise(name), lit("</a></td><td>"), F.format_number(c + 1000, 0), lit("</td><td>"), (o % 50).cast("string"), lit("</td></tr>")
    )
    html = F.concat(lit("<table><tr><th>Institution</th><th>a</th><th>b</th></tr>"), row, lit("<tr><td>Abc</td><td>1</td><td>2</td></tr></table>"))
    pages = table(spark, sf, "orders").select(pick(STATE_NAMES, c).alias("state"), html.alias("html"), o.alias("row_ord"))
    return scan.numeric_rows(scan.html_rows(pages, F.col("html"))).drop("html")


@query(
    "N17, SC5, J2, W4",
    _holding_sql(
        f"""SELECT o_orderkey AS row_ord, inst AS name, s AS region, CAST(a AS INTEGER) AS count, b || ' of ' || (a + b) || ' made available for return' AS status,
          round(coalesce(glat, slat), 4) AS lat, round(coalesce(glng, slng), 4) AS lng, CASE WHEN glat IS NULL THEN 'admin' ELSE 'exact' END AS geo, {q_impact("'holding'", "a")} AS impact
        FROM w JOIN {Q_STATES} ON st.state = s LEFT JOIN g ON g.q = inst || ', ' || s WHERE rn = 1"""
    ),
)
def normalise_holdings(spark, sf):
    c = F.col("c_custkey")
    g = (
        table(spark, sf, "customer").groupBy(F.concat(pick(CITIES, c), _elsewhere(c), lit(" Museum, "), pick(STATE_NAMES, c)).alias("q"))
        .agg(F.min(lat(c)).alias("lat"), F.min(lng(c)).alias("lng"))
    )
    out = normalise.holdings(holding_pages(spark, sf), g)
    return out.select("row_ord", "name", "region", "count", "status", "lat", "lng", "geo", "impact")


@query(
    "A10",
    _holding_sql(
        """SELECT s AS state, inst AS institution, sum(a) AS not_available, sum(b) AS made_available, sum(b) || ' of ' || sum(a + b) AS shown, CAST(grouping(s, inst) AS BIGINT) AS level
        FROM w WHERE rn = 1 GROUP BY ROLLUP (s, inst)"""
    ).replace("sum(a) AS", "CAST(sum(a) AS BIGINT) AS").replace("sum(b) AS", "CAST(sum(b) AS BIGINT) AS"),
)
def holdings_rollup(spark, sf):
    from ...operators.aggregates import holdings_rollup as roll

    return roll(normalise.holding_rows(holding_pages(spark, sf))).select("state", "institution", "not_available", "made_available", "shown", F.col("level").cast("bigint").alias("level"))


_G_NAMES = ["Genocide memorial", "War memorial", "Archsite ossuary", "Ossuary"]


def bindings(spark, sf, classes):
    o = F.col("o_orderkey")
    coord = F.when(o % 9 > 0, F.concat(lit("Point("), lng(F.col("o_custkey")).cast("string"), lit(" "), lat(F.col("o_custkey")).cast("string"), lit(")"))).otherwise("Point(200 1)")
    return table(spark, sf, "orders").select(
        pick([c[0] for c in classes], o).alias("class_qid"), F.concat(lit("http://wd/Q"), F.col("o_custkey").cast("string")).alias("item"), pick(_G_NAMES, o % 7).alias("label"), coord.alias("coord"),
        lit("Chile").alias("country"), lit("1973-09-11T00").alias("date"), F.when(o % 2 == 0, "1901").alias("start"), F.when(o % 3 == 0, "1950-01-01").alias("end"), o.alias("row_ord"),
    )


@query(
    "N18, P19, P2, FN28, W4",
    f"""WITH b AS (SELECT o_orderkey, o_custkey, o_orderkey % 4 AS cls, {q_pick(_G_NAMES, "o_orderkey % 7")} AS nm FROM orders WHERE o_orderkey % 9 > 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY cls, o_orderkey) AS rn FROM b WHERE nm <> 'Archsite ossuary' AND (cls <> 3 OR nm = 'Genocide memorial'))
        SELECT o_orderkey AS row_ord, nm AS name, {q_pick([k for _, _, k in vocab.GRAVE_CLASSES], "cls")} AS kind, 'https://www.wikidata.org/wiki/Q' || o_custkey AS url, '1973-09-11' AS date,
          CASE WHEN cls = 0 THEN {q_snap(q_lat("o_custkey"))} ELSE round({q_lat("o_custkey")}, 4) END AS lat, CASE WHEN cls = 0 THEN {q_snap(q_lng("o_custkey"))} ELSE round({q_lng("o_custkey")}, 4) END AS lng,
          CASE WHEN cls = 0 THEN 'coarsened' ELSE 'area' END AS geo FROM k WHERE rn = 1""",
)
def normalise_graves(spark, sf):
    return normalise.graves(bindings(spark, sf, vocab.GRAVE_CLASSES)).select("row_ord", "name", "kind", "url", "date", "lat", "lng", "geo")


@query(
    "N19, W4",
    f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 4, o_orderkey) AS rn FROM orders WHERE o_orderkey % 9 > 0)
        SELECT o_orderkey AS row_ord, {q_pick(_G_NAMES, "o_orderkey % 7")} AS name, nullif(CASE WHEN o_orderkey % 6 = 0 THEN 'opened 1901, closed 1950-01-01' WHEN o_orderkey % 2 = 0 THEN 'opened 1901' WHEN o_orderkey % 3 = 0 THEN 'closed 1950-01-01' ELSE '' END, '') AS status,
          CASE WHEN o_orderkey % 3 = 0 THEN '1950-01-01' WHEN o_orderkey % 2 = 0 THEN '1901' END AS date, round({q_lat("o_custkey")}, 4) AS lat, 'exact' AS geo, 3 AS impact FROM k WHERE rn = 1""",
)
def normalise_institutions(spark, sf):
    return normalise.institutions(bindings(spark, sf, vocab.INSTITUTION_CLASSES)).select("row_ord", "name", "status", "date", "lat", "geo", "impact")


# --- N20-N22 -----------------------------------------------------------------------------------------
def facility_elements(spark, sf):
    """Orders as map elements: a type tag, sometimes a refusal, contact tags."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = pick(["museum", "crematorium", "mortuary", "grave_yard"], c)
    key = F.when(kind == "museum", "tourism").otherwise("amenity")
    tags = F.map_concat(
        F.create_map(key, kind, lit("addr:city"), F.col("o_orderpriority")),
        F.when(o % 5 == 0, F.create_map(lit("historic"), lit("yes"))).otherwise(F.create_map(lit("operator"), F.concat(lit("Op "), c.cast("string")))),
        F.when(o % 2 == 0, F.create_map(lit("contact:phone"), lit("1"), lit("addr:street"), lit("Elm"))).otherwise(F.create_map(lit("website"), lit("w"))),
    )
    return table(spark, sf, "orders").select(
        lit("node").alias("type"), o.alias("id"), lat(c).alias("lat"), lng(c).alias("lon"), lit(None).cast("struct<lat:double,lon:double>").alias("center"), tags.alias("tags"), o.alias("row_ord")
    )


Q_FACILITIES = f"""fac AS (SELECT o_orderkey AS row_ord, round({q_lat("o_custkey")}, 5) AS lat, round({q_lng("o_custkey")}, 5) AS lng, CASE WHEN o_orderkey % 5 > 0 THEN 'Op ' || o_custkey END AS name,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Elm ' || o_orderpriority ELSE o_orderpriority END AS address, CASE WHEN o_orderkey % 2 = 0 THEN '1' END AS phone,
      CASE WHEN o_orderkey % 2 = 1 THEN 'w' END AS website, {q_pick(["museum", "crematory", "mortuary", "cemetery"], "o_custkey")} AS ftype,
      CAST(floor({q_lat("o_custkey")} / 10) * 10 AS INTEGER) || '_' || CAST(floor({q_lng("o_custkey")} / 10) * 10 AS INTEGER) AS cell
    FROM orders WHERE o_orderkey % 5 > 0 OR o_custkey % 4 = 0)"""


@query("N20, P12, P13, FN25, A8", f"WITH {Q_FACILITIES} SELECT * FROM fac")
def normalise_facilities(spark, sf):
    return normalise.facilities(facility_elements(spark, sf)).drop("cell_lat", "cell_lng")


_HEAD = ["Mass graves found in Ontario &amp; beyond", "Zombie graveyard in France", "Reburial in <b>France</b> and Germany", "Market news", "Exhumación en México"]


def feed_table(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        F.concat(lit("Feed "), F.col("event_type")).alias("name"), pick(_HEAD, e).alias("title"),
        F.concat(lit("https://News.example/"), F.col("user_id").cast("string"), lit("/?e="), e.cast("string")).alias("link"),
        F.when(e % 2 == 0, "text").alias("summary"),
        F.when(e % 6 > 0, F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss")).otherwise("soon").alias("published"),
        F.when(e % 3 == 0, "en").alias("lang"), e.alias("row_ord"),
    )


def news_gazetteer(spark):
    from ...operators.joins import gazetteer_from

    return gazetteer_from(spark, {"CA": ["ontario"]}, {"MX": ["mexico"], "DE": ["germany"], "FR": ["france"]})


Q_NEWS = f"""news AS (SELECT event_id AS row_ord, 'Feed ' || event_type AS name, 'https://news.example/' || user_id AS link_key,
      CASE event_id % 5 WHEN 0 THEN 'Mass graves found in Ontario & beyond' WHEN 2 THEN 'Reburial in France and Germany' ELSE 'Exhumación en México' END AS title,
      CASE WHEN event_id % 6 > 0 THEN strftime(ts, '%Y-%m-%d') END AS date, CASE WHEN event_id % 5 < 4 THEN 2 ELSE 1 END AS sig,
      CASE event_id % 5 WHEN 0 THEN 'conflict' WHEN 2 THEN 'redress' ELSE 'other' END AS topic, CASE event_id % 5 WHEN 0 THEN 'CA' WHEN 2 THEN 'DE' ELSE 'MX' END AS iso,
      CASE event_id % 5 WHEN 0 THEN 'Ontario' END AS region, CASE WHEN event_id % 3 = 0 THEN 'en' END AS lang
    FROM events WHERE event_id % 5 IN (0, 2, 4) AND (event_id % 6 = 0 OR date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') <= 20))"""


def news_rows(spark, sf):
    return normalise.news(feed_table(spark, sf), news_gazetteer(spark), today=lit("2024-02-01").cast("date"), max_age_days=20)


@query("N21, J3, FN5, FN6, FN7, FN8, P6, P7, P8, P9, P11", f"WITH {Q_NEWS} SELECT * FROM news")
def normalise_news(spark, sf):
    return news_rows(spark, sf).select("row_ord", "name", "link_key", "title", "date", "sig", "topic", "iso", "region", "lang")


@query(
    "N22, FN27",
    "SELECT event_id AS row_ord, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'GDELT' END AS name, strftime(ts, '%Y-%m-%d') AS published FROM events",
)
def normalise_articles(spark, sf):
    raw = table(spark, sf, "events").select(
        lit("t").alias("title"), lit("u").alias("url"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("").alias("domain"), F.col("event_id").alias("row_ord")
    )
    return normalise.articles(raw).select("row_ord", "name", "published")


