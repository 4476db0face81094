"""Queries over the scan operators."""

from __future__ import annotations

from pyspark.sql import functions as F


from ...functions import geo
from ...session import dealt, shared_dir
from ...sources import scan
from .base import q_pick, query, pick, table

lit = F.lit



@query(
    "SC1",
    """SELECT o_orderkey, 0 AS row_pos, o_orderkey AS k, o_orderpriority AS name FROM orders
       UNION ALL SELECT o_orderkey, 1, o_custkey, o_orderstatus FROM orders""",
)
def scan_record_documents(spark, sf):
    a = F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("name")))
    b = F.to_json(F.struct(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("name")))
    both = F.concat(lit("["), a, lit(","), b, lit("]"))
    doc = F.when(F.col("o_orderkey") % 2 == 0, F.concat(lit('{"_meta":{"v":1},"records":'), both, lit("}"))).otherwise(both)
    d = table(spark, sf, "orders").select("o_orderkey", doc.alias("doc"))
    rows = scan.unwrap_payloads(d, F.col("doc"), ("records", "projects"))
    return rows.select(
        "o_orderkey",
        "row_pos",
        F.variant_get("row", "$.k", "bigint").alias("k"),
        F.variant_get("row", "$.name", "string").alias("name"),
    )


_X, _Y = "((c_custkey * 7919) % 300 - 150)", "((c_custkey * 31) % 160 - 80)"


@query(
    "SC2, FN12, FN13, A9, W6, T4",
    f"""WITH f AS (
      SELECT c_custkey, 0 AS feature_pos, CAST({_Y} AS DOUBLE) AS lat, CAST({_X} AS DOUBLE) AS lng, false AS reprojected, c_mktsegment AS nm FROM customer
      UNION ALL SELECT c_custkey, 1, CAST({_Y} + 1 AS DOUBLE), CAST({_X} + 1 AS DOUBLE), false, 'square' FROM customer
      UNION ALL SELECT c_custkey, 2, (2 * atan(exp((511404 + c_custkey) / 6378137.0::DOUBLE)) - pi() / 2) * 180 / pi(),
             (-8250830.0::DOUBLE / 6378137.0::DOUBLE) * 180 / pi(), true, 'metres' FROM customer)
      SELECT c_custkey, feature_pos, round(lat, 6) AS lat, round(lng, 6) AS lng, reprojected, nm FROM f""",
)
def scan_geojson(spark, sf):
    x, y = F.expr("pmod(c_custkey * 7919, 300) - 150"), F.expr("pmod(c_custkey * 31, 160) - 80")

    def feature(kind, coords, name):
        return F.concat(
            lit('{"type":"Feature","geometry":{"type":"' + kind + '","coordinates":'), coords,
            lit('},"properties":{"name":"'), name, lit('"}}'),
        )

    def pair(a, b):
        return F.concat(lit("["), a.cast("string"), lit(","), b.cast("string"), lit("]"))

    square = F.concat(lit("[["), pair(x, y), lit(","), pair(x + 2, y), lit(","), pair(x + 2, y + 2), lit(","), pair(x, y + 2), lit("]]"))
    feats = F.concat_ws(
        ",",
        feature("Point", pair(x, y), F.col("c_mktsegment")),
        feature("Polygon", square, lit("square")),
        feature("Point", pair(lit(-8250830), F.col("c_custkey") + 511404), lit("metres")),
        feature("Point", pair(x, y), lit("beyond the cap")),
    )
    customers = dealt(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    d = customers.select("c_custkey", F.concat(lit('{"features":['), feats, lit("]}")).alias("doc"))
    out = scan.geojson_features(d, F.col("doc"), per=3)
    return out.select(
        "c_custkey", "feature_pos", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "reprojected",
        F.element_at("props", "name").alias("nm"),
    )


@query(
    "SC3",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
       CASE WHEN p_partkey % 3 <> 0 THEN p_brand || ' ' || p_type || ' ' || p_size END AS "_overflow" FROM part""",
)
def scan_csv_overflow(spark, sf):
    short = F.concat_ws(",", F.col("p_partkey").cast("string"), F.concat(lit('"'), F.col("p_name"), lit('"')))
    full = F.concat_ws(",", short, "p_brand", "p_type", F.col("p_size").cast("string"))
    d = table(spark, sf, "part").select(F.when(F.col("p_partkey") % 3 == 0, short).otherwise(full).alias("line"))
    return scan.csv_lines(d, F.col("line"), ["id", "name"]).select("id", "name", "_overflow")


@query(
    "SC4, FN7",
    """SELECT event_id, 0 AS entry_pos, event_type || ' & more' AS title, 'https://news.example/' || user_id || '?e=' || event_id AS link,
         'seen ' || user_id AS summary, strftime(ts, '%Y-%m-%d') AS published FROM events
       UNION ALL SELECT event_id, 1, 'second', 'https://atom.example/' || user_id, '', '' FROM events""",
)
def scan_feeds(spark, sf):
    item = F.concat(
        lit("<rss><channel><title>feed</title><item><title>"), F.col("event_type"), lit(" &amp; more</title><link>https://news.example/"),
        F.col("user_id").cast("string"), lit("?e="), F.col("event_id").cast("string"),
        lit("</link><description><![CDATA[]]><p>seen <b>"), F.col("user_id").cast("string"), lit("</b></p></description><pubDate>"),
        F.date_format("ts", "yyyy-MM-dd"), lit("</pubDate></item>\n<ENTRY><title>second</title><link href=\"https://atom.example/"),
        F.col("user_id").cast("string"), lit('"/></ENTRY></channel></rss>'),
    )
    d = table(spark, sf, "events").select("event_id", item.alias("raw"))
    return scan.feed_entries(d, F.col("raw")).drop("raw")


@query(
    "SC5",
    r"""WITH r AS (SELECT page_id, regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li>', 1) AS rows FROM pages),
        e AS (SELECT page_id, unnest(rows) AS row, generate_subscripts(rows, 1) - 1 AS row_pos FROM r),
        c AS (SELECT page_id, row_pos, regexp_extract_all(row, '(?is)<a(?:\s[^>]*)?>(.*?)</a>', 1) AS cells FROM e)
        SELECT page_id, CAST(row_pos AS INTEGER) AS row_pos, CAST(len(cells) AS INTEGER) AS n_cells,
          trim(regexp_replace(replace(regexp_replace(cells[1], '<[^>]+>', ' ', 'g'), '&amp;', '&'), '\s+', ' ', 'g')) AS first_cell FROM c""",
)
def scan_html_rows(spark, sf):
    rows = scan.html_rows(table(spark, sf, "pages").select("page_id", "html"), F.col("html"), "li", "a")
    return rows.select(
        "page_id", "row_pos", F.size("cells").alias("n_cells"), F.try_element_at("cells", lit(1)).alias("first_cell")
    )


@query(
    "SC5",
    """SELECT p_partkey, 1 AS row_pos, p_name AS label, p_size || ',000' AS first_number, CAST(p_partkey AS VARCHAR) AS second_number
       FROM part WHERE p_size % 2 = 0""",
)
def scan_numeric_table_rows(spark, sf):
    row = F.when(
        F.col("p_size") % 2 == 0,
        F.concat(
            lit('<tr class="d"><td><a href="#">'), F.col("p_name"), lit("</a></td><td> "), F.col("p_size").cast("string"),
            lit(",000</td><td>"), F.col("p_partkey").cast("string"), lit("</td></tr>"),
        ),
    ).otherwise("<tr><td>short</td><td>1</td></tr>")
    html = F.concat(lit("<table><tr><th>Institution</th><th>Not</th><th>Made</th></tr>\n"), row, lit("</table>"))
    d = table(spark, sf, "part").select("p_partkey", html.alias("html"))
    return scan.numeric_rows(scan.html_rows(d, F.col("html"))).select(
        "p_partkey", "row_pos", "label", "first_number", "second_number"
    )


@query("SC6", "SELECT event_id, user_id, event_type FROM events WHERE event_id % 4 <> 3")
def unwrap_payload_shapes(spark, sf):
    row = F.to_json(F.struct("user_id", "event_type"))
    rows = F.concat(lit("["), row, lit("]"))
    by = F.col("event_id") % 4
    doc = (
        F.when(by == 0, rows)
        .when(by == 1, F.concat(lit('{"draw":1,"aaData":'), rows, lit("}")))
        .when(by == 2, F.concat(lit('{"data":{"not":"a list"},"items":'), rows, lit("}")))
        .otherwise(F.concat(lit('{"unknown":'), rows, lit("}")))
    )
    d = table(spark, sf, "events").select("event_id", doc.alias("doc"))
    out = scan.unwrap_payloads(d, F.col("doc"))
    return out.select(
        "event_id",
        F.variant_get("row", "$.user_id", "bigint").alias("user_id"),
        F.variant_get("row", "$.event_type", "string").alias("event_type"),
    )


@query("SC7", "SELECT s_suppkey, s_suppkey % 3 = 1 AS usable FROM supplier")
def recognise_payload_columns(spark, sf):
    by = F.col("s_suppkey") % 3
    doc = (
        F.when(by == 0, F.to_json(F.struct(F.col("s_name").alias("Museum"), F.col("s_nationkey").alias("zz"))))
        .when(by == 1, F.to_json(F.struct(F.col("s_name").alias("MuseumName"), F.col("s_nationkey").alias("StateCode"))))
        .otherwise(F.to_json(F.struct(F.col("s_acctbal").alias("x"))))
    )
    d = table(spark, sf, "supplier").select("s_suppkey", F.parse_json(doc).alias("v"))
    # "MuseumName" alone names two known columns; one distinct known word is not enough.
    return d.select("s_suppkey", scan.recognised(scan.variant_keys(F.col("v"))).alias("usable"))


@query(
    "SC8",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 3 THEN '' WHEN 1 THEN 'https://data.example/' || c_custkey ELSE 'https://p' || c_custkey || '.example' END AS url,
       CASE c_custkey % 4 WHEN 1 THEN c_mktsegment WHEN 2 THEN 'N' || c_nationkey ELSE '' END AS country FROM customer""",
)
def portal_registry(spark, sf):
    k = F.col("c_custkey").cast("string")
    host = F.concat(lit("p"), k, lit(".example"))
    by = F.col("c_custkey") % 4
    entry = (
        F.when(by == 0, F.concat(lit('"'), host, lit('"')))
        .when(by == 1, F.concat(lit('["https://data.example/'), k, lit('","'), F.col("c_mktsegment"), lit('","xx"]')))
        .when(by == 2, F.concat(lit('{"url":"","host":"'), host, lit('","cc":"N'), F.col("c_nationkey").cast("string"), lit('"}')))
        .otherwise("42")
    )
    d = table(spark, sf, "customer").select("c_custkey", F.parse_json(entry).alias("v"))
    return scan.portal_entries(d, F.col("v")).select("c_custkey", "url", "country")


@query(
    "SC9",
    """SELECT 'ods' AS protocol, p_partkey, p_name AS title, p_brand AS notes, 'https://b.example/api/v2/catalog/datasets/d' || p_partkey || '/exports/geojson?limit=-1' AS geojson,
         'https://b.example/explore/dataset/d' || p_partkey || '/' AS page, 0 AS n_resources FROM part
       UNION ALL SELECT 'geonode', p_partkey, 'geo:l' || p_partkey, '', 'https://b.example/geoserver/wfs?service=WFS&version=2.0.0&request=GetFeature&typeNames=geo%3Al' || p_partkey
         || '&outputFormat=application%2Fjson&srsName=EPSG%3A4326', 'https://b.example/', 0 FROM part
       UNION ALL SELECT 'ckan', p_partkey, p_name, p_type, NULL, 'https://b.example/', 2 FROM part""",
)
def catalog_datasets(spark, sf):
    p = table(spark, sf, "part")
    k, base = F.col("p_partkey").cast("string"), lit("https://b.example/")
    ods = F.concat(
        lit('{"datasets":[{"dataset":{"dataset_id":"d'), k, lit('","metas":{"default":{"title":"'), F.col("p_name"),
        lit('","description":"'), F.col("p_brand"), lit('"}}}},{"dataset":{"dataset_id":""}}]}'),
    )
    node = F.concat(lit('{"resources":[{"alternate":"geo:l'), k, lit('"},{"title":"no layer"}]}'))
    ckan = F.concat(
        lit('{"result":{"results":[{"title":"","name":"'), F.col("p_name"), lit('","notes":"'), F.col("p_type"),
        lit('","resources":[{"format":"CSV","url":"http://x"},{"format":"GeoJSON","url":"http://y"}]}]}}'),
    )

    def one(protocol, fn, doc):
        d = fn(p.select("p_partkey", doc.alias("doc")), F.col("doc"), base)
        n = F.coalesce(F.size(F.coalesce("resources", F.array().cast(scan._RESOURCES))), lit(0))
        return d.select(lit(protocol).alias("protocol"), "p_partkey", "title", "notes", "geojson", "page", n.alias("n_resources"))

    return (
        one("ods", scan.ods_datasets, ods)
        .unionByName(one("geonode", scan.geonode_datasets, node))
        .unionByName(one("ckan", scan.ckan_datasets, ckan))
    )


@query(
    "SC11",
    """SELECT n_nationkey, 'looting' AS kind, n_name AS place, CAST(n_regionkey * 10.5 AS DOUBLE) AS value, 'percent' AS unit FROM nation""",
)
def explode_findings(spark, sf):
    f = F.to_json(
        F.struct(
            F.struct(F.lit("x").alias("generated")).alias("_meta"),
            F.array(
                F.struct(
                    lit("looting").alias("kind"), F.col("n_name").alias("place"), (F.col("n_regionkey") * 10.5).alias("value"),
                    lit("percent").alias("unit"), F.col("n_nationkey").cast("string").alias("note"),
                )
            ).alias("findings"),
        )
    )
    d = table(spark, sf, "nation").select(f.alias("doc"))
    out = scan.explode_findings(d, F.col("doc"))
    return out.select(F.col("note").cast("int").alias("n_nationkey"), "kind", "place", "value", "unit")


@query(
    "SC11, D5",
    """SELECT s_suppkey, s_name AS title, CASE WHEN s_suppkey % 3 > 0 THEN i END AS step_pos, CASE WHEN s_suppkey % 3 > 0 THEN 'step ' || i END AS "do",
         CASE WHEN s_suppkey % 3 > 0 AND i = 1 THEN 'day ' || s_nationkey END AS deadline
       FROM supplier, (VALUES (0), (1)) AS t(i) WHERE i = 0 OR s_suppkey % 3 > 1""",
)
def explode_guides(spark, sf):
    step0 = '{"do":"step 0","how":"h"}'
    step1 = F.concat(lit('{"do":"step 1","how":"h","deadline":"day '), F.col("s_nationkey").cast("string"), lit('"}'))
    by = F.col("s_suppkey") % 3
    steps = F.when(by == 0, lit("")).when(by == 1, lit(step0)).otherwise(F.concat(lit(step0 + ","), step1))
    doc = F.concat(
        lit('{"guides":[{"serves":"'), F.col("s_suppkey").cast("string"), lit('","title":"'), F.col("s_name"), lit('","steps":['), steps, lit("]}]}")
    )
    out = scan.explode_guides(table(spark, sf, "supplier").select(doc.alias("doc")), F.col("doc"))
    return out.select(F.col("serves").cast("bigint").alias("s_suppkey"), "title", "step_pos", "do", "deadline")


@query(
    "SC13, FN28",
    f"""SELECT c_custkey, 'https://www.wikidata.org/entity/Q' || c_custkey AS item, c_name AS label,
          CAST({_Y} AS DOUBLE) AS lat, CAST({_X} + 0.5 AS DOUBLE) AS lng, {q_pick(["1999", "2001-02-03T00:00:00Z"], "c_custkey")} AS date FROM customer""",
)
def sparql_results(spark, sf):
    x, y = F.expr("pmod(c_custkey * 7919, 300) - 150"), F.expr("pmod(c_custkey * 31, 160) - 80")

    def value(name, c):
        return F.concat(lit(f'"{name}":{{"type":"literal","value":"'), c, lit('"}'))

    b = F.concat_ws(
        ",",
        value("item", F.concat(lit("https://www.wikidata.org/entity/Q"), F.col("c_custkey").cast("string"))),
        value("itemLabel", F.col("c_name")),
        value("coord", F.concat(lit("Point("), (x + 0.5).cast("double").cast("string"), lit(" "), y.cast("string"), lit(")"))),
        value("date", pick(["1999", "2001-02-03T00:00:00Z"], F.col("c_custkey"))),
    )
    doc = F.concat(lit('{"head":{},"results":{"bindings":[{'), b, lit("}]}}"))
    out = scan.sparql_bindings(table(spark, sf, "customer").select("c_custkey", doc.alias("doc")), F.col("doc"))
    at = geo.wkt_point(F.col("coord"))
    return out.select("c_custkey", "item", "label", at["lat"].alias("lat"), at["lng"].alias("lng"), "date")




@query(
    "SC1, SC2, SC3, SC4",
    """SELECT 'records' AS reader, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, count(DISTINCT o_orderstatus) AS words FROM orders
       UNION ALL SELECT 'csv', count(*), CAST(sum(o_orderkey) AS BIGINT), count(DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN 'extra, ' || o_orderstatus || ' more' END) FROM orders
       UNION ALL SELECT 'geojson', count(*), CAST(sum(o_orderkey) AS BIGINT), count(DISTINCT o_orderstatus) FROM orders
       UNION ALL SELECT 'rss', count(*), CAST(sum(o_orderkey) AS BIGINT), count(DISTINCT o_orderstatus) FROM orders
       UNION ALL SELECT 'atom', count(*), CAST(sum(o_orderkey) AS BIGINT), count(DISTINCT o_orderstatus) FROM orders""",
)
def landed_files(spark, sf):
    """Each file reader over files landed from a table: JSON lines, CSV with surplus fields, GeoJSON lines, RSS, Atom."""
    base, k = shared_dir(spark), F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    o.select(F.concat(lit("n "), F.col("o_orderstatus")).alias("name"), k.alias("row_ord")).write.json(f"{base}/records")
    surplus = F.when(k % 3 == 0, F.concat(lit(',"extra, '), F.col("o_orderstatus"), lit('",,more'))).otherwise("")
    o.select(F.concat(k.cast("string"), lit(',"a ""b"""'), surplus).alias("value")).write.text(f"{base}/csv")
    spot = F.concat(lit('{"type":"Feature","geometry":{"type":"Point","coordinates":[10.5,20.5]},"properties":{"k":"'), k.cast("string"), lit('","s":"'), F.col("o_orderstatus"), lit('"}}'))
    o.select(spot.alias("value")).write.text(f"{base}/geojson")
    item = {"title": F.col("o_orderstatus"), "description": lit("d"), "pubDate": lit("Mon, 01 Jan 2024 00:00:00 GMT"), "link": F.concat(lit("http://x/"), k.cast("string"))}
    entry = {"title": F.col("o_orderstatus"), "summary": lit("d"), "updated": lit("2024-01-01T00:00:00Z"), "link": F.struct(item["link"].alias("_href"))}
    for name, tag, root, cols in (("rss", "item", "channel", item), ("atom", "entry", "feed", entry)):
        o.select(*[c.alias(n) for n, c in cols.items()]).write.format("xml").option("rowTag", tag).option("rootTag", root).save(f"{base}/{name}")

    def report(name, df, number, word):
        return df.agg(F.count(lit(1)).alias("n"), F.sum(number.cast("bigint")).alias("keys"), F.count_distinct(word).alias("words")).select(lit(name).alias("reader"), "n", "keys", "words")

    csv = spark.read.text(f"{base}/csv")
    link = F.regexp_extract("link", "([0-9]+)$", 1)
    parts = [
        report("records", scan.read_record_document(spark, f"{base}/records", lines=True), F.col("row_ord"), F.col("name")),
        report("csv", scan.csv_lines(csv, F.col("value"), ["id", "title"]), F.col("id"), F.col("_overflow")),
        report("geojson", scan.read_geojson(spark, f"{base}/geojson"), F.col("props")["k"], F.col("props")["s"]),
        report("rss", scan.read_feed_items(spark, f"{base}/rss"), link, F.col("title")),
        report("atom", scan.read_feed_items(spark, f"{base}/atom", "entry"), link, F.col("title")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
