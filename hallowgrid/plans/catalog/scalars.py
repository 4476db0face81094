"""Queries over the scalar and geometry functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import vocab
from ...functions import geo, scalar
from ...sources import sinks
from .base import KIND_NAMES, documents, lat, lng, pick, q_case, q_impact, q_lat, q_lng, q_pick, q_snap, query, table

lit = F.lit


@query(
    "FN1",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE o_orderpriority END)
       ELSE o_orderpriority END AS v, CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE o_orderpriority END AS m FROM orders""",
)
def first_alias(spark, sf):
    d = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("A"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("B"),
        F.col("o_orderpriority").alias("C"),
        F.create_map(
            lit("a"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority")), lit("b"), F.col("o_orderstatus")
        ).alias("props"),
    )
    return d.select(
        "o_orderkey",
        scalar.first_column(d.columns, "missing", "A", "B", "C").alias("v"),
        scalar.first_key(F.col("props"), "zz", "a", "b").alias("m"),
    )


@query(
    "FN2",
    """SELECT event_id, CASE WHEN event_id % 4 < 3 THEN event_type ELSE 'u' || user_id END AS v FROM events""",
)
def first_text_of_variant(spark, sf):
    t = F.col("event_type")
    by = F.col("event_id") % 4
    head = (
        F.when(by == 0, F.concat(lit('"title":"  '), t, lit(' "')))
        .when(by == 1, F.concat(lit('"title":[{"value":"'), t, lit('"}]')))
        .when(by == 2, F.concat(lit('"title":{"value":"'), t, lit('"}')))
        .otherwise('"title":7')
    )
    doc = F.concat(lit("{"), head, lit(',"name":{"title":"u'), F.col("user_id").cast("string"), lit('"}}'))
    d = table(spark, sf, "events").select("event_id", F.parse_json(doc).alias("v"))
    return d.select("event_id", scalar.variant_text(F.col("v"), "title", "name").alias("v"))


@query(
    "FN3",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN 2 THEN strftime(o_orderdate, '%Y-%m') WHEN 3 THEN strftime(o_orderdate, '%Y') WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d,
       CASE o_orderkey % 6 WHEN 2 THEN 'month' WHEN 3 THEN 'year' WHEN 5 THEN NULL ELSE 'day' END AS date_precision,
       CASE o_orderkey % 6 WHEN 2 THEN CAST(date_trunc('month', o_orderdate) AS DATE) WHEN 3 THEN CAST(date_trunc('year', o_orderdate) AS DATE) WHEN 5 THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS date_lo FROM orders""",
)
def partial_dates(spark, sf):
    day = F.col("o_orderdate")
    by = F.col("o_orderkey") % 6
    raw = (
        F.when(by == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(by == 1, F.date_format(day, "M/d/yyyy"))
        .when(by == 2, F.date_format(day, "yyyy-MM"))
        .when(by == 3, F.concat(lit(" "), F.date_format(day, "yyyy")))
        .when(by == 4, (F.unix_seconds(day.cast('timestamp')) * 1000).cast("string"))
        .otherwise(F.concat(lit("circa "), F.date_format(day, "yyyy")))
    )
    # Epochs before 2001-09-09 have twelve digits; shift those rows past it by using ISO.
    raw = F.when((by == 4) & (F.length(raw) != 13), F.date_format(day, "yyyy-MM-dd")).otherwise(raw)
    d = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    d = d.select("o_orderkey", scalar.iso_date(F.col("raw")).alias("d"))
    lo, precision = scalar.date_bounds(F.col("d"))
    return d.select("o_orderkey", "d", precision.alias("date_precision"), lo.alias("date_lo"))


@query(
    "FN4",
    "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS d FROM events",
)
def epoch_dates(spark, sf):
    by = F.col("event_id") % 3
    raw = F.when(by == 0, F.unix_millis(F.col('ts').cast('timestamp')).cast("string")).when(by == 1, F.concat(F.unix_millis(F.col('ts').cast('timestamp')).cast("string"), lit(".5"))).otherwise("-5")
    d = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return d.select("event_id", scalar.epoch_ms_date(F.col("raw")).alias("d"))


@query(
    "FN5",
    "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS d FROM events",
)
def feed_dates(spark, sf):
    by = F.col("event_id") % 4
    text = (
        F.when(by == 0, F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss 'GMT'"))
        .when(by == 1, F.concat(lit("updated "), F.date_format("ts", "yyyy-MM-dd HH:mm")))
        .otherwise("yesterday")
    )
    d = table(spark, sf, "events").select("event_id", text.alias("p"), F.when(by == 2, F.col("ts")).alias("parsed"))
    return d.select("event_id", scalar.feed_date(F.col("p"), F.col("parsed")).alias("d"))


@query("FN6", "SELECT doc_id, md5(strip_accents(lower(text))) AS folded FROM documents")
def fold_texts(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5(scalar.fold(F.col("text"))).alias("folded"))


@query(
    "FN7",
    """SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
         '<[^>]+>', '', 'g'), E' \\t\\n\\r')) AS cleaned FROM pages""",
)
def clean_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(scalar.clean(F.col("html"))).alias("cleaned"))


@query(
    "FN8",
    """SELECT p_partkey, CASE p_name WHEN 'red widget' THEN 'Red-Widget!' ELSE array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(w[1]) || lower(substring(w, 2))), ' ') END AS shown FROM part""",
)
def titlecase_names(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", scalar.titlecase(F.col("p_name"), {"red widget": "Red-Widget!"}).alias("shown")
    )


@query("FN9", "SELECT p_partkey, replace(lower(p_name || ', ' || p_brand || '.'), ' ', '-').replace(',', '').replace('.', '') AS slug FROM part")
def name_slugs(spark, sf):
    return table(spark, sf, "part").select("p_partkey", scalar.slug(F.concat("p_name", lit(", "), "p_brand", lit("."))).alias("slug"))


@query(
    "FN10",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey + 1000000 END AS n, CAST(floor(o_totalprice) AS BIGINT) AS loose FROM orders",
)
def grouped_integers(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, "12.5").otherwise(
        F.concat(lit(" "), F.format_number(F.col("o_orderkey") + 1000000, 0))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", scalar.grouped_int(text).alias("n"), scalar.loose_int(F.format_number("o_totalprice", 2)).alias("loose")
    )


@query(
    "FN11",
    "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment || ' ' || c_custkey END AS org FROM customer",
)
def comment_organisations(spark, sf):
    by = F.col("c_custkey") % 3
    title = (
        F.when(by == 0, F.concat(lit(" Comment submitted by "), F.col("c_name"), lit(". ")))
        .when(by == 1, F.concat(lit("Late COMMENTS from  "), F.col("c_mktsegment"), lit(" "), F.col("c_custkey").cast("string"), lit(",;")))
        .otherwise(F.concat(lit("Comment by me, "), lit("\n"), F.col("c_name")))
    )
    d = table(spark, sf, "customer").select("c_custkey", title.alias("title"))
    return d.select("c_custkey", scalar.comment_org(F.col("title")).alias("org"))


@query(
    "FN13",
    f"""WITH p AS (SELECT c_custkey, {q_lat("c_custkey")} * (CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 100000 END) AS y,
          {q_lng("c_custkey")} * (CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 150000 END) AS x FROM customer),
        m AS (SELECT c_custkey, y, x, (2 * atan(exp(y / 6378137.0::DOUBLE)) - pi() / 2) * 180 / pi() AS my, x / 6378137.0::DOUBLE * 180 / pi() AS mx FROM p)
        SELECT c_custkey, round(CASE WHEN abs(y) <= 90 AND abs(x) <= 180 THEN y WHEN abs(my) <= 90 AND abs(mx) <= 180 THEN my END, 6) AS lat,
          round(CASE WHEN abs(y) <= 90 AND abs(x) <= 180 THEN x WHEN abs(my) <= 90 AND abs(mx) <= 180 THEN mx END, 6) AS lng FROM m""",
)
def repair_coordinates(spark, sf):
    by = F.col("c_custkey") % 2 == 0
    d = table(spark, sf, "customer").select(
        "c_custkey",
        (lat(F.col("c_custkey")) * F.when(by, 1).otherwise(100000)).alias("y"),
        (lng(F.col("c_custkey")) * F.when(by, 1).otherwise(150000)).alias("x"),
    )
    p = geo.usable_point(F.col("y"), F.col("x"))
    return d.select("c_custkey", F.round(p["lat"], 6).alias("lat"), F.round(p["lng"], 6).alias("lng"))


@query("FN14", f"SELECT o_orderkey, {q_snap(q_lat('o_orderkey'))} AS lat, {q_snap(q_lng('o_orderkey'))} AS lng FROM orders")
def coarsen_points(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", geo.snap(lat(k)).alias("lat"), geo.snap(lng(k)).alias("lng"))


@query(
    "FN15, FN16",
    f"""SELECT ci, cj, key, count(*) AS n FROM (SELECT CAST(floor({q_lat("o_orderkey")} / 2.5) AS BIGINT) AS ci, CAST(floor({q_lng("o_orderkey")} / 2.5) AS BIGINT) AS cj,
        CAST(floor({q_lat("o_orderkey")} / 10) * 10 AS INTEGER) || '_' || CAST(floor({q_lng("o_orderkey")} / 10) * 10 AS INTEGER) AS key FROM orders) GROUP BY ALL""",
)
def grid_cells(spark, sf):
    y, x = lat(F.col("o_orderkey")), lng(F.col("o_orderkey"))
    cells = table(spark, sf, "orders").select(
        geo.cell_index(y, 2.5).alias("ci"), geo.cell_index(x, 2.5).alias("cj"), geo.layer_cell_key(y, x).alias("key")
    )
    return cells.groupBy("ci", "cj", "key").agg(F.count(lit(1)).alias("n"))


@query(
    "FN17",
    f"""WITH p AS (SELECT o_orderkey, {q_lat("o_orderkey")} AS a, {q_lng("o_orderkey")} AS b, {q_lat("o_custkey")} AS c, {q_lng("o_custkey")} AS d FROM orders),
        g AS (SELECT *, CASE WHEN d - b > 180 THEN d - b - 360 WHEN d - b < -180 THEN d - b + 360 ELSE d - b END AS dl FROM p)
        SELECT o_orderkey, round(sqrt(((c - a) * 111320) ** 2 + (dl * 111320 * cos(radians((a + c) / 2))) ** 2), 3) AS m FROM g""",
)
def distances(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").select("o_orderkey", F.round(geo.metres(lat(k), lng(k), lat(c), lng(c)), 3).alias("m"))


@query(
    "FN18",
    f"""SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN 1000 + p_size
        WHEN 2 THEN {q_case(vocab.NUMBER_WORDS, q_pick(list(vocab.NUMBER_WORDS), "p_size"))} END AS INTEGER) AS n FROM part""",
)
def stated_counts(spark, sf):
    size, by = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    words = pick(list(vocab.NUMBER_WORDS), F.col("p_size"))
    text = (
        F.when(by == 0, F.concat(lit("Remains of At least "), size, lit("  individuals were found")))
        .when(by == 1, F.concat(lit("a total of 1,0"), F.lpad(size, 2, "0"), lit(" sets of human remains")))
        .when(by == 2, F.concat(lit("representing "), words, lit(" people")))
        .otherwise(F.concat(lit("about "), size, lit(" individuals; at least some persons")))
    )
    d = table(spark, sf, "part").select("p_partkey", text.alias("t"))
    return d.select("p_partkey", scalar.stated_count(F.col("t")).alias("n"))


@query("FN19, FN20", f"SELECT o_orderkey, {q_impact(q_pick(KIND_NAMES, 'o_custkey'), 'nullif((o_orderkey * 31) % 700, 0)')} AS impact FROM orders")
def impact_ratings(spark, sf):
    n = F.nullif(F.pmod(F.col("o_orderkey") * 31, lit(700)), lit(0))
    return table(spark, sf, "orders").select("o_orderkey", scalar.impact(pick(KIND_NAMES, F.col("o_custkey")), n).alias("impact"))


@query(
    "FN21",
    "SELECT page_id, lower(rtrim(string_split(url, '?')[1], '/')) AS link_key FROM pages",
)
def link_keys(spark, sf):
    return table(spark, sf, "pages").select("page_id", scalar.link_key(F.col("url")).alias("link_key"))


@query(
    "FN22, FN23",
    """SELECT s_suppkey, s_name || CASE WHEN s_suppkey % 2 = 0 THEN ' n' || s_nationkey ELSE '' END AS blob,
       left('Held by ' || s_name || '. ' || 'Plotted at the named institution or address.', 60) AS descr FROM supplier""",
)
def text_blobs(spark, sf):
    props = F.create_map(
        lit("name"), F.col("s_name"), lit("gap"), lit(""),
        lit("nation"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(lit("n"), F.col("s_nationkey").cast("string"))),
    )
    d = table(spark, sf, "supplier").select("s_suppkey", "s_name", props.alias("props"))
    return d.select(
        "s_suppkey",
        scalar.blob(F.col("props")).alias("blob"),
        scalar.described(60, "Held by ", F.col("s_name"), ". ", scalar.note(lit("exact"))).alias("descr"),
    )


@query(
    "FN24",
    f"""SELECT o_orderkey, round({q_lat("o_orderkey")}, 4) AS lat, strftime(o_orderdate, '%Y-%m-%d') AS date,
        nullif(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END, '') AS status, left(repeat(o_orderpriority || ' ', 40), 200) AS "desc" FROM orders""",
)
def slim_records(spark, sf):
    d = table(spark, sf, "orders").select(
        "o_orderkey", lat(F.col("o_orderkey")).alias("lat"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("date"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("status"),
        F.repeat(F.concat("o_orderpriority", lit(" ")), lit(40)).alias("desc"),
    )
    return sinks.slim(d, desc_chars=200)


@query(
    "FN25",
    """SELECT c_custkey, trim(trim(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END || ' ' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment || ' St' END)
       || ' ' || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'City' END) AS address FROM customer""",
)
def street_addresses(spark, sf):
    k = F.col("c_custkey")
    hn = F.when(k % 3 == 0, "").otherwise(k.cast("string"))
    st = F.when(k % 4 != 0, F.concat("c_mktsegment", lit(" St")))
    city = F.when(k % 5 == 0, "").otherwise("City")
    return table(spark, sf, "customer").select("c_custkey", scalar.street_address(hn, st, city).alias("address"))


@query(
    "FN26",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_name || ' Regarding' ELSE 'Our comment on it' END AS label FROM customer""",
)
def cut_labels(spark, sf):
    by = F.col("c_custkey") % 3
    label = (
        F.when(by == 0, F.concat("c_name", lit(" regarding the plan on proposed works")))
        # list order, not text order: " comment" is tried before " regarding"
        .when(by == 1, F.concat("c_name", lit(" Regarding Comment 5")))
        .otherwise("Our comment on it")
    )
    d = table(spark, sf, "customer").select("c_custkey", label.alias("l"))
    return d.select("c_custkey", scalar.cut_label(F.col("l")).alias("label"))


@query("FN27", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS d FROM events")
def article_days(spark, sf):
    raw = F.when(F.col("event_id") % 5 == 0, F.date_format("ts", "yyyyMM")).otherwise(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
    return table(spark, sf, "events").select("event_id", scalar.article_day(raw).alias("d"))


@query(
    "FN28",
    f"SELECT c_custkey, CASE WHEN c_custkey % 6 > 1 THEN {q_lat('c_custkey')} END AS lat, CASE WHEN c_custkey % 6 > 1 THEN {q_lng('c_custkey')} END AS lng FROM customer",
)
def wkt_points(spark, sf):
    k = F.col("c_custkey")
    good = F.concat(lit("Point("), lng(k).cast("string"), lit(" "), lat(k).cast("string"), lit(")"))
    text = F.when(k % 6 == 0, "Point(181 10)").when(k % 6 == 1, "LineString(1 2)").otherwise(good)
    d = table(spark, sf, "customer").select("c_custkey", text.alias("w"))
    at = geo.wkt_point(F.col("w"))
    return d.select("c_custkey", at["lat"].alias("lat"), at["lng"].alias("lng"))


@query(
    "D3",
    f"""WITH v AS (SELECT c_custkey, i, {q_lng("c_custkey")} + i AS x FROM customer, (VALUES (0), (1), (2)) t(i)),
        w AS (SELECT c_custkey, i, CASE WHEN x > 180 THEN x - 360 ELSE x END AS x FROM v),
        s AS (SELECT c_custkey, count(*) FILTER (x > 0) AS e, count(*) FILTER (x < 0) AS wst, max(x) - min(x) AS wide FROM w GROUP BY 1)
        SELECT c_custkey, round(sum(CASE WHEN wide > 180 AND e > 0 AND wst > 0 AND e >= wst AND x < 0 THEN x + 360
          WHEN wide > 180 AND e > 0 AND wst > 0 AND e < wst AND x > 0 THEN x - 360 ELSE x END) / 3, 6) AS mean_lng, bool_or(wide > 180 AND e > 0 AND wst > 0) AS spans
        FROM w JOIN s USING (c_custkey) GROUP BY 1""",
)
def unwrap_antimeridian(spark, sf):
    k = F.col("c_custkey")

    def vertex(i):
        x = lng(k) + i
        return geo.point(lat(k), F.when(x > 180, x - 360).otherwise(x))

    d = table(spark, sf, "customer").select("c_custkey", F.array(*[vertex(i) for i in range(3)]).alias("v"))
    d = d.withColumn("u", geo.unwrap_antimeridian(F.col("v")))
    return d.select("c_custkey", F.round(geo.vertex_mean(F.col("u"))["lng"], 6).alias("mean_lng"), (F.col("u") != F.col("v")).alias("spans"))
