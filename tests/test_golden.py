"""Hand-written cases with known answers."""

import pytest
from pyspark.sql import functions as F

from hallowgrid import vocab
from hallowgrid.functions import geo, scalar, text
from hallowgrid.operators import joins
from hallowgrid.sources import normalise, scan


@pytest.mark.parametrize(
    "raw,day",
    [
        ("2021-05-06T10:00", "2021-05-06"), ("5/6/2021", "2021-05-06"), ("12/31/2021 x", "2021-12-31"), ("2021-05", "2021-05"),
        (" 1876 ", "1876"), ("1400", None), ("1609459200000", "2021-01-01"), ("16094592000001", None), ("soon", None), ("", None),
    ],
)
def test_partial_dates(value, raw, day):
    assert value(scalar.iso_date, raw) == day


@pytest.mark.parametrize("x", [2.675, 12.34565, -12.34565, 0.00005, 0.00015, 1.00005, 51.12345, -179.99995, 0.0, 33.33335, 1e-9])
@pytest.mark.parametrize("digits", [2, 3, 4, 5])
def test_rounding_is_exact(value, x, digits):
    assert value(lambda c: scalar.exact_round(c, digits), x) == round(x, digits)


@pytest.mark.parametrize("x", [1.0, 0.15, 0.3, 0.35, -0.05, -33.9, 89.99, -60.0, 12.3456, 179.95, -179.95, 2.0, -1.0])
def test_snap_uses_exact_floor(value, x):
    assert value(geo.snap, x) == round((x // 0.05) * 0.05 + 0.025, 4)


def test_mercator_points_come_back(value):
    p = value(geo.usable_point, 511404.0, -8250830.0)
    assert (round(p.lat, 4), round(p.lng, 4), p.reprojected) == (4.5891, -74.1185, True)
    assert value(geo.usable_point, 48.0, 2.0).reprojected is False
    assert value(geo.usable_point, 1.0, 99_999_999.0) is None


@pytest.mark.parametrize(
    "g,lat,lng",
    [
        ('{"type":"Point","coordinates":[2.5,48.5]}', 48.5, 2.5),
        ('{"type":"Point","coordinates":[2.5,48.5,100]}', 48.5, 2.5),
        ('{"type":"LineString","coordinates":[[0,0],[2,4]]}', 2.0, 1.0),
        ('{"type":"MultiPolygon","coordinates":[[[[0,0],[0,2],[2,2],[2,0]]],[[[10,10],[12,1e1]]]]}', 4.0, 26 / 6),
    ],
)
def test_geometry_centre(value, g, lat, lng):
    p = value(geo.geometry_centre, g)
    assert (p.lat, p.lng) == (pytest.approx(lat), pytest.approx(lng))


@pytest.mark.parametrize("g", ['{"type":"Point","coordinates":[]}', "{}", "not json"])
def test_geometry_without_centre(value, g):
    assert value(geo.geometry_centre, g) is None


@pytest.mark.parametrize(
    "raw,out",
    [
        ("a &amp;lt; b", "a &lt; b"), ("&#39;x&#x4E2D;&#128512;", "'x中😀"), ("<p>hi</p> &nbsp;", "hi"), ("&bogus; &copy", "&bogus; &copy"),
        ("&eacute;t&eacute;", "été"), ("plain", "plain"), ("  x\n", "x"), ("&amp;", "&"),
    ],
)
def test_clean(value, raw, out):
    assert value(scalar.clean, raw) == out


@pytest.mark.parametrize("raw", ["Fosa Común", "ŁÓDŹ szczątki", "Gräberfeld ﬁn", "ÅNGSTRÖM…", "ΝΕΚΡΟΤΑΦΕΊΟ", "nghĩa trang", "ＦＵＬＬ", "plain"])
def test_fold(value, raw):
    expected = scalar.fold_literal(raw)
    assert value(scalar.fold, raw).replace("…", "...") == expected


def test_fold_keeps_letters_that_only_look_accented(value):
    assert value(scalar.fold, "ŁØđß") == "łøđß"


@pytest.mark.parametrize(
    "raw,n",
    [
        ("Remains of at least 47 individuals", 47), ("a minimum of twenty people", 20), ("total of 1,234 sets of human remains", 1234),
        ("representing many individuals", None), ("47 individuals", None), ("AT LEAST three persons", 3),
    ],
)
def test_stated_count(value, raw, n):
    assert value(scalar.stated_count, raw) == n


@pytest.mark.parametrize(
    "raw,keep",
    [
        ("Кладбище города", True), ("temető itt", True), ("墓地の調査", True), ("The old graveyard", True), ("begraafplaats", True),
        ("CIMETIÈRE communal", True), ("repatriation", False), ("graveyards", False), ("pet cemetery opening near a tomb", False), ("cable burial depth and graves", False),
        ("carbon sequestration", False), ("La Graveyarde", False), ("", False), (None, False),
    ],
)
def test_topic_filter(value, raw, keep):
    assert value(text.on_topic, raw, types=["string"]) is keep


def test_topic_filter_with_stems(value):
    assert value(lambda c: text.on_topic(c, stem=True), "repatriation of ossuaries") is True


@pytest.mark.parametrize(
    "raw,topic",
    [
        ("Fort Nelson First Nation Aggregate Pit", "other"), ("tribe opposes casino over water quality", "other"),
        ("Tribe opposes pipeline over burial ground", "opposition"), ("skull sold at auction house", "trade"), ("mass grave found", "conflict"),
        ("museum collection", "institution"), ("tribe opposes museum", "institution"),
    ],
)
def test_news_topics(value, raw, topic):
    assert value(lambda c: text.topic(scalar.fold(c)), raw) == topic


@pytest.mark.parametrize("raw,single", [("Remains of a missing hiker identified", True), ("missing person: remains of at least 47 individuals", False), ("works", False)])
def test_individual_cases(value, raw, single):
    assert value(text.individual_case, raw) is single


@pytest.mark.parametrize(
    "raw,bad",
    [("Waahi Tapu Sites", True), ("Register of archaeological finds", True), ("archaeological sites register", True), ("carte ARCHÉOLOGIQUE", True), ("Cemetery works", False)],
)
def test_site_registers(value, raw, bad):
    assert value(text.site_register, raw) is bad


@pytest.mark.parametrize("raw,why", [("soil test", "extraction"), ("a nature trail", "infrastructure"), ("dam", "infrastructure"), ("warm", "unknown"), ("war", "conflict"), ("", "unknown")])
def test_triggers(value, raw, why):
    assert value(text.trigger, raw) == why


def test_only_state(value):
    names = [s[1] for s in vocab.STATES]
    assert value(lambda c: text.only_place(c, names), "near Ohio.") == "Ohio"
    assert value(lambda c: text.only_place(c, names), "Ohio and Iowa") is None
    assert value(lambda c: text.only_place(c, names), "in West Virginia") is None
    assert value(lambda c: text.only_place(c, names, longest=True), "in West Virginia") == "West Virginia"


@pytest.mark.parametrize(
    "raw,org",
    [("Comment submitted by Navajo Nation.", "Navajo Nation"), ("Comments from  Acme, ", "Acme"), ("Comment by abc", None), ("A letter", None)],
)
def test_comment_org(value, raw, org):
    assert value(scalar.comment_org, raw) == org


def test_facility_refusals(spark):
    rows = [
        ({"tourism": "museum", "historic": "building"}, "museum", False), ({"tourism": "museum", "historic": "tomb"}, "museum", True),
        ({"landuse": "cemetery", "historic": "archaeological_site"}, "cemetery", True), ({"LANDUSE": "Cemetery"}, "cemetery", False),
        ({"landuse": "cemetery", "was:name": "x"}, "cemetery", True), ({"shop": "bakery"}, None, False), ({}, None, False),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "i int, tags map<string,string>")
    df = df.withColumn("f", text.facility_type(F.col("tags")))
    got = {r.i: (r.f, r.x) for r in df.select("i", "f", text.refused_site(F.col("tags"), F.col("f")).alias("x")).collect()}
    assert got == {i: (f, x) for i, (_, f, x) in enumerate(rows)}


def test_geo_tag(spark):
    g = joins.gazetteer_from(
        spark, {"US": ["virginia", "west virginia"], "ES": ["andalusia", "andalucia"], "BR": ["para"]},
        {"US": ["u.s.", "american"], "CD": ["democratic republic of congo"], "FR": ["france"], "GB": ["northern ireland"]},
    )
    cases = [
        ("graves in West Virginia", "US", "Virginia"), ("Andalucía", "ES", "Andalusia"), ("the U.S. and France", "US", None),
        ("in the Democratic Republic of Congo!", "CD", None), ("frances", None, None), ("Northern  Ireland", None, None), ("restos para", "BR", "Pará"),
        ("u.s.a", None, None), ("", None, None), (None, None, None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, t string")
    got = {r.i: (r.iso, r.region) for r in joins.geo_tag(df, "i", scalar.fold(F.col("t")), g).collect()}
    assert got == {i: (a, b) for i, (_, a, b) in enumerate(cases)}


def test_portal_entries(spark):
    entries = ['"data.ajman.ae"', '["https://datos.gob.cl","Chile","cl"]', '{"base":"http://x","cc":"DE"}', "7", "[1,2]", "null"]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(entries)], "i int, e string").withColumn("v", F.parse_json("e"))
    got = {r.i: (r.url, r.country) for r in scan.portal_entries(df, F.col("v")).collect()}
    assert got == {
        0: ("https://data.ajman.ae", ""), 1: ("https://datos.gob.cl", "Chile"), 2: ("http://x", "DE"), 3: ("", ""), 4: ("", ""), 5: ("", ""),
    }


def test_notices_place_at_the_institution(spark):
    gaz = spark.createDataFrame([("Chicago, Illinois", 41.88, -87.63)], "q string, lat double, lng double")
    raw = spark.createDataFrame(
        [
            ("Notice of Inventory Completion: Field Museum, Chicago, IL", "at least 12 individuals", 1),
            ("Correction to Notice of Inventory Completion: Some Museum, Hilo, HI", None, 2),
            ("Notice of Intent to Repatriate: Nowhere Museum", None, 3),
            ("Road works, Chicago, IL", None, 4),
        ],
        "title string, abstract string, row_ord long",
    )
    for c in ("publication_date", "html_url", "comments_close_on"):
        raw = raw.withColumn(c, F.lit("2024-01-02"))
    got = [(r.kind, r.region, r.geo, r.held_by, r["count"], r.impact) for r in normalise.notices(raw, gaz).orderBy("row_ord").collect()]
    assert got == [
        ("repatriation", "Illinois", "exact", "Field Museum", 12, 2), ("repatriation", "Hawaii", "admin", "Some Museum", None, 2),
        ("review", "Hawaii", "admin", "Some Museum", None, 2),
    ]


def test_docket_filter(spark):
    raw = spark.createDataFrame(
        [("1", "Comment submitted by Navajo Nation"), ("2", "Comment submitted by Acme Mining Corporation"), ("3", "Comment by Smith Law"), ("4", "")], "id string, t string"
    ).select("id", F.struct(F.col("t").alias("title"), F.lit("doi").alias("agencyId"), F.lit("2024-01-02").alias("postedDate")).alias("attributes"))
    got = normalise.comments(raw, "NAGPRA").collect()
    assert [(r.name, r.actor, r.geo) for r in got] == [("Objection filed: Navajo Nation", "DOI", "exact")]


@pytest.mark.parametrize(
    "url,code,final,error,state",
    [
        (None, None, None, None, "find-only"), ("http://a", 200, "http://a/", None, "ok"), ("http://a", 200, "http://b", None, "redirect"), ("http://a", 403, None, None, "blocked"),
        ("http://a", 999, None, None, "blocked"), ("http://a", 404, None, None, "dead"), ("http://a", 0, None, "timed out", "dead"),
        ("https://apps.cr.nps.gov/x", 200, None, "CERTIFICATE_VERIFY_FAILED", "tls"), ("https://other/x", 200, None, "CERTIFICATE_VERIFY_FAILED", "dead"),
        ("https://apps.cr.nps.gov/x", 0, None, "CERTIFICATE_VERIFY_FAILED", "dead"),
    ],
)
def test_link_states(value, url, code, final, error, state):
    assert value(text.link_state, url, code, final, error, types=["string", "int", "string", "string"]) == state
