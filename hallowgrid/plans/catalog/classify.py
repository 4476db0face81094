"""Queries over the predicates and classifiers.

The documents are invented prose, so the vocabularies here are word pieces that occur
in it; the operators take them as arguments.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...session import small_table
from ... import vocab
from ...functions import scalar, text
from .base import STATE_NAMES, documents, pick, q_in, q_pick, query, quoted, table

lit = F.lit
_W = r"[\p{L}\p{M}\p{N}_]"
ALLOW = ("tion", r"th(?:er|on)", "sch")
DENY = ("the of", r"la\sde")
_EDGE_L, _EDGE_R = rf"(^|[^\p{{L}}\p{{M}}\p{{N}}_])", rf"($|[^\p{{L}}\p{{M}}\p{{N}}_])"


@query(
    "P1",
    rf"""SELECT doc_id, NOT regexp_matches(text, '(?i){_EDGE_L}(the of|la\sde){_EDGE_R}')
         AND (regexp_matches(text, '(?i){_EDGE_L}(tion|th(?:er|on)|sch){_EDGE_R}') OR contains(lower(text), 'écha')) AS keep FROM documents""",
)
def topic_filter(spark, sf):
    return documents(spark, sf).select(
        "doc_id", text.on_topic(F.col("text"), ALLOW, DENY, ("écha",)).alias("keep")
    )


@query(
    "P2, A8",
    r"""SELECT source, count(*) AS datasets, count(*) FILTER (regexp_matches(text, '(?i)(th\w*\s+(?:tion|er)|ha\s+th|de\s*la)')) AS refused FROM documents GROUP BY source""",
)
def site_register_refusals(spark, sf):
    bad = text.site_register(F.col("text"), (r"th[0-9A-Za-z_]*\s+(?:tion|er)", r"ha\s+th", r"de\s*la"))
    return documents(spark, sf).groupBy("source").agg(
        F.count(lit(1)).alias("datasets"), F.count_if(bad).alias("refused")
    )


@query(
    "P3",
    "SELECT conv_id, turn, (contains(lower(text), 'tion th') OR contains(lower(text), 'eau ')) AND NOT (contains(lower(text), 'inin') OR contains(lower(text), 'vi ')) AS single FROM conversations",
)
def single_case_texts(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.individual_case(F.col("text"), ("tion th", "eau "), ("inin", "vi ")).alias("single")
    )


@query(
    "P4",
    r"""SELECT doc_id, CASE WHEN regexp_matches(lower(text), '\bble(a|er)|zzz') THEN 'extraction' WHEN regexp_matches(lower(text), 'eaux|tres\b') THEN 'infrastructure'
        WHEN regexp_matches(lower(text), 'sch.n') THEN 'development' ELSE 'unknown' END AS why FROM documents""",
)
def trigger_rules(spark, sf):
    rules = ((r"\bble(a|er)|zzz", "extraction"), (r"eaux|tres\b", "infrastructure"), ("sch.n", "development"))
    return documents(spark, sf).select("doc_id", text.trigger(F.col("text"), rules).alias("why"))


@query(
    "P4",
    f"""SELECT p_partkey, {q_pick(["extraction", "infrastructure", "development", "erosion", "conflict", "looting", "extraction", "unknown"], "p_partkey")} AS why FROM part""",
)
def trigger_vocabulary(spark, sf):
    texts = ["soil survey", "a NEW rail bridge", "housing subdivision", "Coastal sea-level rise", "war", "illicit trade", "mining", "no cause"]
    t = F.concat(F.col("p_name"), lit(": "), pick(texts, F.col("p_partkey")))
    return table(spark, sf, "part").select("p_partkey", text.trigger(t).alias("why"))


@query(
    "P5, J1",
    f"""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN {q_pick(STATE_NAMES, "o_custkey")}
          WHEN o_orderkey % 3 = 1 AND {q_pick(STATE_NAMES, "o_custkey")} = {q_pick(STATE_NAMES, "o_orderkey")} THEN {q_pick(STATE_NAMES, "o_custkey")} END AS longest FROM orders)
       SELECT o_orderkey, longest, CASE WHEN longest <> 'West Virginia' THEN longest END AS strict FROM t""",
)
def only_state_named(spark, sf):
    """Both readings: "Virginia" inside "West Virginia" makes two names in the strict one."""
    c, k = pick(STATE_NAMES, F.col("o_custkey")), pick(STATE_NAMES, F.col("o_orderkey"))
    by = F.col("o_orderkey") % 3
    t = F.when(by == 0, F.concat(lit("Works in "), c, lit(", north."))).when(by == 1, F.concat(c, lit(" and "), k)).otherwise("nowhere")
    d = table(spark, sf, "orders").select("o_orderkey", t.alias("t"))
    return d.select("o_orderkey", text.only_place(F.col("t"), STATE_NAMES, longest=True).alias("longest"), text.only_place(F.col("t"), STATE_NAMES).alias("strict"))


@query(
    "P6, P7",
    """SELECT doc_id, contains(strip_accents(lower(text)), 'eaue') OR contains(strip_accents(lower(text)), 'thtion') AS allowed,
       contains(strip_accents(lower(text)), 'hedre') OR contains(strip_accents(lower(text)), 'schu') AS blocked FROM documents""",
)
def news_allow_block(spark, sf):
    d = documents(spark, sf).select("doc_id", scalar.fold(F.col("text")).alias("t"))
    return d.select(
        "doc_id", text.news_allowed(F.col("t"), ("Éaue", "thtion")).alias("allowed"), text.news_blocked(F.col("t"), ("hedre", "schu")).alias("blocked")
    )


def _q_any(col: str, terms) -> str:
    return "(" + " OR ".join(f"contains({col}, {quoted(t)})" for t in terms) + ")"


_HEADLINES = [
    "Mass graves found, exhumation began", "Tribe opposes quarry over burial ground", "Tribe opposes casino over water quality",
    "Fort Nelson First Nation Aggregate Pit housing", "Skull sold at auction house, museum says", "Ancestors returned to Māori iwi",
    "University collection inventory of funerary objects", "Halloween zombie graveyard", "Vandals desecrate cemetery", "Restitución de restos, fosa común",
]
_TOPIC_SQL = "CASE " + " ".join(
    f"WHEN {_q_any('t', terms)}"
    + (f" AND {_q_any('t', vocab.OBJECTOR_TERMS)} AND {_q_any('t', vocab.ANCESTOR_TERMS)}" if label == "opposition" else "")
    + f" THEN {quoted(label)}"
    for label, terms in vocab.NEWS_TOPICS
) + " ELSE 'other' END"


@query(
    "P6, P7, P8, P9",
    f"""WITH f AS (SELECT event_id, strip_accents(lower({q_pick(_HEADLINES, "event_id")} || ' ' || event_type)) AS t FROM events)
        SELECT event_id, {_q_any("t", vocab.NEWS_ALLOW)} AS allowed, {_q_any("t", vocab.NEWS_BLOCK)} AS blocked,
          CASE WHEN {_q_any("t", vocab.NEWS_SIGNIFICANT)} THEN 2 ELSE 1 END AS sig, {_TOPIC_SQL} AS topic FROM f""",
)
def news_vocabulary(spark, sf):
    head = F.concat(pick(_HEADLINES, F.col("event_id")), lit(" "), F.col("event_type"))
    d = table(spark, sf, "events").select("event_id", scalar.fold(head).alias("t"))
    t = F.col("t")
    return d.select(
        "event_id", text.news_allowed(t).alias("allowed"), text.news_blocked(t).alias("blocked"),
        text.significance(t).alias("sig"), text.topic(t).alias("topic"),
    )


@query(
    "P8, P9",
    """WITH f AS (SELECT doc_id, strip_accents(lower(text)) AS t FROM documents)
       SELECT doc_id, CASE WHEN contains(t, 'tionth') THEN 2 ELSE 1 END AS sig,
         CASE WHEN contains(t, 'thth') AND contains(t, 'heha') AND contains(t, 'reti') THEN 'opposition' WHEN contains(t, 'eaux') THEN 'trade'
              WHEN contains(t, 'thth') THEN 'redress' ELSE 'other' END AS topic FROM f""",
)
def document_topics(spark, sf):
    d = documents(spark, sf).select("doc_id", scalar.fold(F.col("text")).alias("t"))
    rules = (("opposition", ("thth",)), ("trade", ("eaux",)), ("redress", ("thth",)))
    return d.select(
        "doc_id", text.significance(F.col("t"), ("tionth",)).alias("sig"),
        text.topic(F.col("t"), rules, {"opposition": (("heha",), ("reti",))}).alias("topic"),
    )


_ORGS = ["Navajo Nation", "Acme Mining Corp", "Smith & Co Law", "Village of Kake", "Jane Doe", "Inter-Tribal Council"]


@query("P10", f"SELECT c_custkey, {q_pick(_ORGS, 'c_custkey')} IN ('Navajo Nation', 'Village of Kake', 'Inter-Tribal Council') AS objector FROM customer")
def objector_bodies(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.objector(pick(_ORGS, F.col("c_custkey"))).alias("objector"))


@query(
    "P11",
    "SELECT event_id, event_id % 10 = 0 OR date_diff('day', CAST(ts AS DATE), DATE '2024-01-20') <= 10 AS fresh FROM events",
)
def fresh_items(spark, sf):
    date = F.when(F.col("event_id") % 20 == 0, "undated").when(F.col("event_id") % 10 != 0, F.date_format("ts", "yyyy-MM-dd"))
    d = table(spark, sf, "events").select("event_id", date.alias("d"))
    return d.select("event_id", text.fresh_enough(F.col("d"), lit("2024-01-20").cast("date"), 10).alias("fresh"))


_TAGSETS = [
    ({"tourism": "museum", "historic": "building"}, "museum", False),
    ({"tourism": "museum", "historic": "tomb"}, "museum", True),
    ({"amenity": "crematorium"}, "crematory", False),
    ({"shop": "funeral_directors", "disused:shop": "yes"}, "mortuary", True),
    ({"Landuse": "Cemetery", "name": "X"}, "cemetery", False),
    ({"amenity": "grave_yard", "historic": "yes"}, "cemetery", True),
    ({"landuse": "cemetery", "archaeological_site": "tumulus"}, "cemetery", True),
    ({"landuse": "forest"}, None, False),
]


@query(
    "P12, P13",
    f"""SELECT c_custkey, CASE c_custkey % 8 {" ".join(f"WHEN {i} THEN {quoted(t)}" for i, (_, t, _r) in enumerate(_TAGSETS) if t)} END AS ftype,
        c_custkey % 8 IN ({", ".join(str(i) for i, (_, _t, r) in enumerate(_TAGSETS) if r)}) AS refused FROM customer""",
)
def facility_types(spark, sf):
    sets = F.array(*[F.create_map(*[lit(x) for kv in tags.items() for x in kv]) for tags, _, _ in _TAGSETS])
    tags = F.map_concat(F.element_at(sets, (F.col("c_custkey") % 8 + 1).cast("int")), F.create_map(lit("ref"), F.col("c_name")))
    d = table(spark, sf, "customer").select("c_custkey", tags.alias("tags"))
    d = d.withColumn("ftype", text.facility_type(F.col("tags")))
    return d.select("c_custkey", "ftype", text.refused_site(F.col("tags"), F.col("ftype")).alias("refused"))


_STATUS = ["Issued", "Surrendered", "REVOKED 2020", "Current", "Lapsed"]


@query(
    "P14, P15",
    f"""SELECT p_partkey, {q_pick(_STATUS, "p_partkey")} IN ('Surrendered', 'REVOKED 2020', 'Lapsed') AS dead,
        CASE WHEN p_partkey % 3 = 0 OR p_type = 'PROMO' THEN 'excavation' ELSE 'removed-ground' END AS kind FROM part""",
)
def permit_states_and_dataset_kinds(spark, sf):
    title = F.when(F.col("p_partkey") % 3 == 0, F.concat(lit("Fouilles "), F.col("p_name"))).otherwise(F.col("p_name"))
    words = F.when(F.col("p_type") == "PROMO", "site of a DIG in town").otherwise("digital register")
    return table(spark, sf, "part").select(
        "p_partkey", text.dead_permit(pick(_STATUS, F.col("p_partkey"))).alias("dead"), text.dataset_kind(title, words).alias("kind")
    )


Q_LINK = """CASE page_id % 8 WHEN 0 THEN 'find-only' WHEN 1 THEN 'ok' WHEN 2 THEN 'redirect' WHEN 3 THEN 'blocked' WHEN 4 THEN 'dead' WHEN 5 THEN 'tls'
            WHEN 6 THEN 'dead' ELSE 'ok' END"""


def link_probes(spark, sf):
    by = F.col("page_id") % 8
    url = F.when(by == 5, F.concat(lit("https://apps.cr.nps.gov/"), F.col("page_id").cast("string"))).when(by != 0, F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id",
        url.alias("url"),
        F.when(by.isin(1, 2, 5, 7), 200).when(by == 3, F.when(F.col("page_id") % 16 == 3, 403).otherwise(999)).when(by == 4, 404).otherwise(0).alias("code"),
        F.when(by == 2, "https://moved.example/").when(by == 7, F.concat(F.rtrim(url, lit("/")), lit("/"))).otherwise(url).alias("final_url"),
        F.when(by.isin(5, 6), "SSL: CERTIFICATE_VERIFY_FAILED").alias("error"),
    )


@query("P16, A4", f"WITH s AS (SELECT {Q_LINK} AS state FROM pages) SELECT r.state, count(s.state) AS n FROM (VALUES {', '.join(f'({quoted(x)})' for x in vocab.LINK_STATES)}) AS r(state) LEFT JOIN s USING (state) GROUP BY 1")
def link_state_tally(spark, sf):
    from ...operators.aggregates import state_tally

    d = link_probes(spark, sf)
    state = text.link_state(F.col("url"), F.col("code"), F.col("final_url"), F.col("error"))
    roster = small_table(spark, [(s,) for s in vocab.LINK_STATES], "state string")
    return state_tally(d.select(state.alias("state")), roster)


@query("P17", "SELECT doc_id, regexp_matches(strip_accents(lower(text)), '(^|[^a-z])tion of([^a-z]|$)') AS found FROM documents")
def bounded_words(spark, sf):
    return documents(spark, sf).select("doc_id", text.word_in(scalar.fold(F.col("text")), "tion of").alias("found"))


@query("P18", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey % 50 <> 7 GROUP BY 1")
def placed_only(spark, sf):
    from ...operators import gate
    from .base import raw_records

    d = raw_records(spark, sf).withColumns({"lat": F.col("raw_lat"), "lng": F.col("raw_lng"), "o_orderpriority": F.col("source")})
    return gate.only_placed(d).groupBy("o_orderpriority").agg(F.count(lit(1)).alias("n"))


_NAMES = ["Genocide Memorial", "War memorial", "Holocaust monument", "Village square"]


@query(
    "P19",
    f"SELECT c_custkey, c_custkey % 3 <> 0 OR {q_pick(_NAMES, 'c_custkey')} IN {q_in(['Genocide Memorial', 'Holocaust monument'])} AS keep FROM customer",
)
def memorial_subjects(spark, sf):
    kind = F.when(F.col("c_custkey") % 3 == 0, "review").otherwise("mass-grave")
    return table(spark, sf, "customer").select("c_custkey", text.memorial_subject(kind, pick(_NAMES, F.col("c_custkey"))).alias("keep"))


