"""Landed source tables to the record shape.

Every function is one lazy plan: filter, project, place, gate, rate.  The cheap and
most selective filters come first, so the text work runs on what is left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import vocab
from ..functions import geo, scalar, text
from ..operators import dedup, gate, joins
from ..session import reliable_checkpoint
from ..schema import FACILITY, NEWS, RECORD, conform, ensure_row_ord

LIT = F.lit


def _t(c: Column) -> Column:
    return F.coalesce(c.cast("string"), LIT(""))


def _record(df: DataFrame, source: str, desc, impact: int | None = None, place_at="at", geo_level="geo_level"):
    """Common tail: gate, description, rating, shape.  ``desc(note)`` gives the parts."""
    placed = gate.place(df, F.col(f"{place_at}.lat"), F.col(f"{place_at}.lng"), F.col(geo_level))
    parts = desc(scalar.note(F.col("geo")))
    out = placed.withColumns({"desc": scalar.described(None, *parts), "source": LIT(source)})
    rated = out.withColumn("impact", LIT(impact)) if impact else gate.rate(out)
    nulls = {
        c: scalar.blank_to_null(F.col(c))
        for c in ("region", "country", "held_by", "actor", "status", "url", "date", "deadline")
        if c in rated.columns
    }
    return conform(rated.withColumns(nulls), RECORD)


def _since(df: DataFrame, day: Column | None) -> DataFrame:
    """Rows dated on a day or later; a window leaves undated rows out, none keeps all."""
    return df if day is None else df.filter(F.col("date") >= day.cast("string"))


def _at(lat: float, lng: float) -> Column:
    return F.struct(LIT(float(lat)).alias("lat"), LIT(float(lng)).alias("lng"))


# --- N1, N2: federal notices -----------------------------------------------------------
def notices(raw: DataFrame, gazetteer: DataFrame, since: Column | None = None, families=vocab.NOTICE_FAMILIES) -> DataFrame:
    """Repatriation notices, plotted at the holding institution."""
    raw = ensure_row_ord(raw)
    if since is not None:
        raw = raw.filter(F.col("publication_date") >= since)
    titled = raw.withColumn("title", scalar.strip(_t(F.col("title"))))
    hits = joins.explode_phrases(titled, F.col("title"), families)
    title = F.col("title")
    head = F.when(F.contains(title, LIT(":")), F.expr("substring(title, instr(title, ':') + 1)")).otherwise(title)
    inst = F.btrim(F.regexp_replace(head, vocab.NOTICE_PLACE, ""), LIT(" ,;"))
    city = scalar.strip(F.regexp_extract(title, vocab.NOTICE_PLACE, 1))
    region = scalar.lookup({s[0]: s[1] for s in vocab.STATES}, F.regexp_extract(title, vocab.NOTICE_PLACE, 2))
    d = hits.withColumns({"inst": inst, "city": scalar.blank_to_null(city), "region": region})
    both = F.col("city").isNotNull() & F.col("region").isNotNull()
    where = F.concat_ws(", ", "city", "region")
    located = joins.gazetteer_lookup(d, F.when(both, where), gazetteer, joins.state_point(F.col("region")))
    body = F.concat_ws(" ", scalar.blank_to_null(title), scalar.blank_to_null(F.col("abstract")))
    kinds = vocab.KINDS
    out = located.filter(F.col("at").isNotNull()).withColumns(
        {
            "name": title,
            "kind": F.col("label"),
            "posture": scalar.lookup({k: v[1] for k, v in kinds.items()}, F.col("label")),
            "trigger": LIT("law"),
            "country": LIT("United States"),
            "count": scalar.stated_count(body),
            "held_by": F.col("inst"),
            "actor": F.col("inst"),
            "status": LIT(vocab.TEXT["notice_status"]),
            "url": F.col("html_url"),
            "date": scalar.iso_date(F.col("publication_date")),
            "deadline": scalar.iso_date(F.col("comments_close_on")),
            "geo_level": F.when(F.col("hit"), "exact").otherwise("admin"),
            # Families are swept one after the other, so they rank before rows.
            "row_ord": F.col("phrase_ord") * LIT(10**15) + F.pmod("row_ord", LIT(10**15)),
        }
    )
    label = scalar.lookup({k: v[0] for k, v in kinds.items()}, F.col("kind"))
    held = F.when(both, where).otherwise(F.coalesce("region", LIT("US")))
    return _record(out, "nagpra_notices", lambda n: (label, ". Held at ", held, ". ", n))


def reviews(raw: DataFrame, since: Column | None = None, topic: Column | None = None, longest: bool = False) -> DataFrame:
    """Federal notices that put burials in the path of a project, at state level."""
    raw = ensure_row_ord(raw)
    if since is not None:
        raw = raw.filter(F.col("publication_date") >= since)
    d = raw.withColumn("title", scalar.strip(_t(F.col("title"))))
    low = F.lower("title")
    d = d.filter(~reduce(lambda a, b: a | b, [low.startswith(p) for p in vocab.REVIEW_EXCLUDED_STARTS]))
    body = F.concat_ws(" ", scalar.blank_to_null(F.col("title")), scalar.blank_to_null(F.col("abstract")))
    d = scalar.keep_where(d, {"body": body}, text.on_topic(F.col("body")) if topic is None else topic)
    region = text.only_place(F.col("body"), [s[1] for s in vocab.STATES], longest)
    d = scalar.keep_where(d, {"region": region}, F.col("region").isNotNull())
    d = dedup.first_wins(d, ["document_number"], ["row_ord"])
    agency = F.try_element_at("agencies", LIT(1))["name"]
    out = d.withColumns(
        {
            "name": F.col("title"),
            "kind": LIT("review"),
            "posture": LIT("watch"),
            "trigger": text.trigger(F.col("body")),
            "country": LIT("United States"),
            "count": scalar.stated_count(F.col("body")),
            "actor": _t(agency),
            "status": LIT(vocab.TEXT["review_status"]),
            "url": F.col("html_url"),
            "date": scalar.iso_date(F.col("publication_date")),
            "deadline": scalar.iso_date(F.col("comments_close_on")),
            "at": joins.state_point(F.col("region")),
            "geo_level": LIT("admin"),
        }
    )
    return _record(out, "us_burial_reviews", lambda n: (vocab.TEXT["review_desc"], n))


# --- N3-N6 -----------------------------------------------------------------------------
def permits(features: DataFrame) -> DataFrame:
    """Heritage-harm permits; ``features`` has ``geometry`` (JSON text) and ``props``."""
    p = F.col("props")

    def alias(*names: str) -> Column:
        return scalar.strip(_t(scalar.first_key(p, *names)))

    def day(*names: str) -> Column:
        v = scalar.first_key(p, *names)
        return F.coalesce(scalar.iso_date(v), scalar.epoch_ms_date(v))

    status = alias("Status", "STATUS", "PermitStatus", "AHIPStatus")
    d = scalar.keep_where(ensure_row_ord(features), {"status0": status}, ~text.dead_permit(F.col("status0")))
    d = scalar.keep_where(d, {"at": geo.geometry_centre(F.col("geometry"))}, F.col("at").isNotNull())
    d = d.withColumns(
        {
            "permit": alias("AHIPNumber", "AHIP_NUMBER", "PermitNumber", "AHIP_No", "PERMITNO", "AHIPNo"),
            "purpose": alias("Purpose", "PURPOSE", "ActivityType", "Activity", "Description"),
            "holder": alias("Applicant", "APPLICANT", "PermitHolder", "Holder", "ProponentName"),
        }
    )
    base = F.when(F.col("permit") != "", F.concat(LIT("AHIP "), F.col("permit"))).otherwise(
        "Aboriginal Heritage Impact Permit"
    )
    has_purpose = F.col("purpose") != ""
    name = F.when(has_purpose, F.concat(base, LIT(" — "), F.col("purpose"))).otherwise(base)
    out = d.withColumns(
        {
            "name": name,
            "kind": LIT("harm-permit"),
            "posture": LIT("harm"),
            "trigger": F.when(has_purpose, text.trigger(F.col("purpose"))).otherwise("development"),
            "country": LIT("Australia"),
            "region": LIT("New South Wales"),
            "count": LIT(None).cast("int"),
            "actor": F.col("holder"),
            "status": F.coalesce(scalar.blank_to_null(F.col("status0")), LIT("Issued")),
            "url": LIT(vocab.TEXT["permit_url"]),
            "date": day("DateIssued", "IssueDate", "DATE_ISSUED"),
            "deadline": day("DateExpiry", "ExpiryDate", "DATE_EXPIRY"),
            "geo_level": LIT("area"),
        }
    )
    return _record(out, "nsw_ahip", lambda n: (vocab.TEXT["permit_desc"],))


def filings(raw: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """California filings: point, else county, else state."""
    cols = [c for c in raw.columns if c != "row_ord"]
    raw = ensure_row_ord(raw)
    all_text = F.concat_ws(" ", *[scalar.blank_to_null(F.col(f"`{c}`").cast("string")) for c in cols])
    d = scalar.keep_where(raw, {"blob": all_text}, text.on_topic(F.col("blob")))

    def alias(*names: str) -> Column:
        return scalar.strip(_t(scalar.first_column(cols, *names)))

    county = scalar.blank_to_null(alias("County", "Counties", "Lead County"))
    lat = scalar.first_column(cols, "Latitude", "Lat").try_cast("double")
    lng = scalar.first_column(cols, "Longitude", "Long", "Lng").try_cast("double")
    d = d.withColumns({"county": county, "own": F.when(lat.isNotNull() & lng.isNotNull(), geo.point(lat, lng))})
    query = F.when(F.col("own").isNull(), F.concat("county", LIT(" County, California")))
    d = joins.gazetteer_lookup(d, query, gazetteer, joins.state_point(LIT("California")))
    sch = alias("SCH Number", "SCHNumber", "SCH")
    title = scalar.strip(F.coalesce(scalar.first_column(cols, "Title", "Project Title", "ProjectTitle"), LIT("CEQA filing")))
    out = d.withColumns(
        {
            "name": title,
            "kind": LIT("review"),
            "posture": LIT("watch"),
            "trigger": text.trigger(F.col("blob")),
            "country": LIT("United States"),
            "region": LIT("California"),
            "count": scalar.stated_count(F.col("blob")),
            "actor": alias("Lead Agency", "LeadAgency", "Agency"),
            "status": LIT("In CEQA review"),
            "url": F.concat(LIT(vocab.TEXT["filing_url"]), sch),
            "date": scalar.iso_date(scalar.first_column(cols, "Received", "Date Received", "Posted", "Date")),
            "spot": F.coalesce("own", "at"),
            "geo_level": F.when(F.col("own").isNotNull(), "area").otherwise("admin"),
        }
    )
    where = F.when(F.col("county").isNotNull(), F.concat(LIT(" in "), F.col("county"), LIT(" County. "))).otherwise(". ")
    return _record(out, "ceqanet_burials", lambda n: (vocab.TEXT["filing_desc"], where, n), place_at="spot")


def planning(features: DataFrame) -> DataFrame:
    """UK planning applications on burial grounds; the gate blurs them."""
    p = F.col("props")

    def alias(*names: str) -> Column:
        return scalar.first_key(p, *names)

    d = scalar.keep_where(ensure_row_ord(features), {"blob": scalar.blob(p)}, text.on_topic(F.col("blob")))
    d = scalar.keep_where(d, {"at": geo.geometry_centre(F.col("geometry"))}, F.col("at").isNotNull())
    desc = scalar.strip(F.coalesce(alias("description", "proposal", "name"), LIT("Planning application")))
    out = d.withColumns(
        {
            "name": desc,
            "kind": LIT("exhumation"),
            "posture": LIT("harm"),
            "trigger": text.trigger(F.col("blob")),
            "country": LIT("United Kingdom"),
            "region": scalar.strip(_t(alias("area_name", "authority", "council"))),
            "count": scalar.stated_count(F.col("blob")),
            "actor": _t(alias("applicant", "agent")),
            "status": F.coalesce(alias("app_state", "status"), LIT("Application lodged")),
            "url": F.coalesce(alias("link", "url"), LIT(vocab.TEXT["planning_url"])),
            "date": scalar.iso_date(alias("start_date", "date_received", "last_changed")),
            "deadline": scalar.iso_date(alias("consultation_end_date")),
            "geo_level": LIT("area"),
        }
    )
    return _record(out, "uk_burial_planning", lambda n: (vocab.TEXT["planning_desc"], n))


def _element_point(df: DataFrame) -> Column:
    """Own coordinates, else those of the centre; a zero counts as not given."""
    return geo.point(
        F.coalesce(F.nullif("lat", LIT(0.0)), F.col("center.lat")), F.coalesce(F.nullif("lon", LIT(0.0)), F.col("center.lon"))
    )


def removed_grounds(elements: DataFrame, pairs=vocab.REMOVED_TAGS) -> DataFrame:
    """Burial grounds a map records as gone."""
    tags = F.col("tags")
    tagged = reduce(
        lambda a, b: a | b, [F.coalesce(F.try_element_at(tags, LIT(k)) == v, LIT(False)) for k, v in pairs]
    )
    d = ensure_row_ord(elements).filter(tagged).withColumn("at", _element_point(elements))
    d = d.filter(F.col("at.lat").isNotNull() & F.col("at.lng").isNotNull())
    life = F.coalesce(*[F.when(F.map_contains_key(tags, k), LIT(k.split(":")[0])) for k, _ in pairs], LIT("was"))
    name = F.coalesce(scalar.first_key(tags, "name", "old_name"), LIT("Unnamed burial ground"))
    out = d.withColumns(
        {
            "name": name,
            "kind": LIT("removed-ground"),
            "posture": LIT("harm"),
            "trigger": LIT("development"),
            "count": LIT(None).cast("int"),
            "status": F.concat(LIT("Recorded in OpenStreetMap as "), life),
            "url": F.concat_ws("/", LIT("https://www.openstreetmap.org"), F.col("type"), F.col("id").cast("string")),
            "geo_level": LIT("area"),
        }
    )
    return _record(out, "osm_removed_burial_grounds", lambda n: (vocab.TEXT["removed_desc"], n))


# --- N7-N10: open-data portals ----------------------------------------------------------
def wanted_datasets(datasets: DataFrame, metric: str | None = None, topic=None, register=None) -> DataFrame:
    """Dataset gate: registers of site locations are refused first, then the topic filter.

    Runs on the catalog side, before any feature is read or joined.
    """
    words = F.concat(_t(F.col("title")), LIT(" "), _t(F.col("notes")))
    refused = text.site_register(words) if register is None else register(words)
    if metric:
        datasets = datasets.observe(metric, F.count_if(refused).alias("refused"))
    return datasets.filter(~refused & (text.on_topic(words) if topic is None else topic(words)))


def first_geojson(resources: Column) -> Column:
    """Address of the first GeoJSON resource with a web address."""
    ok = F.filter(
        resources,
        lambda r: F.contains(F.lower(_t(r["format"])), LIT("geojson")) & F.coalesce(r["url"].startswith("http"), LIT(False)),
    )
    return F.try_element_at(ok, LIT(1))["url"]


def portal_records(datasets: DataFrame, features: DataFrame, source: str, metric: str | None = None, per: int | None = None) -> DataFrame:
    """Features of the wanted datasets as records.

    ``datasets``: title, notes, page, country, geojson, resources.  ``features``:
    ``resource, feature_pos, lat, lng, props``.  A dataset contributes all features, or its
    first ``per``; the position is known, so this is a filter, not a ranking.
    """
    link = F.coalesce(scalar.blank_to_null(F.col("geojson")), first_geojson(F.col("resources")))
    d = wanted_datasets(datasets, metric).withColumn("resource", link).filter(F.col("resource").isNotNull())
    f = features.filter(F.col("feature_pos") < per) if per else features
    both = d.select("resource", "title", "page", "country").join(
        f.select("resource", "feature_pos", "lat", "lng", "props"), "resource"
    )
    return feature_records(both, source)


def feature_records(df: DataFrame, source: str) -> DataFrame:
    words = scalar.blob(F.col("props"))
    title = _t(F.col("title"))
    name = F.coalesce(scalar.first_key(F.col("props"), "name", "NAME", "nombre", "nom", "naam", "title", "TITLE"), title)
    d = ensure_row_ord(df.withColumn("props_json", F.to_json("props")).drop("props")).withColumn(
        "props", F.from_json("props_json", "map<string,string>")
    )
    kind = text.dataset_kind(title, words)
    out = d.withColumns(
        {
            "name": name,
            "kind": kind,
            "posture": scalar.lookup({k: v[1] for k, v in vocab.KINDS.items()}, kind),
            "trigger": text.trigger(F.concat(words, LIT(" "), title)),
            "count": scalar.stated_count(words),
            "status": LIT(vocab.TEXT["portal_status"]),
            "url": F.col("page"),
            "at": geo.point(F.col("lat"), F.col("lng")),
            "geo_level": LIT("area"),
        }
    )
    return _record(out, source, lambda n: ("From “", title, "”. ", n))


# --- N11: holdings grid --------------------------------------------------------------------
def holdings_grid(raw: DataFrame, grid: str = "Inventory", label: str = "inventories") -> DataFrame:
    """Institutions with the number of individuals they still report; no state, no row."""
    cols = [c for c in raw.columns if c != "row_ord"]
    d = ensure_row_ord(raw)
    inst = scalar.strip(
        _t(
            scalar.first_column(
                cols, "Museum", "museum", "Institution", "institution", "MuseumName", "Agency", "agency",
                "Holder", "FederalAgency", "Name", "name",
            )
        )
    )
    state = scalar.strip(_t(scalar.first_column(cols, "State", "state", "StateCode", "ST")))
    named = (
        "Individuals", "individuals", "MNI", "NumberOfIndividuals", "HumanRemains",
        "CountIndividuals", "Count", "Total",
    )
    counts = [scalar.loose_int(F.nullif(F.col(f"`{n}`").cast("string"), LIT("-"))) for n in named if n in cols]
    named_and_placed = (F.col("inst") != "") & F.col("region").isNotNull()
    d = scalar.keep_where(d, {"inst": inst, "region": joins.state_name(state)}, named_and_placed)
    pending = "pending consultation or notice" if grid == "Inventory" else "reported unclaimed"
    out = d.withColumns(
        {
            "name": F.concat("inst", LIT(" — " + label)),
            "kind": LIT("holding"),
            "posture": LIT("watch"),
            "trigger": LIT("law"),
            "country": LIT("United States"),
            "count": F.coalesce(*counts) if counts else LIT(None).cast("int"),
            "held_by": F.col("inst"),
            "actor": F.col("inst"),
            "status": LIT("Reported to National NAGPRA; " + pending),
            "url": LIT(vocab.TEXT["grid_url"] + grid),
            "date": LIT(None).cast("string"),
            "deadline": LIT(None).cast("string"),
            "at": joins.state_point(F.col("region")),
            "geo_level": LIT("admin"),
        }
    )
    return _record(out, "nps_nagpra_grid", lambda n: (vocab.TEXT["grid_desc"], n))


# --- N12, N13: projects ----------------------------------------------------------------------
def _project_columns() -> dict:
    return {
        "name": F.coalesce(scalar.blank_to_null(F.col("name")), LIT("Untitled project")),
        "posture": scalar.lookup({k: v[1] for k, v in vocab.KINDS.items()}, F.col("kind")),
        "country": LIT(None).cast("string"),
        "region": F.col("state"),
        "count": LIT(None).cast("int"),
        "held_by": LIT(None).cast("string"),
        "actor": F.col("company"),
        "geo_level": F.when(F.coalesce("precise", LIT(False)), "exact").otherwise("area"),
        "from": F.coalesce(scalar.blank_to_null(F.col("source")), LIT("unknown source")),
    }


def projects_naming_graves(
    projects: DataFrame,
    phrases=vocab.PROJECT_PHRASES,
    reject=vocab.PROJECT_REJECT,
    feed: str = "the projects feed",
    limit: int = 0,
) -> DataFrame:
    """Projects whose own text names a find: reject phrases, then first phrase wins."""
    d = ensure_row_ord(projects).filter(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    low = F.lower(F.concat_ws(" ", *[_t(F.col(c)) for c in ("name", "desc", "type", "status")]))
    wanted = text.contains_any(F.col("low"), [p for p, _ in phrases]) & ~text.contains_any(F.col("low"), reject)
    d = scalar.keep_where(d, {"low": low}, wanted)
    d = d.withColumn("kind", text.first_phrase(F.col("low"), phrases))
    if limit:
        d = d.orderBy("row_ord").limit(limit)
    out = d.withColumns(_project_columns()).withColumns(
        {"trigger": LIT("permit"), "at": geo.point(F.col("lat"), F.col("lng")), "body": _t(F.col("desc"))}
    )
    return _record(
        out,
        "projects_crossfeed",
        lambda n: (scalar.strip(F.concat(LIT(f"From {feed} ("), F.col("from"), LIT("). "), F.col("body"))),),
    )


def projects_near_grounds(near: DataFrame, feed: str = "the projects feed") -> DataFrame:
    """Output of the radius join as records: a reason to look, never a finding."""
    d = ensure_row_ord(near).withColumn("kind", LIT("review"))
    out = d.withColumns(_project_columns()).withColumns(
        {"trigger": LIT("proximity"), "at": geo.point(F.col("lat"), F.col("lng"))}
    )
    ground = F.coalesce(scalar.blank_to_null(F.col("near_name")), LIT("a recorded burial ground"))
    said = F.format_string(
        vocab.TEXT["near_desc"], F.rint("dist_m").cast("bigint"), ground, LIT(feed), F.col("from")
    )
    return _record(out, "projects_on_burial_ground", lambda n: (said,), impact=2)


# --- N14-N16 ------------------------------------------------------------------------------------
def cases(raw: DataFrame, courts=vocab.COURTS, topic=None, since: Column | None = None) -> DataFrame:
    """Court cases, plotted at the court; unlisted courts at national level.  ``since`` keeps cases filed from a day on."""
    snips = F.array_join(F.transform(F.coalesce("opinions", F.array().cast("array<struct<snippet:string>>")), lambda o: _t(o["snippet"])), " ")
    named = F.concat_ws(" ", _t(F.col("caseName")), _t(F.col("suitNature")))
    d = ensure_row_ord(raw).filter(F.coalesce(F.col("cluster_id").cast("string"), LIT("")) != "")
    words = F.col("words")
    cols = {"snips": snips, "court_key": F.lower(_t(F.col("court_id"))), "words": F.concat(named, LIT(" "), snips)}
    d = scalar.keep_where(d, cols, text.on_topic(words) if topic is None else topic(words))
    d = dedup.first_wins(d, ["cluster_id"], ["row_ord"])
    at = joins.point_of(F.col("court_key"), courts)
    out = d.withColumns(
        {
            "name": F.coalesce(scalar.blank_to_null(F.col("caseName")), LIT("Unnamed case")),
            "kind": LIT("review"),
            "posture": LIT("watch"),
            "trigger": LIT("law"),
            "country": LIT("United States"),
            "region": F.col("court"),
            "count": LIT(None).cast("int"),
            "actor": F.col("court"),
            "url": F.concat(LIT("https://www.courtlistener.com"), _t(F.col("absolute_url"))),
            "date": F.col("dateFiled"),
            "at": F.coalesce(at, _at(*vocab.US_CENTRE)),
            "geo_level": F.when(at.isNotNull(), "exact").otherwise("admin"),
        }
    )
    docket = scalar.blank_to_null(F.col("docketNumber"))
    tail = scalar.blank_to_null(F.col("snips"))
    parts = (
        vocab.TEXT["case_desc"],
        F.col("court"),
        F.coalesce(F.concat(LIT(", docket "), docket), LIT("")),
        F.coalesce(F.concat(LIT(". "), scalar.strip_marks(tail)), LIT("")),
    )
    return _record(_since(out, since), "courtlistener", lambda n: parts, impact=2)


def comments(
    raw: DataFrame, term: str = "", agencies=vocab.AGENCIES, orgs=vocab.OBJECTOR_ORGS, since: Column | None = None
) -> DataFrame:
    """Objections of named bodies on federal dockets, plotted at the agency.

    ``raw`` has ``id, attributes{title, agencyId, postedDate}`` and optionally
    ``term``, the search that found the row.  ``since`` keeps comments posted from a
    day on.
    """
    if "term" not in raw.columns:
        raw = raw.withColumn("term", LIT(term))
    title = scalar.strip(_t(F.col("attributes.title")))
    d = ensure_row_ord(raw).filter(F.coalesce(F.col("id"), LIT("")) != "")
    d = scalar.keep_where(d, {"title": title}, F.col("title") != "")
    org = F.coalesce(scalar.comment_org(F.col("title")), F.col("title"))
    d = scalar.keep_where(d, {"org": org}, text.objector(F.col("org"), orgs))
    d = dedup.first_wins(d, ["id"], ["row_ord"])
    agency = F.upper(_t(F.col("attributes.agencyId")))
    at = joins.point_of(agency, agencies)
    label = F.btrim(scalar.cut_label(scalar.strip(F.col("org"))), LIT(" ,.;:-"))
    out = d.withColumns(
        {
            "name": F.concat(LIT("Objection filed: "), label),
            "kind": LIT("review"),
            "posture": LIT("watch"),
            "trigger": LIT("objection"),
            "country": LIT("United States"),
            "count": LIT(None).cast("int"),
            "actor": agency,
            "status": LIT("Comment on the public record"),
            "url": F.concat(LIT("https://www.regulations.gov/comment/"), F.col("id")),
            "date": scalar.iso_date(F.col("attributes.postedDate")),
            "at": F.coalesce(at, _at(*vocab.CAPITAL)),
            "geo_level": F.when(at.isNotNull(), "exact").otherwise("admin"),
        }
    )
    said = F.format_string(vocab.TEXT["comment_desc"], _t(F.col("term")), F.col("id"))
    return _record(_since(out, since), "tribal_comments", lambda n: (said,), impact=2)


def heritage_cases(rows: DataFrame, row: str = "row", metric: str | None = None) -> DataFrame:
    """South African cases; ``row`` is a variant with node/attributes nesting."""

    def inner(v: Column, key: str) -> Column:
        at = F.try_variant_get(v, f"$.{key}", "variant")
        return F.when(F.schema_of_variant(at).startswith("OBJECT"), at).otherwise(v)

    # One text form of the innermost object; everything else reads from it.
    base = rows.withColumn("__j", F.to_json(row)).drop(row)
    attrs = scalar.let(F.parse_json("__j"), lambda v: scalar.let(inner(v, "node"), lambda n: F.to_json(inner(n, "attributes"))))
    d = scalar.keep_where(ensure_row_ord(base), {"body": attrs}, text.on_topic(F.col("body")))
    d = scalar.keep_where(d, {"attrs": F.parse_json("body")}, F.col("attrs").isNotNull())
    v = F.col("attrs")
    d = scalar.keep_where(d, {"title": scalar.variant_text(v, "title", "name", "label")}, F.col("title").isNotNull())
    refused = text.site_register(F.col("title"))
    if metric:
        d = d.observe(metric, F.count_if(refused).alias("refused"))
    nid = scalar.variant_text(v, "nid", "id", "drupal_internal__nid")
    out = d.filter(~refused).withColumns(
        {
            "name": F.col("title"),
            "kind": LIT("review"),
            "posture": LIT("watch"),
            "trigger": LIT("permit"),
            "country": LIT("South Africa"),
            "region": scalar.variant_text(v, "field_province", "province"),
            "count": scalar.stated_count(F.col("body")),
            "actor": LIT("SAHRA"),
            "status": scalar.variant_text(v, "field_case_status", "status"),
            "url": F.concat(LIT(vocab.TEXT["sa_url"]), F.coalesce(F.concat(LIT("/node/"), nid), LIT(""))),
            "date": scalar.iso_date(scalar.variant_text(v, "created", "changed", "field_date")),
            "at": _at(*vocab.SOUTH_AFRICA),
            "geo_level": LIT("admin"),
        }
    )
    return _record(out, "sahris", lambda n: (vocab.TEXT["sa_desc"],))


# --- N17: holdings from pages ---------------------------------------------------------------------
_SUMMARY_STARTS = ("institution", "remains", "%", "total", "county")


def holding_rows(rows: DataFrame) -> DataFrame:
    """Usable institution rows: ``state, institution, not_available, made_available``.

    ``rows`` has ``state, label, first_number, second_number`` (and ``row_ord``).
    """
    low = F.lower("institution")
    header = reduce(lambda a, b: a | b, [low.startswith(p) for p in _SUMMARY_STARTS])
    name = scalar.strip(F.regexp_replace("label", r"(?U)\s+", " "))
    d = scalar.keep_where(ensure_row_ord(rows), {"institution": name}, (F.length("institution") >= 4) & ~header).withColumns(
        {"not_available": scalar.grouped_int(F.col("first_number")), "made_available": scalar.grouped_int(F.col("second_number"))}
    )
    d = d.filter(F.col("not_available") + F.col("made_available") > 0)
    d = d.select("state", "institution", "not_available", "made_available", "row_ord")
    return dedup.first_wins(d, [F.lower("institution"), "state"], ["row_ord"])


def holdings(rows: DataFrame, gazetteer: DataFrame) -> DataFrame:
    d = holding_rows(rows)
    d = joins.gazetteer_lookup(d, F.concat("institution", LIT(", "), "state"), gazetteer, joins.state_point(F.col("state")))
    d = d.filter(F.col("at").isNotNull()).withColumn("total", F.col("not_available") + F.col("made_available"))
    out = d.withColumns(
        {
            "name": F.col("institution"),
            "kind": LIT("holding"),
            "posture": LIT("watch"),
            "trigger": LIT("law"),
            "country": LIT("United States"),
            "region": F.col("state"),
            "count": F.when(F.col("not_available") > 0, F.col("not_available")).otherwise(F.col("total")),
            "held_by": F.col("institution"),
            "actor": F.col("institution"),
            "status": F.format_string("%d of %d made available for return", "made_available", "total"),
            "url": F.concat(LIT(vocab.TEXT["holding_url"]), scalar.slug(F.col("state"))),
            "geo_level": F.when(F.col("hit"), "exact").otherwise("admin"),
        }
    )
    said = F.format_string(vocab.TEXT["holding_desc"], F.col("total"), F.col("made_available"), F.col("not_available"))
    return _record(out, "propublica_holdings", lambda n: (said,))


# --- N18, N19: linked data --------------------------------------------------------------------------
def _bound(bindings: DataFrame) -> DataFrame:
    cols = {"at": geo.wkt_point(F.col("coord")), "qid": F.element_at(F.split("item", "/"), -1)}
    usable = F.col("at").isNotNull() & (F.coalesce("label", LIT("")) != "") & (F.coalesce("qid", LIT("")) != "")
    return scalar.keep_where(ensure_row_ord(bindings), cols, usable)


def graves(bindings: DataFrame, classes=vocab.GRAVE_CLASSES, metric: str | None = None) -> DataFrame:
    """Mass graves, ossuaries and massacre memorials; ``class_qid`` names the query class."""
    kind = scalar.lookup({q: k for q, _, k in classes}, F.col("class_qid"))
    d = _bound(bindings).withColumn("kind", kind).filter(F.col("kind").isNotNull())
    d = d.filter(text.memorial_subject(F.col("kind"), F.col("label")))
    refused = text.site_register(F.col("label"))
    if metric:
        d = d.observe(metric, F.count_if(refused).alias("refused"))
    d = dedup.first_wins(d.filter(~refused), ["qid"], [_class_ord(classes), "row_ord"])
    out = d.withColumns(
        {
            "name": F.col("label"),
            "posture": scalar.lookup({k: v[1] for k, v in vocab.KINDS.items()}, F.col("kind")),
            "trigger": LIT("unknown"),
            "country": _t(F.col("country")),
            "count": LIT(None).cast("int"),
            "url": F.concat(LIT("https://www.wikidata.org/wiki/"), F.col("qid")),
            "date": scalar.iso_date(F.col("date")),
            "geo_level": LIT("area"),
        }
    )
    said = F.format_string(vocab.TEXT["grave_desc"], scalar.lookup({q: n for q, n, _ in classes}, F.col("class_qid")))
    return _record(out, "wikidata_graves", lambda n: (said,))


def _class_ord(classes) -> Column:
    return F.coalesce(scalar.lookup({c[0]: i for i, c in enumerate(classes)}, F.col("class_qid")), LIT(len(classes)))


def institutions(bindings: DataFrame, classes=vocab.INSTITUTION_CLASSES) -> DataFrame:
    """Institutions under investigation for unmarked burials; the institution is plotted."""
    d = dedup.first_wins(_bound(bindings), ["qid"], [_class_ord(classes), "row_ord"])
    opened, closed = scalar.iso_date(F.col("start")), scalar.iso_date(F.col("end"))
    status = F.concat_ws(", ", F.concat(LIT("opened "), opened), F.concat(LIT("closed "), closed))
    out = d.withColumns(
        {
            "name": F.col("label"),
            "kind": LIT("review"),
            "posture": LIT("watch"),
            "trigger": LIT("institution"),
            "country": _t(F.col("country")),
            "count": LIT(None).cast("int"),
            "actor": F.col("label"),
            "status": status,
            "url": F.concat(LIT("https://www.wikidata.org/wiki/"), F.col("qid")),
            "date": F.coalesce(closed, opened),
            "geo_level": LIT("exact"),
        }
    )
    said = F.format_string(vocab.TEXT["institution_desc"], _t(scalar.lookup(dict(classes), F.col("class_qid"))))
    return _record(out, "institution_investigations", lambda n: (said,), impact=3)


# --- N20: facilities ------------------------------------------------------------------------------------
def facilities(elements: DataFrame, metric: str | Observation | None = None, deg: int = 10) -> DataFrame:
    """Map elements to facility rows, all types in one scan."""
    tags = F.col("tags")
    d = scalar.keep_where(ensure_row_ord(elements), {"ftype": text.facility_type(tags)}, F.col("ftype").isNotNull())
    d = d.withColumn("__refused", text.refused_site(tags, F.col("ftype")))
    if metric:
        d = d.observe(metric, F.count_if("__refused").alias("refused"))
    d = d.filter(~F.col("__refused"))

    def tag(*names: str) -> Column:
        return scalar.first_key(tags, *names)

    lat = F.coalesce(F.col("center.lat"), F.col("lat"))
    lng = F.coalesce(F.col("center.lon"), F.col("lon"))
    out = d.filter(lat.isNotNull() & lng.isNotNull()).select(
        scalar.exact_round(lat, 5).alias("lat"),
        scalar.exact_round(lng, 5).alias("lng"),
        tag("name", "official_name", "operator").alias("name"),
        tag("website", "contact:website").alias("website"),
        scalar.blank_to_null(
            scalar.street_address(tag("addr:housenumber"), tag("addr:street"), tag("addr:city"))
        ).alias("address"),
        tag("phone", "contact:phone").alias("phone"),
        "ftype",
        "row_ord",
    )
    cells = {
        "cell": geo.layer_cell_key(F.col("lat"), F.col("lng"), deg),
        "cell_lat": geo.layer_cell(F.col("lat"), deg),
        "cell_lng": geo.layer_cell(F.col("lng"), deg),
    }
    return conform(out.withColumns(cells), FACILITY)


# --- N21, N22: news ---------------------------------------------------------------------------------------
def articles(raw: DataFrame) -> DataFrame:
    """Article-list rows (``title, url, seendate, domain``) as feed entries."""
    day = scalar.article_day(F.col("seendate"))
    return ensure_row_ord(raw).select(
        F.coalesce(scalar.blank_to_null(F.col("domain")), LIT("GDELT")).alias("name"),
        "title",
        F.col("url").alias("link"),
        LIT("").alias("summary"),
        day.alias("published"),
        "row_ord",
    )


def news_candidates(
    entries: DataFrame,
    today: Column | None = None,
    max_age_days: int = 90,
    allow=vocab.NEWS_ALLOW,
    block=vocab.NEWS_BLOCK,
) -> DataFrame:
    """Row-local half of the news normaliser; runs unchanged on a stream.

    ``entries`` has ``name, title, link, summary, published`` and optionally ``parsed``
    (timestamp), ``lang``, ``topic``.
    """
    d = ensure_row_ord(entries)
    for c, t in (("lang", "string"), ("topic", "string"), ("parsed", "timestamp")):
        if c not in d.columns:
            d = d.withColumn(c, LIT(None).cast(t))
    d = d.filter(scalar.blank_to_null(F.col("link")).isNotNull())
    cleaned = {"full_title": scalar.clean(F.col("title")), "snippet": scalar.clean(F.col("summary"))}
    d = scalar.keep_where(d, cleaned, F.col("full_title") != "")
    folded = scalar.fold(F.concat("full_title", LIT(" "), "snippet"))
    wanted = ~text.news_blocked(F.col("folded"), block) & text.news_allowed(F.col("folded"), allow)
    d = scalar.keep_where(d, {"folded": folded}, wanted)
    date = scalar.feed_date(_t(F.col("published")), F.col("parsed"))
    fresh = text.fresh_enough(F.col("date"), F.current_date() if today is None else today, max_age_days)
    d = scalar.keep_where(d, {"date": date}, fresh)
    return d.withColumns(
        {
            "title": F.col("full_title"),
            "sig": text.significance(F.col("folded")),
            "topic": F.coalesce("topic", text.topic(F.col("folded"))),
            "link_key": scalar.link_key(F.col("link")),
        }
    )


def news(entries: DataFrame, gazetteer: DataFrame, **options) -> DataFrame:
    """Feed entries to news rows, geo-tagged.  Deduplicate with ``dedup_news``."""
    # Written once: the texts are cleaned for the tagging and for the rows together.
    d = reliable_checkpoint(entries.sparkSession, news_candidates(entries, **options).withColumn("text_key", F.sha2("folded", 256)))
    # Tag each distinct text once: copies of a story share one tagging.
    texts = d.select("text_key", "folded").groupBy("text_key").agg(F.any_value("folded").alias("folded"))
    tagged = joins.geo_tag(texts, "text_key", F.col("folded"), gazetteer)
    return conform(d.join(tagged.select("text_key", "iso", "region"), "text_key", "left"), NEWS)
