"""Scans of landed payloads: JSON documents, GeoJSON, CSV, feeds, HTML tables, catalogs.

Each scan has two entry points: a reader for files and a transformation for payloads
that already sit in a text column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocab
from ..functions import geo, scalar
from ..schema import RECORD


# --- SC1, SC6, SC7: JSON documents -----------------------------------------------------
def payload_rows(v: Column, keys) -> Column:
    """Row array of a payload: the payload itself, or the first listed key that is an array."""
    tries = [F.try_variant_get(v, "$", "array<variant>")]
    tries += [F.try_variant_get(v, f"$['{k}']", "array<variant>") for k in keys]
    return F.coalesce(*tries)


def unwrap_payloads(df: DataFrame, payload: Column, keys=vocab.GRID_ROW_KEYS) -> DataFrame:
    """One variant ``row`` (with its position ``row_pos``) per element of each payload."""
    parsed = df.withColumn("__v", F.try_parse_json(payload))
    return parsed.select(*df.columns, F.posexplode(payload_rows(F.col("__v"), keys)).alias("row_pos", "row"))


def read_record_document(
    spark: SparkSession, path: str, keys=("records", "projects"), schema=RECORD, lines: bool = False
) -> DataFrame:
    """Records of a (gzipped) JSON document: a bare list or ``{"records": [...]}``.

    Such a document cannot be split.  ``lines`` reads files with one record (or one
    wrapped list) to a line, by many tasks each.
    """
    wrapped = [T.StructField(k, T.ArrayType(schema)) for k in keys]
    doc = T.StructType(list(schema.fields) + [f for f in wrapped if f.name not in schema.fieldNames()])
    raw = spark.read.schema(doc).option("multiLine", not lines).json(path)
    own = F.struct(*[F.col(f"`{n}`") for n in schema.fieldNames()])
    rows = F.coalesce(*[F.col(k) for k in keys], F.array(own))
    any_set = reduce(lambda a, b: a | b, [F.col(f"r.`{n}`").isNotNull() for n in schema.fieldNames()])
    return raw.select(F.explode(rows).alias("r")).filter(any_set).select("r.*")


def recognised(keys: Column, known=vocab.GRID_COLUMNS, at_least: int = 2) -> Column:
    """Do at least two known column names occur in the row's keys?"""
    text = F.lower(F.array_join(keys, " "))
    hits = [F.when(F.contains(text, F.lit(k)), F.lit(1)).otherwise(F.lit(0)) for k in known]
    return sum(hits[1:], hits[0]) >= at_least


def variant_keys(v: Column) -> Column:
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


def recognised_columns(columns, known=vocab.GRID_COLUMNS, at_least: int = 2) -> bool:
    text = " ".join(c.lower() for c in columns)
    return sum(k in text for k in known) >= at_least


# --- SC2: GeoJSON -----------------------------------------------------------------------
def geojson_features(df: DataFrame, payload: Column, per: int | None = None) -> DataFrame:
    """Features of each payload with a usable centre: ``feature_pos, lat, lng, props``.

    A payload is a collection or one feature.  ``per`` limits features per payload,
    counted before unusable geometries drop out.
    """
    doc = F.try_parse_json(payload)
    one = F.when(F.try_variant_get(doc, "$.type", "string") == "Feature", F.array(doc))
    feats = F.coalesce(F.try_variant_get(doc, "$.features", "array<variant>"), one)
    if per:
        feats = F.slice(feats, 1, per)
    one = df.select("*", F.posexplode(feats).alias("feature_pos", "__f"))
    centre = geo.geometry_centre(F.to_json(F.try_variant_get("__f", "$.geometry", "variant")))
    props = F.try_variant_get("__f", "$.properties", "map<string,string>")
    out = one.select(*df.columns, "feature_pos", props.alias("props"), centre.alias("__c"))
    fixed = geo.usable_point(F.col("__c.lat"), F.col("__c.lng"))
    kept = scalar.keep_where(out, {"__p": fixed}, F.col("__p").isNotNull())
    return kept.select(*df.columns, "feature_pos", "__p.lat", "__p.lng", "__p.reprojected", "props")


def read_geojson(spark: SparkSession, path: str, per: int | None = None, lines: bool = True) -> DataFrame:
    """Landed features, one to a line, so that a file is read by many tasks; ``feature_pos`` is then 0.

    With ``lines=False`` each file is one document, which one task has to hold.
    """
    docs = spark.read.text(path, wholetext=not lines).select(F.col("_metadata.file_path").alias("resource"), "value")
    return geojson_features(docs, F.col("value"), per).drop("value")


# --- SC3: CSV with overflowing rows --------------------------------------------------------
def _with_raw(columns) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*columns, "_raw")])


def _surplus(raw: Column, n: int) -> Column:
    """Fields of a raw CSV line past the ``n``-th, joined by blanks; NULL without any.

    The parser hands over the raw line of every row whose number of fields is not ``n``.
    """
    fields = F.regexp_extract_all(F.rtrim(raw, F.lit("\r\n")), F.lit(r'(?:^|,)("(?:[^"]++|"")*+"|[^,]*+)'), F.lit(1))
    past = F.slice(fields, n + 1, F.greatest(F.size(fields) - n, F.lit(0)))
    bare = F.transform(
        past, lambda x: F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
    )
    return scalar.blank_to_null(F.concat_ws(" ", F.filter(bare, lambda x: x != "")))


def read_csv_overflow(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV whose rows may have more fields than the header; the surplus, however long, is joined by
    blanks into ``_overflow``."""
    raw = (
        spark.read.schema(_with_raw(columns))
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", "_raw")
        .csv(path)
    )
    return raw.select(*[F.col(f"`{c}`") for c in columns], _surplus(F.col("_raw"), len(columns)).alias("_overflow"))


def csv_lines(df: DataFrame, line: Column, columns) -> DataFrame:
    """The same for CSV lines in a text column."""
    opts = {"columnNameOfCorruptRecord": "_raw", "escape": '"'}
    ddl = ", ".join(f"`{f.name}` STRING" for f in _with_raw(columns))
    d = df.withColumn("csv", F.from_csv(line, ddl, opts))
    return d.select(*df.columns, *[F.col(f"csv.`{c}`").alias(c) for c in columns], _surplus(F.col("csv._raw"), len(columns)).alias("_overflow"))


# --- SC4: feeds -----------------------------------------------------------------------------
def feed_entries(df: DataFrame, raw: Column) -> DataFrame:
    """RSS and Atom entries of landed feed texts."""
    blocks = F.regexp_extract_all(raw, F.lit(r"(?is)<(item|entry)\b.*?</\1>"), F.lit(0))

    def pick(*tags: str) -> Column:
        """First tag with a body (to be cleaned) or an href (taken as it is)."""
        tries = []
        for t in tags:
            body = F.get(F.regexp_extract_all("__b", F.lit(rf"(?is)<{t}[^>]*>(.*?)</{t}>"), F.lit(1)), 0)
            href = F.get(F.regexp_extract_all("__b", F.lit(rf'(?i)<{t}[^>]*href="([^"]+)"'), F.lit(1)), 0)
            for value, markup in ((body, True), (href, False)):
                tries.append(F.when(value.isNotNull(), F.struct(value.alias("v"), F.lit(markup).alias("m"))))
        return F.coalesce(*tries)

    picked = {
        "title": pick("title"),
        "link": pick("link", "id"),
        "summary": pick("description", "summary", "content"),
        "published": pick("pubDate", "published", "updated"),
    }
    one = df.select("*", F.posexplode(blocks).alias("entry_pos", "__b")).select(
        *df.columns, "entry_pos", *[v.alias(f"__{k}") for k, v in picked.items()]
    )
    raw_text = one.select(
        *df.columns,
        "entry_pos",
        *[F.col(f"__{k}.v").alias(k) for k in picked],
        *[F.coalesce(F.col(f"__{k}.m"), F.lit(False)).alias(f"__{k}_m") for k in picked],
    )
    texts = {k: F.when(F.col(f"__{k}_m"), scalar.clean(F.col(k))).otherwise(F.coalesce(k, F.lit(""))) for k in picked}
    return raw_text.select(*df.columns, "entry_pos", *[v.alias(k) for k, v in texts.items()])


def read_feed_items(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Well-formed feeds through Spark's XML source, split by ``row_tag``."""
    atom = row_tag == "entry"
    link = T.StructField("link", T.StructType([T.StructField("_href", T.StringType())]) if atom else T.StringType())
    names = ("title", "summary", "published", "updated") if atom else ("title", "description", "pubDate")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [link])
    raw = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    text = F.col("summary") if atom else F.col("description")
    when = F.coalesce("published", "updated") if atom else F.col("pubDate")
    return raw.select(
        scalar.clean(F.col("title")).alias("title"),
        (F.col("link._href") if atom else F.col("link")).alias("link"),
        scalar.clean(text).alias("summary"),
        when.alias("published"),
    )


# --- SC5: rows of HTML tables ----------------------------------------------------------------
def _cell_text(cell: Column) -> Column:
    t = F.regexp_replace(cell, "<[^>]+>", " ")
    for ref, ch in (("&amp;", "&"), ("&#39;", "'"), ("&quot;", '"')):
        t = F.replace(t, F.lit(ref), F.lit(ch))
    return scalar.strip(F.regexp_replace(t, r"(?U)\s+", " "))


def html_rows(df: DataFrame, html: Column, row_tag: str = "tr", cell_tag: str = "t[dh]") -> DataFrame:
    """Rows of a page: ``row_pos`` and the texts of its ``cells``."""
    rows = F.regexp_extract_all(html, F.lit(rf"(?is)<{row_tag}(?:\s[^>]*)?>(.*?)</{row_tag}>"), F.lit(1))
    one = df.select("*", F.posexplode(rows).alias("row_pos", "__r"))
    cells = F.regexp_extract_all("__r", F.lit(rf"(?is)<{cell_tag}(?:\s[^>]*)?>(.*?)</{cell_tag}>"), F.lit(1))
    return one.select(*df.columns, "row_pos", F.transform(cells, _cell_text).alias("cells"))


def numeric_rows(df: DataFrame) -> DataFrame:
    """Rows of at least three cells with a label and two or more plain numbers."""
    nums = F.filter(F.slice(F.col("cells"), 2, F.greatest(F.size("cells") - 1, F.lit(0))), lambda c: c.rlike(r"^[\d,]+$"))
    return (
        df.filter(F.size("cells") >= 3)
        .withColumn("__n", nums)
        .filter((F.size("__n") >= 2) & (F.element_at("cells", 1) != ""))
        .select(
            *[c for c in df.columns if c != "cells"],
            F.element_at("cells", 1).alias("label"),
            F.element_at("__n", 1).alias("first_number"),
            F.element_at("__n", 2).alias("second_number"),
        )
    )


# --- SC8: portal registries -----------------------------------------------------------------
def _only_text(v: Column, path: str) -> Column:
    at = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(v, path, "string"))


def portal_entries(df: DataFrame, entry: Column) -> DataFrame:
    """(url, country) of registry entries written as text, list or object; unusable
    entries give empty texts.  A missing scheme becomes https."""
    shape = F.schema_of_variant(entry)
    first = lambda *keys: scalar.first_present(*[_only_text(entry, f"$.{k}") for k in keys])
    url = (
        F.when(shape == "STRING", F.try_variant_get(entry, "$", "string"))
        .when(shape.startswith("ARRAY"), _only_text(entry, "$[0]"))
        .when(shape.startswith("OBJECT"), first("url", "base", "host"))
    )
    country = F.when(shape.startswith("ARRAY"), _only_text(entry, "$[1]")).when(
        shape.startswith("OBJECT"), first("country", "cc", "name")
    )
    url = scalar.strip(F.coalesce(url, F.lit("")))
    schemed = url.startswith("http://") | url.startswith("https://") | (url == "")
    return df.select(
        "*",
        F.when(schemed, url).otherwise(F.concat(F.lit("https://"), url)).alias("url"),
        scalar.strip(F.coalesce(country, F.lit(""))).alias("country"),
    )


# --- SC9: catalog search results ---------------------------------------------------------------
_RESOURCES = "array<struct<format:string,url:string>>"


def ckan_datasets(df: DataFrame, payload: Column, base: Column) -> DataFrame:
    """CKAN and DKAN: ``result.results[]`` with resources."""
    rows = F.try_variant_get(F.try_parse_json(payload), "$.result.results", "array<variant>")
    d = df.select("*", F.posexplode(rows).alias("dataset_pos", "__d"))
    g = lambda p, t="string": F.try_variant_get("__d", p, t)
    return d.select(
        *df.columns,
        "dataset_pos",
        F.coalesce(scalar.first_present(g("$.title"), g("$.name")), F.lit("")).alias("title"),
        F.coalesce(g("$.notes"), F.lit("")).alias("notes"),
        F.lit(None).cast("string").alias("geojson"),
        F.coalesce(scalar.blank_to_null(g("$.url")), base).alias("page"),
        g("$.resources", _RESOURCES).alias("resources"),
    )


def ods_datasets(df: DataFrame, payload: Column, base: Column) -> DataFrame:
    """OpenDataSoft: ``datasets[].dataset`` with an export address."""
    rows = F.try_variant_get(F.try_parse_json(payload), "$.datasets", "array<variant>")
    d = df.select("*", F.posexplode(rows).alias("dataset_pos", "__d"))
    inner = F.coalesce(F.try_variant_get("__d", "$.dataset", "variant"), F.col("__d"))
    d = d.withColumn("__d", inner)
    g = lambda p: scalar.blank_to_null(F.try_variant_get("__d", p, "string"))
    root = F.rtrim(base, F.lit("/"))
    did = g("$.dataset_id")
    return d.filter(did.isNotNull()).select(
        *df.columns,
        "dataset_pos",
        F.coalesce(g("$.metas.default.title"), did).alias("title"),
        F.coalesce(g("$.metas.default.description"), F.lit("")).alias("notes"),
        F.concat(root, F.lit("/api/v2/catalog/datasets/"), did, F.lit("/exports/geojson?limit=-1")).alias("geojson"),
        F.concat(root, F.lit("/explore/dataset/"), did, F.lit("/")).alias("page"),
        F.lit(None).cast(_RESOURCES).alias("resources"),
    )


def geonode_datasets(df: DataFrame, payload: Column, base: Column) -> DataFrame:
    """GeoNode: ``resources[]``, each layer served as GeoJSON over WFS."""
    rows = F.try_variant_get(F.try_parse_json(payload), "$.resources", "array<variant>")
    d = df.select("*", F.posexplode(rows).alias("dataset_pos", "__d"))
    g = lambda p: scalar.blank_to_null(F.try_variant_get("__d", p, "string"))
    layer = F.coalesce(g("$.alternate"), g("$.name"))
    root = F.rtrim(base, F.lit("/"))
    head = "/geoserver/wfs?service=WFS&version=2.0.0&request=GetFeature&typeNames="
    tail = "&outputFormat=application%2Fjson&srsName=EPSG%3A4326"
    return d.filter(layer.isNotNull()).select(
        *df.columns,
        "dataset_pos",
        F.coalesce(g("$.title"), layer).alias("title"),
        F.coalesce(g("$.abstract"), F.lit("")).alias("notes"),
        F.concat(root, F.lit(head), F.url_encode(layer), F.lit(tail)).alias("geojson"),
        F.coalesce(g("$.detail_url"), base).alias("page"),
        F.lit(None).cast(_RESOURCES).alias("resources"),
    )


# --- SC10, SC12: layers and shard parts -----------------------------------------------------------
def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Facility rows of a layer, single or tiled: partition columns prune the read."""
    return spark.read.parquet(path)


def read_parts(spark: SparkSession, glob: str, schema=RECORD, fmt: str = "json") -> DataFrame:
    """Shard parts matched by a glob; unreadable parts are skipped, not fatal.

    ``part`` names the file each row came from, for a coverage report.
    """
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.format(fmt).load(glob).withColumn("part", F.col("_metadata.file_path"))


def part_coverage(parts: DataFrame, glob: str | None = None, fmt: str = "json") -> DataFrame:
    """Rows by part.  With ``glob`` every listed file is reported with its ``bytes``, so nothing is skipped unseen, and
    ``lost`` tells the files that hold something of which no row could be read; a compressed empty file holds nothing.
    Only the listing is read for it, and the contents of the smallest files."""
    seen = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))
    if glob is None:
        return seen
    files = parts.sparkSession.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}*").load(glob)
    part = F.col("_metadata.file_path").alias("part")
    listed = files.select(part, F.col("length").alias("bytes"))
    hollow = files.filter(F.col("length") <= _GZIP_EMPTY).filter(_gzip_of_nothing(F.col("content"))).select(part, F.lit(True).alias("__hollow"))
    n = F.coalesce("n_rows", F.lit(0))
    lost = (n == 0) & (F.coalesce("bytes", F.lit(0)) > 0) & F.col("__hollow").isNull()
    every = listed.join(seen, "part", "full_outer").join(hollow, "part", "left")
    return every.select("part", "bytes", n.alias("n_rows"), lost.alias("lost"))


_GZIP_EMPTY = 4096  # bytes of a gzip file of nothing, with its name and comment, at most


def _gzip_of_nothing(content: Column) -> Column:
    """A gzip file ends with the checksum and the length of what it holds, both zero for nothing."""
    return (F.hex(F.substring(content, 1, 2)) == "1F8B") & (F.hex(F.substring(content, -8, 8)) == "0" * 16)


# --- SC11: findings and guides ------------------------------------------------------------------------
FINDING = (
    "kind string, place string, iso string, lat double, lng double, value double, unit string, "
    "denominator string, period string, compare string, source string, url string, note string"
)
GUIDE = (
    "serves string, title string, hook string, `when` string, "
    "steps array<struct<`do`: string, how: string, deadline: string>>, watch string, find string"
)


def explode_findings(df: DataFrame, payload: Column) -> DataFrame:
    doc = F.from_json(payload, f"findings array<struct<{_ddl_struct(FINDING)}>>")
    return df.select(F.posexplode(doc["findings"]).alias("finding_pos", "__f")).select("finding_pos", "__f.*")


def explode_guides(df: DataFrame, payload: Column) -> DataFrame:
    """Guides with one row per step; guides without steps are kept."""
    doc = F.from_json(payload, f"guides array<struct<{_ddl_struct(GUIDE)}>>")
    g = df.select(F.posexplode(doc["guides"]).alias("guide_pos", "__g")).select("guide_pos", "__g.*")
    keep = [c for c in g.columns if c != "steps"]
    return g.select(*keep, F.posexplode_outer("steps").alias("step_pos", "__s")).select(
        *keep, "step_pos", F.col("__s.do").alias("do"), F.col("__s.how").alias("how"), F.col("__s.deadline").alias("deadline")
    )


def _ddl_struct(ddl: str) -> str:
    """Column list "a t, b t" as struct fields "a: t, b: t"."""
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl))


# --- SC13: linked-data results ---------------------------------------------------------------------------
BINDING = "struct<{}>".format(
    ", ".join(
        f"`{n}`: struct<value: string>"
        for n in ("item", "itemLabel", "coord", "countryLabel", "date", "start", "end")
    )
)


def sparql_bindings(df: DataFrame, payload: Column) -> DataFrame:
    """``?item ?itemLabel ?coord ?countryLabel ?date ?start ?end`` of a result document."""
    doc = F.from_json(payload, f"results struct<bindings: array<{BINDING}>>")
    one = df.select("*", F.posexplode(doc["results"]["bindings"]).alias("binding_pos", "__b"))
    return one.select(
        *df.columns,
        "binding_pos",
        *[
            F.col(f"__b.{n}.value").alias(a)
            for n, a in (
                ("item", "item"),
                ("itemLabel", "label"),
                ("coord", "coord"),
                ("countryLabel", "country"),
                ("date", "date"),
                ("start", "start"),
                ("end", "end"),
            )
        ],
    )
