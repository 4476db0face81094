"""Lookup joins, text joins, and exclusion joins.

No join here carries a broadcast hint.  Constant vocabularies are folded into the plan;
tables handed in by the caller are broadcast only when Spark's own size estimate (or
AQE's measured size) is under ``spark.sql.autoBroadcastJoinThreshold`` and are joined
by a shuffle with skew splitting beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_table
from .. import vocab
from ..functions import scalar


# --- J1 -----------------------------------------------------------------------------
def point_of(key: Column, table) -> Column:
    """Constant key -> (lat, lng) table as a column; NULL where the key is unknown."""
    lat = scalar.lookup({t[0]: t[-2] for t in table}, key)
    lng = scalar.lookup({t[0]: t[-1] for t in table}, key)
    return F.when(lat.isNotNull(), F.struct(lat.alias("lat"), lng.alias("lng")))


def state_name(code: Column, states=vocab.STATES) -> Column:
    """State name of an abbreviation, or of a full name; NULL otherwise."""
    names = {s[1]: s[1] for s in states}
    return F.coalesce(scalar.lookup({s[0]: s[1] for s in states}, F.upper(code)), scalar.lookup(names, code))


def state_point(name: Column, states=vocab.STATES) -> Column:
    return point_of(name, [(s[1], s[2], s[3]) for s in states])


def lookup_join(df: DataFrame, dim: DataFrame, on, values, defaults: dict | None = None) -> DataFrame:
    """Left join to a dimension with fallbacks for keys it does not know."""
    on = [on] if isinstance(on, str) else list(on)
    out = df.join(dim.select(*on, *values), on, "left")
    for c, d in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), d if isinstance(d, Column) else F.lit(d)))
    return out


# --- J2 -----------------------------------------------------------------------------
def gazetteer_lookup(df: DataFrame, query: Column, gazetteer: DataFrame, fallback: Column) -> DataFrame:
    """Attach ``hit`` (was the place found?) and ``at`` (its point, else ``fallback``).

    ``gazetteer`` has ``q, lat, lng``, one row per lower-case query text.  The rows pass
    once: the text work above this join is not repeated to collect distinct queries.
    Rows without a query are spread over salted keys, which match nothing, instead of
    meeting in the partition of the NULL key.
    """
    spread = F.col("row_ord") if "row_ord" in df.columns else F.monotonically_increasing_id()
    q = scalar.blank_to_null(F.lower(scalar.strip(query)))
    keyed = df.withColumn("__q", F.coalesce(q, F.concat(F.lit("\0"), F.pmod(F.xxhash64(spread), F.lit(64)).cast("string"))))
    g = gazetteer.select(F.lower("q").alias("__q"), F.struct("lat", "lng").alias("__at"))
    out = keyed.join(g, "__q", "left")
    return out.select(
        *df.columns,
        F.col("__at").isNotNull().alias("hit"),
        F.coalesce(F.col("__at"), fallback).alias("at"),
    )


# --- J3 -----------------------------------------------------------------------------
def word_runs(folded: Column, longest: int) -> Column:
    """From every word start, the run of up to ``longest`` words and one closing mark, separators kept as written.

    A look-ahead captures overlapping runs in one pass of the matcher.
    """
    run = rf"(?<![a-z])(?=([a-z]+(?:[^a-z]+[a-z]+){{0,{longest - 1}}}[^a-z\s]?))"
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(run), F.lit(1)))


def gazetteer_from(spark, regions: dict, countries: dict, names: dict | None = None) -> DataFrame:
    """Alias table from ``{iso: [alias, ...]}`` maps: regions rank before countries, and
    within each, table order is priority."""
    rows, order = [], 0
    for table, is_region in ((regions, True), (countries, False)):
        for iso, aliases in table.items():
            for a in aliases:
                order += 1
                shown = (names or vocab.REGION_NAMES).get(a, " ".join(w.capitalize() for w in a.split()))
                rows.append((scalar.fold_literal(a.strip()), iso, shown if is_region else None, order))
    return small_table(spark, rows, "alias string, iso string, region string, priority int")


def geo_tag(df: DataFrame, key, folded: Column, gazetteer: DataFrame, longest: int | None = None) -> DataFrame:
    """Add ``iso`` and ``region`` of the highest-ranked place named in a folded text.

    ``gazetteer`` has ``alias, iso, region, priority``; aliases are folded and match
    between characters other than a-z; they start with a letter and may end with one
    punctuation mark.  The texts' word runs are joined to the aliases by their first word
    and compared, so there is no text x alias loop, and the text itself is not carried along.
    ``longest`` is the number of words of the longest alias; it is read from the table (one number) unless given.
    """
    if longest is None:
        words = F.size(F.regexp_extract_all("alias", F.lit("[a-z]+"), F.lit(0)))
        longest = gazetteer.agg(F.max(words)).first()[0] or 1
    key = [key] if isinstance(key, str) else list(key)
    first = lambda c: F.regexp_extract(c, "^[a-z]+", 0)
    runs = df.select(*key, F.explode(word_runs(folded, longest)).alias("__run")).withColumn("__head", first("__run"))
    places = gazetteer.select("alias", "iso", "region", "priority", first("alias").alias("__head"))
    whole = F.startswith("__run", "alias") & ~F.substring(F.col("__run"), F.length("alias") + 1, F.lit(1)).rlike("[a-z]")
    hits = runs.join(places, "__head").filter(whole)
    best = hits.groupBy(*key).agg(F.min_by(F.struct("iso", "region"), "priority").alias("__p"))
    return df.join(best, key, "left").select(*df.columns, F.col("__p.iso").alias("iso"), F.col("__p.region").alias("region"))


# --- J4 -----------------------------------------------------------------------------
def explode_phrases(df: DataFrame, c: Column, phrases, ord_name: str = "phrase_ord") -> DataFrame:
    """One row per listed phrase the text contains: ``phrase_ord``, ``phrase``, ``label``."""
    low = df.withColumn("__low", F.lower(c))
    found = [
        F.when(
            F.contains("__low", F.lit(p.lower())),
            F.struct(F.lit(i).alias(ord_name), F.lit(p).alias("phrase"), F.lit(label).alias("label")),
        )
        for i, (p, label) in enumerate(phrases)
    ]
    return low.select(*df.columns, F.inline(F.array_compact(F.array(*found))))


# --- J6 -----------------------------------------------------------------------------
def portal_terms(
    portals: DataFrame, country: Column, cap: int | None = None, terms: dict | None = None, langs: dict | None = None
) -> DataFrame:
    """Search terms per portal: English, then the language of its country, in list order."""
    terms, langs = terms or vocab.LANG_TERMS, langs or vocab.COUNTRY_LANG
    english = F.array(*[F.lit(t) for t in terms["en"]])
    own = {k: list(v) for k, v in terms.items() if k != "en"}
    lang = scalar.lookup(langs, F.lower(scalar.strip(F.coalesce(country, F.lit("")))))
    by_lang = F.create_map(*[x for k, v in own.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))])
    full = F.concat(english, F.coalesce(F.try_element_at(by_lang, lang), F.array().cast("array<string>")))
    full = F.slice(full, 1, cap) if cap else full
    return portals.select("*", F.posexplode(full).alias("term_ord", "term"))


# --- J7-J9 --------------------------------------------------------------------------
def not_in(df: DataFrame, other: DataFrame, on) -> DataFrame:
    on = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*on), on, "left_anti")


def silent_source_rows(prior: DataFrame, fresh: DataFrame, min_rows: int = 10, by: str = "source") -> DataFrame:
    """Prior rows of sources that had at least ``min_rows`` and returned nothing now."""
    big = prior.groupBy(by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_rows).select(by)
    silent = big.join(fresh.select(by).distinct(), by, "left_anti")
    return prior.join(silent, by, "left_semi")


# --- J10 ----------------------------------------------------------------------------
def zero_triage(roster: DataFrame, counts: DataFrame, keys_set: DataFrame | None = None) -> DataFrame:
    """Sort sources that yielded nothing into expected, needs-key, upstream, unexpected.

    ``roster`` has ``source, reason``; ``counts`` has ``source, n``; ``keys_set`` lists
    the sources whose credential is present, for which a zero is unexpected after all.
    """
    zero = roster.join(counts, "source", "left").filter(F.coalesce("n", F.lit(0)) == 0)
    if keys_set is not None:
        zero = zero.join(keys_set.select("source").distinct().withColumn("__k", F.lit(True)), "source", "left")
    else:
        zero = zero.withColumn("__k", F.lit(None).cast("boolean"))
    waiting = (F.col("reason") == "needs-key") & F.coalesce("__k", F.lit(False))
    return zero.select(
        "source", F.when(waiting, "unexpected").otherwise(F.coalesce("reason", F.lit("unexpected"))).alias("triage")
    )
