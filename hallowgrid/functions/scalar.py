"""Scalar column functions.  All are built from JVM-side expressions."""

from __future__ import annotations

import html.entities
import json
import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab

WS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression captured by a lambda is evaluated again for every element; binding
    it to a lambda variable first avoids that.
    """
    return F.get(F.transform(F.array(value), body), 0)


def keep_where(df: DataFrame, cols: dict, cond: Column) -> DataFrame:
    """Add ``cols`` and keep the rows where ``cond`` (over them) holds, computing each once.

    The optimizer pushes a filter below a projection by copying the projected
    expressions into it, once per reference and again for the output.  For parsed
    documents and scanned texts that multiplies the dearest work of the plan.  A
    per-partition value in the projection keeps the filter above it.
    """
    sealed = df.withColumns({**cols, "__part": F.spark_partition_id()})
    return sealed.filter((F.col("__part") >= 0) & cond).drop("__part")


def literal_map(d: dict) -> Column:
    """A small constant map; the optimizer folds it, nothing is joined or shipped.

    Written as one JSON literal: building it entry by entry costs a driver round trip
    per value.
    """
    kinds = {type(v) for v in d.values()}
    value = "string" if kinds <= {str} else "int" if kinds <= {int} else "double"
    return F.from_json(F.lit(json.dumps(d)), f"map<string,{value}>")


def lookup(d: dict, key: Column) -> Column:
    """Constant lookup; NULL where the key is absent."""
    return F.try_element_at(literal_map(d), key)


# --- FN1, FN2, FN22: picking values out of rows, maps and variants ----------------------
def first_present(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def first_column(have, *names: str) -> Column:
    """First non-empty of the named columns that exist in ``have`` (list of names)."""
    present = [F.col(f"`{n}`").cast("string") for n in names if n in set(have)]
    return first_present(*present) if present else F.lit(None).cast("string")


def first_key(m: Column, *names: str) -> Column:
    return first_present(*[F.try_element_at(m, F.lit(n)) for n in names])


def variant_text(v: Column, *keys: str) -> Column:
    """First usable string of ``keys``: a string, ``[{value}]`` or ``{value}``."""

    def at(path: str) -> Column:
        is_text = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
        return F.when(is_text, blank_to_null(strip(F.try_variant_get(v, path, "string"))))

    tries = []
    for k in keys:
        p = f"$['{k}']"
        tries += [at(p)]
        tries += [at(f"{p}[0].{kk}") for kk in ("value", "title", "target_id")]
        tries += [at(f"{p}.{kk}") for kk in ("value", "title")]
    return F.coalesce(*tries)


def blob(m: Column) -> Column:
    """One text of all non-empty values of a map."""
    return F.concat_ws(" ", F.filter(F.map_values(m), lambda x: x != ""))


# --- FN3-FN5, FN27: dates ---------------------------------------------------------------
def epoch_ms_date(c: Column) -> Column:
    """ISO day of an epoch in milliseconds; NULL unless positive and in range."""
    n = c.try_cast("double")
    ok = (n > 0) & (n < 253402300800000.0)
    # Days since the epoch: independent of the session's time zone.
    return F.when(ok, F.date_from_unix_date(F.floor(F.when(ok, n) / 86400000).cast("int")).cast("string"))


def iso_date(c: Column) -> Column:
    """Partial ISO date at the precision the text states: day, month or year."""
    s = c.cast("string")
    us = r"^(\d{1,2})/(\d{1,2})/(\d{4})"

    def part(i: int) -> Column:
        return F.regexp_extract(s, us, i)

    return (
        F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(s, F.lit(10)))
        .when(
            s.rlike(us),
            F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")),
        )
        .when(s.rlike(r"^\d{4}-\d{2}$"), s)
        .when(strip(s).rlike(r"^(1[5-9]\d{2}|20\d{2}|21\d{2})$"), strip(s))
        .when(s.rlike(r"^\d{13}$"), epoch_ms_date(s))
    )


def date_bounds(c: Column) -> tuple[Column, Column]:
    """(first possible day, precision) of a partial ISO date."""
    lo = F.try_to_date(
        F.when(F.length(c) == 4, F.concat(c, F.lit("-01-01")))
        .when(F.length(c) == 7, F.concat(c, F.lit("-01")))
        .otherwise(F.left(c, F.lit(10))),
        "yyyy-MM-dd",
    )
    precision = (
        F.when(F.length(c) == 4, "year").when(F.length(c) == 7, "month").when(c.isNotNull(), "day")
    )
    return lo, precision


def feed_date(published: Column, parsed: Column | None = None) -> Column:
    """Day of a feed entry: parsed time, ISO day anywhere, or ``d Mon yyyy``."""
    iso = blank_to_null(F.regexp_extract(published, r"\d{4}-\d{2}-\d{2}", 0))
    pat = r"(\d{1,2})\s+(" + "|".join(vocab.MONTHS) + r")\w*\s+(\d{4})"
    mon = lookup({m: f"{i:02d}" for i, m in enumerate(vocab.MONTHS, 1)}, F.regexp_extract(published, pat, 2))
    worded = F.when(
        mon.isNotNull(),
        F.concat_ws(
            "-", F.regexp_extract(published, pat, 3), mon, F.lpad(F.regexp_extract(published, pat, 1), 2, "0")
        ),
    )
    if parsed is None:
        return F.coalesce(iso, worded)
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), iso, worded)


def article_day(c: Column) -> Column:
    """``YYYYMMDD...`` to an ISO day."""
    return F.when(
        F.length(c) >= 8, F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    )


# --- FN6-FN11, FN21, FN26: text ---------------------------------------------------------
def _fold_table() -> tuple[str, str, str]:
    """Derive the one-to-one part of NFKD-without-marks from the Unicode tables."""
    src, dst, drop = [], [], []
    for cp in range(0xA0, min(sys.maxunicode, 0xFFFF) + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if unicodedata.combining(ch):
            drop.append(ch)
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if plain != ch and len(plain) == 1:
            src.append(ch)
            dst.append(plain)
    return "".join(src), "".join(dst), "".join(drop)


_FOLD_FROM, _FOLD_TO, _FOLD_DROP = _fold_table()
_LIGATURES = {
    ch: unicodedata.normalize("NFKD", ch)
    for ch in map(chr, [0x132, 0x133, 0x149, 0x1C6, 0x1C9, 0x1CC, 0x1F3, *range(0xFB00, 0xFB07)])
}


def fold_literal(s: str) -> str:
    s = unicodedata.normalize("NFKD", s.lower())
    return "".join(c for c in s if not unicodedata.combining(c))


def fold(c: Column) -> Column:
    """Lower-case and remove accents; letters that merely look accented (l-stroke) stay."""
    low = F.lower(c)
    plain = F.translate(low, _FOLD_FROM + _FOLD_DROP, _FOLD_TO)
    wide = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), _LIGATURES.items(), plain)
    has_ligature = plain.rlike("[" + "".join(_LIGATURES) + "]")
    # Pure ASCII text, the common case, needs only lower().
    return F.when(F.octet_length(c) == F.length(c), low).when(has_ligature, wide).otherwise(plain)


_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;)"
_NAMED = {f"&{k};": chr(v) for k, v in html.entities.name2codepoint.items()} | {"&apos;": "'"}


def unescape(c: Column) -> Column:
    """Replace HTML character references in a single pass."""

    def decode(e: Column) -> Column:
        hexa = F.regexp_extract(e, r"^&#[xX]([0-9a-fA-F]+)", 1)
        deci = F.regexp_extract(e, r"^&#([0-9]+)", 1)
        code = F.when(hexa != "", F.conv(hexa, 16, 10)).when(deci != "", deci).try_cast("int")
        ok = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(ok, code).otherwise(F.lit(32))), 8, "0")), "UTF-32")
        return F.when(e.startswith("&#"), F.when(ok, char).otherwise(e)).otherwise(
            F.coalesce(lookup(_NAMED, e), e)
        )

    pieces = F.split(c, _ENTITY, -1)
    refs = F.transform(F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(0)), decode)
    # pieces has exactly one element more than refs; pad with "" and interleave.
    joined = F.concat_ws("", F.zip_with(pieces, refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))))
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def clean(c: Column) -> Column:
    """HTML fragment to plain text: unescape, drop tags, trim."""
    return strip(strip_tags(unescape(F.coalesce(c.cast("string"), F.lit("")))))


def strip_marks(c: Column) -> Column:
    return strip(F.replace(strip_tags(c), F.lit("\n"), F.lit(" ")))


def titlecase(c: Column, exceptions: dict | None = None) -> Column:
    """Title case, with canonical display names for listed aliases."""
    plain = F.initcap(F.regexp_replace(strip(c), r"\s+", " "))
    if exceptions is None:
        exceptions = vocab.REGION_NAMES
    return F.coalesce(lookup(exceptions, c), plain) if exceptions else plain


def slug(c: Column) -> Column:
    return F.translate(F.lower(c), " .,", "-")


def grouped_int(c: Column) -> Column:
    """Integer written with thousands commas; NULL when it is not one."""
    return strip(F.replace(c.cast("string"), F.lit(","), F.lit(""))).try_cast("bigint")


def loose_int(c: Column) -> Column:
    """As ``grouped_int`` but accepts a fractional text and truncates it."""
    return F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("double").try_cast("bigint")


def comment_org(title: Column) -> Column:
    """Organisation named in a "comment submitted by X" title."""
    t = F.rtrim(strip(title), F.lit("."))
    org = F.btrim(F.regexp_extract(t, vocab.COMMENT_BY, 1), F.lit(" ,;."))
    return F.when(F.length(org) > 3, org)


def cut_label(label: Column, cuts=vocab.LABEL_CUTS) -> Column:
    """Cut at the first phrase, in list order, that starts after the fourth character."""
    low = F.lower(label)
    tries = []
    for p in cuts:
        at = F.locate(p, low)
        tries.append(F.when(at > 4, F.left(label, at - 1)))
    return F.coalesce(*tries, label)


def link_key(link: Column) -> Column:
    """Identity of a link: no query string, no trailing slash, lower case."""
    return F.lower(F.rtrim(F.substring_index(link, "?", 1), F.lit("/")))


# --- FN18-FN20: counts and rating -------------------------------------------------------
def stated_count(text: Column, pattern: str = vocab.STATED_COUNT, words: dict | None = None) -> Column:
    """Number of individuals a text states; never estimated."""
    raw = F.lower(F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit("")))
    return F.coalesce(
        F.when(raw.rlike(r"^\d+$"), raw.try_cast("int")), lookup(words or vocab.NUMBER_WORDS, raw)
    )


def count_score(n: Column, steps=vocab.COUNT_STEPS) -> Column:
    x = n.try_cast("double")
    out = F.when(x.isNull() | (x == 0), F.lit(0))
    for least, score in steps:
        out = out.when(x >= least, F.lit(score))
    return out.otherwise(F.lit(1))


def impact(kind: Column, n: Column, floors: dict | None = None, default: int = vocab.DEFAULT_FLOOR) -> Column:
    floor = F.coalesce(lookup(floors or vocab.KIND_FLOOR, kind), F.lit(default))
    return F.greatest(F.lit(1), F.least(F.lit(5), F.greatest(floor, count_score(n))))


# --- FN23-FN25 ---------------------------------------------------------------------------
def note(geo: Column) -> Column:
    return F.coalesce(lookup(vocab.GEO_NOTE, geo), F.lit(""))


def described(width: int | None, *parts: Column | str) -> Column:
    """Concatenate text parts; with a ``width`` for display, cut to it."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts]
    return F.left(F.concat(*cols), F.lit(width)) if width else F.concat(*cols)


def street_address(number: Column, street: Column, city: Column) -> Column:
    line = blank_to_null(strip(F.concat_ws(" ", blank_to_null(number), blank_to_null(street))))
    return strip(F.concat_ws(" ", line, blank_to_null(city)))


# --- exact decimal rounding ---------------------------------------------------------------
def decimal_key(x: Column, digits: int) -> Column:
    """``x * 10**digits`` rounded to the nearest integer, ties decided on the exact
    binary value and then to even.

    Spark's own ``round``/``bround`` round the *printed* decimal, so 0.0625-style ties
    and values such as 2.675 differ from correctly rounded arithmetic.  The exact
    product error is recovered with a split multiplication, which only matters when
    the rounded product lands exactly on a half.
    """
    scale = float(10**digits)
    p = x * F.lit(scale)
    high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    error = (high * F.lit(scale) - p) + (x - high) * F.lit(scale)
    tie = p - F.floor(p) == 0.5
    # A quarter in the direction of the error settles the tie; no error leaves it even.
    return F.when(tie, F.rint(p + F.signum(error) * 0.25)).otherwise(F.rint(p)).cast("bigint")


def exact_round(x: Column, digits: int) -> Column:
    return decimal_key(x, digits).cast("double") / F.lit(float(10**digits))
