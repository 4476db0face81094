"""Predicates and classifiers over text.  Vocabularies are arguments."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .scalar import blank_to_null, fold_literal, let

# Up to this many terms one substring scan per term beats one alternation scan (measured with 17 and 19 terms).
_CONTAINS_LIMIT = 20


def _quote(term: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|\-])", r"\\\1", term)


def alternation(terms) -> str:
    """One regular expression for a set of literal terms, factored by common prefix.

    Java tries the branches of a flat alternation one after the other at every
    position; sharing prefixes makes it decide on the next character instead.
    Terms that extend another term are dropped: containment already holds.
    """
    tree: dict = {}
    for t in terms:
        node = tree
        for ch in t:
            if "" in node:
                break
            node = node.setdefault(ch, {})
        else:
            node.clear()
            node[""] = {}

    def render(node: dict) -> str:
        if "" in node:
            return ""
        branches = [_quote(ch) + render(child) for ch, child in sorted(node.items())]
        return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"

    return render(tree)


def contains_any(c: Column, terms) -> Column:
    """Does the text contain one of the terms?  The terms must be in the text's case."""
    terms = [t for t in dict.fromkeys(terms) if t]
    if not terms:
        return F.lit(False)
    if len(terms) <= _CONTAINS_LIMIT:
        return reduce(lambda a, b: a | b, [F.contains(c, F.lit(t)) for t in terms])
    # A position whose character begins no term is left at once, without trying the branches.
    heads = "".join(ch if ch.isalnum() or not ch.isascii() else f"\\x{ord(ch):02x}" for ch in sorted({t[0] for t in terms}))
    return c.rlike(f"(?=[{heads}]){alternation(terms)}")


def first_match(rules, default: Column | str | None = None) -> Column:
    """Ordered rules ``[(condition, label), ...]``; the first true one gives the label."""
    out = None
    for cond, label in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def first_phrase(c: Column, phrases, default=None) -> Column:
    """Label of the first phrase, in list order, contained in the text."""
    return first_match([(F.contains(c, F.lit(p)), label) for p, label in phrases], default)


def factored(patterns, depth: int = 3) -> str:
    """Alternation of patterns grouped by their first plain letters, so that a position
    is decided on its next characters and not by trying every branch."""
    groups: dict[str, list[str]] = {}
    for p in patterns:
        # A letter can only be split off when no quantifier applies to it.
        plain = depth > 0 and p[:1].isalpha() and p[1:2] not in ("?", "*", "+", "{")
        groups.setdefault(p[0] if plain else "", []).append(p[1:] if plain else p)
    out = []
    for head, rest in groups.items():
        if not head:
            out += rest
        elif len(rest) == 1:
            out.append(head + rest[0])
        else:
            out.append(head + "(?:" + factored(rest, depth - 1) + ")")
    return "|".join(out)


def whole_words(patterns) -> str:
    return r"(?iU)\b(?:" + factored(patterns) + r")\b"


def word_in(c: Column, needle: str) -> Column:
    """Containment bounded by anything that is not a-z."""
    return c.rlike("(?<![a-z])" + _quote(needle) + "(?![a-z])")


# --- P1-P3 ----------------------------------------------------------------------------
def on_topic(c: Column, allow=None, deny=None, plain=None, stem: bool = False) -> Column:
    """Topic filter: not denied, and allowed by a whole word or by plain containment.

    With ``stem=True`` words may continue after an allowed pattern ("repatriation").
    """
    allow = vocab.TOPIC_ALLOW if allow is None else allow
    deny = vocab.TOPIC_DENY if deny is None else deny
    plain = vocab.TOPIC_PLAIN if plain is None else plain
    t = F.coalesce(c, F.lit(""))
    pattern = r"(?iU)\b(?:" + "|".join(allow) + ")" if stem else whole_words(allow)
    hit = t.rlike(pattern) if allow else F.lit(False)
    if plain:
        # Scripts outside ASCII only: skip the pass when the text is pure ASCII.
        need = F.lit(True) if any(p.isascii() for p in plain) else F.octet_length(t) > F.length(t)
        hit = hit | (need & contains_any(F.lower(t), [p.lower() for p in plain]))
    return (~t.rlike(whole_words(deny)) & hit) if deny else hit


def site_register(c: Column, patterns=vocab.SITE_REGISTER) -> Column:
    """Is this dataset a register of site locations (refused as a whole)?"""
    return F.coalesce(c, F.lit("")).rlike("(?iU)(?:" + "|".join(patterns) + ")")


def individual_case(c: Column, single=vocab.SINGLE_CASE, group=vocab.GROUP_HINT) -> Column:
    t = F.lower(F.coalesce(c, F.lit("")))
    return contains_any(t, single) & ~contains_any(t, group)


# --- P4, P5 ---------------------------------------------------------------------------
def trigger(c: Column, rules=vocab.TRIGGER_RULES, default: str = "unknown") -> Column:
    t = F.lower(F.coalesce(c, F.lit("")))
    return first_match([(t.rlike(p), label) for p, label in rules], default)


def only_place(c: Column, names, longest: bool = False) -> Column:
    """The one listed name the text contains as a whole word; NULL if none or several.

    ``longest=True`` does not count a name inside a longer listed name ("Virginia" in
    "West Virginia").  One pass of the matcher: a look-ahead at every word start sees
    overlapping names, a consuming match only the longest.
    """
    names = list(names)
    either = "|".join(_quote(n) for n in sorted(names, key=len, reverse=True))
    pattern = rf"(?U)\b({either})\b" if longest else rf"(?U)\b(?=({either})\b)"
    hits = F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)))
    # A name that begins with another listed name stands for two at the same place.
    double = [] if longest else [n for n in names if any(n.startswith(m) and not n[len(m)].isalnum() for m in names if len(m) < len(n))]
    return let(hits, lambda h: F.when((F.size(h) == 1) & (~F.get(h, 0).isin(double) if double else F.lit(True)), F.get(h, 0)))


# --- P6-P11: news ---------------------------------------------------------------------
def folded_terms(terms):
    return [fold_literal(t) for t in terms]


def news_allowed(folded: Column, terms=vocab.NEWS_ALLOW) -> Column:
    return contains_any(folded, folded_terms(terms))


def news_blocked(folded: Column, terms=vocab.NEWS_BLOCK) -> Column:
    return contains_any(folded, folded_terms(terms))


def significance(folded: Column, terms=vocab.NEWS_SIGNIFICANT) -> Column:
    return F.when(contains_any(folded, folded_terms(terms)), F.lit(2)).otherwise(F.lit(1))


def topic(folded: Column, rules=vocab.NEWS_TOPICS, guards=None, default: str = "other") -> Column:
    """First rule whose terms occur.  ``guards`` maps a label to term lists that must
    each occur as well; without them the rule is skipped and the next one is tried."""
    if guards is None:
        guards = {"opposition": (vocab.OBJECTOR_TERMS, vocab.ANCESTOR_TERMS)}
    conds = []
    for label, terms in rules:
        cond = contains_any(folded, terms)
        for extra in guards.get(label, ()):
            cond = cond & contains_any(folded, extra)
        conds.append((cond, label))
    return first_match(conds, default)


def objector(c: Column, terms=vocab.OBJECTOR_ORGS) -> Column:
    return contains_any(F.lower(F.coalesce(c, F.lit(""))), terms)


def fresh_enough(date_iso: Column, today: Column, days: int) -> Column:
    """Not older than ``days``.  Undated and unreadable dates are kept."""
    d = F.try_to_date(date_iso, "yyyy-MM-dd")
    return d.isNull() | (F.datediff(today, d) <= days)


# --- P12, P13: facilities -------------------------------------------------------------
def _lowered(tags: Column) -> Column:
    return F.transform(
        F.map_entries(tags), lambda e: F.struct(F.lower(e["key"]).alias("key"), F.lower(e["value"]).alias("value"))
    )


def lower_tags(tags: Column) -> Column:
    """Tags with lower-case keys and values; of keys that differ only by case the last counts."""

    def last_of_each(keyed: Column) -> Column:
        distinct = F.size(F.array_distinct(F.transform(keyed, lambda x: x["key"]))) == F.size(keyed)
        last = F.filter(keyed, lambda x, i: F.size(F.filter(keyed, lambda y, j: (j > i) & (y["key"] == x["key"]))) == 0)
        return F.map_from_entries(F.when(distinct, keyed).otherwise(last))

    return let(_lowered(tags), last_of_each)


def facility_type(tags: Column, rules=vocab.FACILITY_RULES) -> Column:
    def typed(t: Column) -> Column:
        def tagged(pairs) -> Column:
            return reduce(
                lambda a, b: a | b, [F.coalesce(F.lower(F.try_element_at(t, F.lit(k))) == v, F.lit(False)) for k, v in pairs]
            )

        return first_match([(tagged(pairs), label) for label, pairs in rules])

    # Keys that are distinct and in lower case, the common case, are looked up as they stand.
    keys = F.map_keys(tags)
    plain = (F.array_join(keys, "") == F.lower(F.array_join(keys, ""))) & (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(plain, typed(tags)).otherwise(let(lower_tags(tags), typed))


def refused_site(tags: Column, ftype: Column | None = None) -> Column:
    """Element that must not be published in the facility layer."""
    burial = F.lit(True) if ftype is None else F.coalesce(ftype.isin(*vocab.BURIAL_TYPES), F.lit(True))

    def bad(e: Column) -> Column:
        k, v = e["key"], e["value"]
        lifecycle = reduce(lambda a, b: a | b, [k.startswith(p) for p in vocab.LIFECYCLE])
        arch = k.isin(*vocab.ARCH_KEYS) & F.coalesce(v.isin(*vocab.ARCH_VALUES), F.lit(False))
        return lifecycle | arch | (burial & (k == "historic")) | (k == "archaeological_site")

    # Only where the keys hold one of the words somewhere are the tags looked at one by one.
    keys = F.map_keys(tags)
    hint = contains_any(F.lower(F.array_join(keys, " ")), [*vocab.LIFECYCLE, *vocab.ARCH_KEYS, "historic", "archaeological_site"])
    sure = burial & F.array_contains(keys, "historic")
    return F.when(sure, True).when(hint, F.coalesce(F.exists(_lowered(tags), bad), F.lit(False))).otherwise(False)


# --- P14-P16, P19 -----------------------------------------------------------------------
def dead_permit(status: Column, terms=vocab.DEAD_PERMIT) -> Column:
    return contains_any(F.lower(F.coalesce(status, F.lit(""))), terms)


def dataset_kind(title: Column, text: Column) -> Column:
    both = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))
    return F.when(both.rlike("(?U)" + vocab.EXCAVATION), "excavation").otherwise("removed-ground")


def link_state(url: Column, code: Column, final_url: Column, error: Column, tls_hosts=vocab.TLS_BROKEN_HOSTS) -> Column:
    """State of a probed link.

    One probe row is the outcome of one request: ``code`` is the HTTP status (0/NULL
    when no answer came), ``error`` the transport failure.  For a listed host with a
    broken certificate chain a code next to the certificate error is the answer of
    the unverified retry.
    """
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://([^/:?#]+)", 1))
    tls = F.contains(F.coalesce(error, F.lit("")), F.lit("CERTIFICATE_VERIFY_FAILED"))
    answered = F.coalesce(code, F.lit(0)) > 0
    good = code.between(200, 399)
    moved = F.rtrim(F.coalesce(final_url, url), F.lit("/")) != F.rtrim(url, F.lit("/"))
    return (
        F.when(blank_to_null(url).isNull(), "find-only")
        .when(tls & host.isin(*tls_hosts) & answered & good, "tls")
        .when(blank_to_null(error).isNotNull() & ~answered, "dead")
        .when(tls, "dead")
        .when(code.isin(*vocab.BLOCKED_CODES), "blocked")
        .when(good & moved, "redirect")
        .when(good, "ok")
        .otherwise("dead")
    )


def memorial_subject(kind: Column, name: Column, terms=vocab.MEMORIAL_TERMS) -> Column:
    return (kind != "review") | contains_any(F.lower(name), terms)

