"""Personal data in record texts: fixed patterns as seeds, lexical patterns learned from their contexts.

Column expressions and joins only.  No regular expression here can backtrack over a long run: repeated parts are
possessive, and a match may only start where the run starts or where the match before it ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import let
from ..session import reliable_checkpoint

KINDS = ("email", "ip", "card", "phone")
#: Kind of the spans that the learned patterns add.
FOUND = "context"
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IN_RANGE = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"
BLANK = r"\x20\x09-\x0D"
#: A word with a digit or an at sign: what could be an identifier.
WORDLIKE = rf"(?<![^{BLANK}])[^{BLANK}0-9@]*+[0-9@][^{BLANK}]*+"
OPENING, CLOSING = "([{<\"'", ")]}>\"',.;:!?"
#: The last two words of a text read backwards, and the first word of a text; words are never cut.
LAST_TWO = rf"^[{BLANK}]*+[^{BLANK}]*+(?:[{BLANK}]++[^{BLANK}]++)?"
FIRST = rf"^[{BLANK}]*+[^{BLANK}]*+"
#: Code points of the pieces a text is cut into before spans are taken out of it.
PIECE = 1024
#: Beyond every place of a text.
FAR = 2**31 - 1

OCCURRENCE = "array<struct<start:int,end:int,body:string,left:string,right:string>>"


def running(values: Column, step: Callable[[Column, Column], Column], none: Column) -> Column:
    """``values`` folded by an associative ``step`` up to each place, by doubling the distance added in each round.

    A fold that appends copies its list for every element; this takes one round for each bit of the length.
    """

    def add(s: Column, k: Column) -> Column:
        moved = F.concat(F.array_repeat(none, F.call_function("shiftleft", F.lit(1), k)), s)
        return F.zip_with(s, F.slice(moved, 1, F.size(s)), step)

    def scan(v: Column) -> Column:
        rounds = F.length(F.bin(F.size(v) - 1)) - 1  # the highest bit of the greatest distance
        return F.when(F.size(v) > 1, F.aggregate(F.sequence(F.lit(0), rounds), v, add)).otherwise(v)

    return let(values, scan)


def occurrences(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """Matches of ``pattern`` that pass ``keep``: code-point places and the words next to them.

    The text between matches comes from splitting at the same pattern; places are running sums of lengths.  ``left``
    holds the last two words before a match, ``right`` the first after it, both whole, and none beyond another match.
    """

    def walk(gaps: Column, found: Column) -> Column:
        pairs = F.zip_with(
            F.zip_with(F.slice(gaps, 1, F.size(found)), F.slice(gaps, 2, F.size(found)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            found,
            lambda g, m: F.struct(g["a"].alias("before"), g["b"].alias("after"), m.alias("body")),
        )
        lengths = F.zip_with(gaps, found, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        ends = running(F.slice(lengths, 1, F.size(found)), lambda a, b: a + b, F.lit(0))
        held = F.filter(F.zip_with(pairs, ends, lambda p, e: F.struct(p.alias("p"), e.alias("end"))), lambda x: keep(x["p"]["body"]))

        def near(x: Column) -> Column:
            left = F.reverse(F.regexp_extract(F.reverse(x["p"]["before"]), LAST_TWO, 0))
            right = F.regexp_extract(x["p"]["after"], FIRST, 0)
            body = x["p"]["body"]
            return F.struct((x["end"] - F.length(body)).alias("start"), x["end"].alias("end"), body.alias("body"), left.alias("left"), right.alias("right"))

        return F.transform(held, near)

    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(gaps, lambda g: let(found, lambda m: walk(g, m)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _card(m: Column) -> Column:
    d = _digits(m)
    return (F.length(m) >= 14) & let(d, lambda x: F.length(x).between(14, 19) & F.call_function("luhn_check", x))


def _identifier(m: Column) -> Column:
    return F.contains(m, F.lit("@")) | ((F.length(m) >= 6) & (F.length(_digits(m)) >= 4))


def base_spans(text: Column) -> dict[str, Column]:
    """Occurrences by kind; a cheap test first spares texts without the kind."""
    none = F.array().cast(OCCURRENCE)
    rules = {
        "email": (F.contains(text, F.lit("@")), EMAIL, lambda m: F.lit(True)),
        "ip": (text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), IP, lambda m: m.rlike(IN_RANGE)),
        "card": (text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), CARD, _card),
        "phone": (F.contains(text, F.lit("+")), PHONE, lambda m: F.length(_digits(m)).between(10, 15)),
    }
    return {k: F.when(test, occurrences(text, p, keep)).otherwise(none) for k, (test, p, keep) in rules.items()}


def _candidates(text: Column) -> Column:
    """Identifier-like words, trimmed of brackets, quotes and stops."""
    raw = occurrences(text, WORDLIKE, _identifier)

    def trim(o: Column) -> Column:
        inner = F.ltrim(o["body"], F.lit(OPENING))
        start = o["start"] + F.length(o["body"]) - F.length(inner)
        body = F.rtrim(inner, F.lit(CLOSING))
        return F.struct(
            start.cast("int").alias("start"), (start + F.length(body)).cast("int").alias("end"), body.alias("body"), o["left"].alias("left"), o["right"].alias("right")
        )

    return F.when(text.rlike("[0-9@]"), F.transform(raw, trim)).otherwise(F.array().cast(OCCURRENCE))


def scanned(records: DataFrame, key: str, body: str) -> DataFrame:
    """One row per record: its key, its base spans by kind, and its other identifier-like words."""
    text = F.coalesce(F.col(body), F.lit(""))
    d = records.select(
        F.col(key).alias("row_ord"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("did"),
        F.xxhash64(F.col(body)).alias("dhash"),
        *[c.alias(k) for k, c in base_spans(text).items()],
        _candidates(text).alias("words"),
    )
    return d


def _tagged(kind: str) -> Column:
    return F.transform(F.col(kind), lambda o: F.struct(o["start"].alias("start"), F.lit(kind).alias("kind"), o["end"].alias("end"), o["body"].alias("body"), o["left"].alias("left"), o["right"].alias("right")))


def contexts(found: DataFrame) -> DataFrame:
    """``did, dhash, kind, start, end, instance, patterns``: each seed and each other identifier-like word with the
    lexical patterns around it (two words before; one before with one after).  Words inside a seed are left out."""
    seeds = F.concat(*[_tagged(k) for k in KINDS])
    words = F.transform("words", lambda w: F.struct(w["start"].alias("start"), F.lit(None).cast("string").alias("kind"), w["end"].alias("end"), w["body"].alias("body"), w["left"].alias("left"), w["right"].alias("right")))

    def free(spans: Column) -> Column:
        # In order of start, a seed before a word meets it by its end, one after it by its start.
        reach = running(F.transform(spans, lambda s: F.when(s["kind"].isNull(), 0).otherwise(s["end"])), lambda a, b: F.greatest(a, b), F.lit(0))
        starts = F.transform(F.reverse(spans), lambda s: F.when(s["kind"].isNull(), F.lit(FAR)).otherwise(s["start"]))
        ahead = F.reverse(running(starts, lambda a, b: F.least(a, b), F.lit(FAR)))
        edges = F.zip_with(reach, ahead, lambda r, a: F.struct(r.alias("reach"), a.alias("ahead")))
        both = F.zip_with(spans, edges, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
        apart = F.filter(both, lambda x: x["s"]["kind"].isNotNull() | ((x["e"]["reach"] <= x["s"]["start"]) & (x["e"]["ahead"] >= x["s"]["end"])))
        return F.transform(apart, lambda x: x["s"])

    every = let(F.array_sort(F.concat(seeds, words)), free)
    o = found.select("did", "dhash", F.explode(every).alias("o")).select("did", "dhash", "o.*")
    gap = f"[{BLANK}]+"
    before = F.split(F.translate(F.lower(F.rtrim(F.col("left"), F.lit(" \t\n\x0b\x0c\r"))), "0123456789", "0000000000"), gap)
    after = F.get(F.split(F.translate(F.lower(F.ltrim(F.col("right"), F.lit(" \t\n\x0b\x0c\r"))), "0123456789", "0000000000"), gap), 0)
    last, first = F.coalesce(F.try_element_at(before, F.lit(-1)), F.lit("")), F.coalesce(F.try_element_at(before, F.lit(-2)), F.lit(""))
    patterns = F.array(F.concat_ws(" ", F.lit("<"), first, last), F.concat_ws(" ", F.lit("<>"), last, F.coalesce(after, F.lit(""))))
    return o.select("did", "dhash", "kind", "start", "end", F.lower("body").alias("instance"), patterns.alias("patterns"))


def learn(edges: DataFrame, rounds: int, support: int, confidence: float) -> DataFrame:
    """Instances that trusted patterns name, out of ``edges(pattern, instance, seed)``.

    Each round scores the pattern-instance graph: a pattern's confidence is the share of its distinct instances that
    are known, trusted from ``support`` known ones and ``confidence`` on; an instance's is one minus the product of
    its trusted patterns' doubts.  Instances from ``confidence`` on become known for the next round.
    """
    spark = edges.sparkSession
    edges = reliable_checkpoint(spark, edges)
    new = None
    for _ in range(rounds):
        known = edges.withColumn("known", F.col("seed"))
        if new is not None:
            known = edges.join(new.withColumn("hit", F.lit(True)), "instance", "left").withColumn("known", F.col("seed") | F.coalesce("hit", F.lit(False)))
        rated = known.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.count_if("known").alias("k"))
        trusted = rated.filter(F.col("k") >= support).withColumn("doubt", F.greatest(1 - F.col("k") / F.col("n"), F.lit(1e-9)))
        trusted = reliable_checkpoint(spark, trusted.filter(F.col("doubt") <= 1 - confidence).select("pattern", "doubt"))
        named = edges.filter(~F.col("seed")).join(trusted, "pattern").groupBy("instance").agg(F.sum(F.log("doubt")).alias("doubt"))
        new = reliable_checkpoint(spark, named.filter(1 - F.exp("doubt") >= confidence).select("instance"))
    return new


def personal_data(
    records: DataFrame, key: str = "row_ord", body: str = "desc", rounds: int = 2, support: int = 5, confidence: float = 0.8
) -> DataFrame:
    """Find personal data in decision records, and with the contexts of what is found, more of it.

    ``records`` has ``row_ord`` and ``desc``.  Emails, IP addresses, payment cards (Luhn) and international phone
    numbers are the seeds.  The words around them form lexical patterns; ``rounds`` of scoring the graph of patterns
    and identifier-like words over all records promote further words, whose occurrences are added as ``context``.

    Returns ``row_ord, dhash, n_email, n_ip, n_card, n_phone, base_sha256, spans array<struct<kind,start,end>>``; places
    are code points, the end exclusive, ordered by start, then kind as listed; ``dhash`` is ``xxhash64`` of the text.  ``base_sha256`` digests the seeds alone.

    Null and empty texts have no spans; null keys are carried; repeated rows get equal results and count once in the
    graph; an empty table gives no rows; other columns are ignored.  Every count is over all records.  A word is
    identifier-like if it holds an at sign, or has six characters or more of which four are digits.  A text costs its
    length times the bits of its number of matches.
    """
    spark = records.sparkSession
    found = reliable_checkpoint(spark, scanned(records, key, body))
    around = contexts(found)
    edges = around.select(F.explode("patterns").alias("pattern"), "instance", F.col("kind").isNotNull().alias("seed"))
    new = learn(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), rounds, support, confidence)
    more = around.filter(F.col("kind").isNull()).join(new, "instance").select("did", "dhash", "start", "end").distinct()
    more = more.groupBy("did", "dhash").agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("k"), "end")).alias("more"))

    def placed(kind: str) -> Column:
        k = KINDS.index(kind)
        return F.transform(F.col(kind), lambda o: F.struct(o["start"].alias("start"), F.lit(k).alias("k"), o["end"].alias("end")))

    base = F.array_sort(F.concat(*[placed(k) for k in KINDS]))
    d = found.select("row_ord", "did", "dhash", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], base.alias("base"))
    d = d.join(more, ["did", "dhash"], "left")
    names = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])

    def named(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.get(names, s["k"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    digest = F.sha2(joined(named(F.col("base"))), 256)
    return d.select("row_ord", "dhash", *[f"n_{k}" for k in KINDS], digest.alias("base_sha256"), named(every).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first covers the rest.

    ``spans`` are in order of start.  The text is cut into pieces once, so that a span far inside it is not reached
    by counting from the beginning.
    """

    def cut(pieces: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        over = F.slice(pieces, first + 1, F.floor(b / PIECE).cast("int") - first + 1)
        return F.when(b > a, F.substring(F.array_join(over, ""), a - first * PIECE + 1, b - a)).otherwise("")

    def join(pieces: Column, reach: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), F.slice(reach, 1, F.size(reach) - 1))  # how far the spans before cover
        parts = F.zip_with(
            spans, before, lambda x, at: F.when(x["start"] >= at, F.concat(cut(pieces, at, x["start"]), F.lit("["), x["kind"], F.lit("]"))).otherwise("")
        )
        return F.concat(F.array_join(parts, ""), cut(pieces, F.element_at(reach, -1), F.length(text)))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    reach = running(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
    return F.when(F.size(spans) > 0, let(pieces, lambda p: let(reach, lambda r: join(p, r)))).otherwise(text)
