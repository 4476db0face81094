"""Quality rules over record texts: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import let

WORD = r"[^\x20\x09-\x0D]"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Common function words of the languages that records are written in (fixed values).
STOP_WORDS = {
    "en": "the of and to in that is it was for as with are on be this by from or an a".split(),
    "fr": "le la de des et les un une en que qui du dans pour au aux par sur ce est avec il elle".split(),
    "de": "der die das und in den von zu mit ist nicht ein eine auf dem des sich für im als es auch".split(),
    "es": "el la de que y en los las un una por con no se del al para es su lo como".split(),
    "it": "il lo la di che e un una per con non si del della in sono".split(),
    "pt": "o a os as de que e um uma por com não se do da em para".split(),
    "nl": "de het een en van in is dat op te zijn met voor niet".split(),
}


@dataclass(frozen=True)
class Rule:
    """A record fails when ``measure`` is below ``low`` or above ``high``; judged from ``from_words`` words on."""

    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("symbol_ratio", high=0.2),
    Rule("shout_ratio", high=0.25),
    Rule("stop_ratio", low=0.02, from_words=30),
    Rule("stutter_ratio", high=0.3),
    Rule("mean_word_chars", low=2.0, high=20.0),
    Rule("dup_line_ratio", high=0.5),
)


def _windows(words: Column) -> Column:
    """Hash of each run of five words, in the order of the text."""

    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])

    many = F.size(words) >= WINDOW
    return F.when(many, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), at))


def _covered(places: Column) -> Column:
    """Words under windows that start at the given ascending places."""
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(s: Column, at: Column) -> Column:
        last = at + (WINDOW - 1)
        return F.struct(last.alias("end"), (s["n"] + last - F.greatest(s["end"], at - 1)).alias("n"))

    return F.aggregate(places, start, add, lambda s: s["n"])


def _twins(ordered: Column, words: Column) -> Column:
    """Places of the windows equal to a neighbour in the order of hash and place, ascending."""

    def same(a: Column, b: Column) -> Column:
        texts = F.slice(words, a["at"] + 1, WINDOW) == F.slice(words, b["at"] + 1, WINDOW)
        return F.coalesce((a["h"] == b["h"]) & texts, F.lit(False))

    def mark(w: Column, i: Column) -> Column:
        return F.when(same(w, F.get(ordered, i - 1)) | same(w, F.get(ordered, i + 1)), w["at"])

    return F.array_sort(F.array_compact(F.transform(ordered, mark)))


def _repeated(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more.  Sorting the hashes brings equal windows together, so
    a text costs n log n; texts without a repeat stop at counting distinct hashes."""

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        found = let(F.array_sort(placed), lambda s: let(_twins(s, words), _covered))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found)

    return F.coalesce(let(_windows(words), count), F.lit(0)).cast("long")


def measures(text: Column, stop_words=None) -> Column:
    """All counts of a text as one struct; its words and lines are found once and bound to lambda variables."""
    stops = sorted({w for ws in (stop_words or STOP_WORDS).values() for w in ws})
    longest = 3 * max((len(w.encode()) for w in stops), default=0)  # a letter may take three times the bytes of its lower case
    text = F.coalesce(text, F.lit(""))

    def stop(word: Column) -> Column:
        bare = F.rtrim(word, F.lit(".,;:!?"))
        return (F.octet_length(bare) <= longest) & F.lower(bare).isin(stops)

    def of(words: Column, t: Column) -> Column:
        chars = F.length(F.array_join(words, ""))
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        stopped = F.size(F.filter(words, stop))
        before = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
        after = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
        stutter = F.size(F.filter(F.zip_with(before, after, lambda a, b: a == b), lambda x: x))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeated(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
            stopped.cast("long").alias("n_stop_words"),
            stutter.cast("long").alias("n_stutters"),
        )

    words = F.filter(F.split(text, GAP), lambda w: w != "")
    return let(text, lambda t: let(words, lambda ws: of(ws, t)))


def _ratio(n: str, of: str) -> Column:
    return F.try_divide(F.col(n).cast("double"), F.col(of).cast("double"))


RATIOS = {
    "symbol_ratio": ("n_symbols", "n_words"),
    "shout_ratio": ("n_shouts", "n_words"),
    "stop_ratio": ("n_stop_words", "n_words"),
    "stutter_ratio": ("n_stutters", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def compile_rules(rules) -> Column:
    """One boolean over all rules of the table; an undefined ratio passes."""

    def passes(r: Rule) -> Column:
        value = _ratio(*RATIOS[r.measure]) if r.measure in RATIOS else F.col(r.measure).cast("double")
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (value >= r.low)
        if r.high is not None:
            ok = ok & (value <= r.high)
        return F.coalesce(ok, F.lit(True)) | (F.col("n_words") < r.from_words)

    return reduce(lambda a, b: a & b, [passes(r) for r in rules], F.lit(True))


def rate_records(records: DataFrame, rules=RULES, stop_words=None, key: str = "row_ord", body: str = "desc") -> DataFrame:
    """Rate every record text by a table of thresholds on length, symbol, stop-word and line ratios.

    ``records`` are decision records (``row_ord``, ``desc``).  The whole table becomes one projection of built-in
    functions: no user functions, no data moved between tasks.

    Returns ``row_ord, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.
    ``base_failed`` marks texts under 10 words, or with more than a fifth of their words inside five-word windows
    that occur twice; ``kept`` also needs every rule to pass.

    A null, empty or blank text has no words, so it fails the base; null keys and repeated rows stay as they are; an
    empty table gives no rows; other columns are ignored.
    """
    d = records.select(F.col(key).alias("row_ord"), measures(F.col(body), stop_words).alias("_m"))
    d = d.select("row_ord", "_m.*")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return d.select("row_ord", *counts, failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"))
