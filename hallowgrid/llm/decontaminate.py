"""Benchmark passages in record texts, by an inverted index of token places; column expressions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import let
from ..session import reliable_checkpoint

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Rarest words of a window whose lists are intersected before the text itself is compared.
RAREST = 2
#: A near match: places a word may have moved against the window's rarest word, and the share of words that must be there.
SLACK, SHARE = 2, 0.8
#: Bytes of wanted words, as measured, up to which they are broadcast.
_FEW = 16_000_000


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z alone; built-in ``lower`` does that where every character is ASCII."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(t) == F.length(t)
    low = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(low, BREAKS), "")


def _keyed(records: DataFrame, key: str, body: str) -> DataFrame:
    """Rows with a key of two longs that never is null: the order column and a hash of the text."""
    return records.select(
        F.col(key).alias("row_ord"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("did"),
        F.xxhash64(F.col(body)).alias("dhash"),
        F.col(body).alias("desc"),
    )


def _tokens(d: DataFrame) -> DataFrame:
    return d.select("did", "dhash", F.posexplode(words_of(F.col("desc"))).alias("pos", "term"))


def benchmark_terms(benchmark: DataFrame, item: str, body: str) -> DataFrame:
    """``ikey, item, iwords`` of the benchmark: items without words left out, repeats once."""
    d = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(body)).alias("iwords")).distinct()
    return d.filter(F.size("iwords") > 0).withColumn("ikey", F.xxhash64("item", F.concat_ws(" ", "iwords")))


def windows_of(items: DataFrame) -> DataFrame:
    """``item, run, wide``: the distinct windows of every item as word lists; a repetitive item has few."""
    size = F.size("iwords")
    wide = F.least(size, F.lit(WINDOW))
    d = items.select("item", "iwords", wide.alias("wide"), F.explode(F.sequence(F.lit(0), size - wide)).alias("start"))
    return d.select("item", F.slice("iwords", F.col("start") + 1, F.col("wide")).alias("run"), "wide").distinct()


def anchors(runs: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """``run, wide, off, pair, first, second, gap``: the two rarest words of every window, rarest by count over all records.

    ``first`` stands ``off`` words into the window and ``second`` ``gap`` words later; ``pair`` hashes the three, so
    windows that lie over the same two words share it.  A window of one word has no ``second``.  Words that no record
    holds are no anchors; a window is left out if less than ``share`` of its words are held by any record.
    """
    places = runs.select("run", "wide", F.posexplode("run").alias("off", "term"))
    two = places.join(counts, "term").groupBy("run", "wide").agg(F.array_sort(F.collect_list(F.struct("n", "off", "term"))).alias("found"))
    enough = F.size("found") >= F.ceil(F.lit(share) * F.col("wide") - 1e-9)
    two = two.filter(enough).select("run", "wide", F.slice("found", 1, RAREST).alias("rarest"))
    two = two.select("run", "wide", F.array_sort(F.transform("rarest", lambda x: F.struct(x["off"].alias("off"), x["term"].alias("term")))).alias("r"))
    gap = F.get("r", 1)["off"] - F.get("r", 0)["off"]
    d = two.select("run", "wide", F.get("r", 0)["off"].alias("off"), F.get("r", 0)["term"].alias("first"), F.get("r", 1)["term"].alias("second"), gap.alias("gap"))
    return d.withColumn("pair", F.xxhash64("first", "second", "gap"))


def _to_texts(words: DataFrame) -> DataFrame:
    """Few words (``term``) go to the texts, so that only their postings travel; many are met by a shuffle of all words."""
    size = words.agg(F.sum(F.octet_length("term") + 100)).first()[0] or 0
    return F.broadcast(words) if size <= _FEW else words


def met_pairs(tokens: DataFrame, chosen: DataFrame, slack: int) -> DataFrame:
    """``did, dhash, pair, at, exact``: places of the records where both words of a pair stand, the first at ``at``.

    The postings of the second word are moved by its distance from the first, so the lists meet at one place.  With
    ``slack`` the distance may differ by that much, the order may not; ``exact`` tells where it does not differ.
    """
    pairs = chosen.select("pair", "first", "second", "gap").distinct()
    ones = pairs.select(F.col("first").alias("term"), "pair", F.lit(0).alias("gap"), F.array(F.lit(0)).alias("moves"), F.when(F.col("second").isNull(), 3).otherwise(1).alias("role"))
    moves = F.sequence(F.greatest(F.col("gap") - slack, F.lit(1)), F.col("gap") + slack)
    twos = pairs.filter("second is not null").select(F.col("second").alias("term"), "pair", "gap", moves.alias("moves"), F.lit(2).alias("role"))
    wanted = _to_texts(reliable_checkpoint(tokens.sparkSession, ones.unionByName(twos)))
    postings = tokens.join(wanted, "term").select("did", "dhash", "pair", "role", "pos", "gap", F.explode("moves").alias("move"))
    postings = postings.select("did", "dhash", "pair", "role", (F.col("pos") - F.col("move")).alias("at"), (F.col("move") == F.col("gap")).alias("exact"))
    met = postings.groupBy("did", "dhash", "pair", "at").agg(F.bit_or("role").alias("roles"), F.bool_or(F.when(F.col("role") >= 2, F.col("exact"))).alias("exact"))
    return met.filter("roles = 3").drop("roles")


def _index(records: DataFrame, benchmark: DataFrame, key: str, body: str, item: str, item_body: str, slack: int, share: float):
    """Keyed records, the windows of the benchmark with their items, their anchors, and the places where anchors meet."""
    spark = records.sparkSession
    docs = _keyed(records, key, body)
    windows = reliable_checkpoint(spark, windows_of(benchmark_terms(benchmark, item, item_body)))
    terms = _to_texts(windows.select(F.explode("run").alias("term")).distinct())
    counts = _tokens(docs).join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    chosen = reliable_checkpoint(spark, anchors(windows.select("run", "wide").distinct(), counts, share))
    return docs, windows, chosen, reliable_checkpoint(spark, met_pairs(_tokens(docs), chosen, slack))


def _stretches(docs: DataFrame, places: DataFrame, first: str, length: Column | str) -> DataFrame:
    """``places`` with ``words``: ``length`` words of their record from place ``first`` on.

    The places of a record, at most some for each of its words, meet it as one list, so its text is split once.
    """
    cols = [c for c in places.columns if c not in ("did", "dhash")]
    listed = places.withColumn("length", F.col(length) if isinstance(length, str) else length)
    listed = listed.groupBy("did", "dhash").agg(F.collect_list(F.struct(*cols, "length")).alias("at"))

    def read(words: Column) -> Column:
        return F.transform("at", lambda p: F.struct(*[p[c].alias(c) for c in cols], F.slice(words, p[first] + 1, p["length"]).alias("words")))

    d = docs.join(listed, ["did", "dhash"]).select("did", "dhash", F.explode(let(words_of(F.col("desc")), read)).alias("p"))
    return d.select("did", "dhash", "p.*").distinct()


def _exact(docs: DataFrame, windows: DataFrame, chosen: DataFrame, met: DataFrame) -> DataFrame:
    """Of the places where anchors meet, those where a window stands: its words are read there once and joined by equality."""
    met = met.filter("exact").select("did", "dhash", "pair", "at")
    starts = met.join(chosen.select("pair", "off", "wide").distinct(), "pair")
    starts = starts.select("did", "dhash", (F.col("at") - F.col("off")).alias("pos"), "wide").filter("pos >= 0").distinct()
    there = _stretches(docs, starts, "pos", "wide").withColumnRenamed("words", "run")
    return there.join(windows, ["run", "wide"]).select("did", "dhash", "item", "pos", "wide")


def _near(docs: DataFrame, windows: DataFrame, chosen: DataFrame, met: DataFrame, slack: int, share: float) -> DataFrame:
    """Of the places where anchors meet, those where ``share`` of a window's words lie near their own places."""
    starts = met.join(chosen.select("pair", "off", "wide", "run"), "pair").select("did", "dhash", "at", "off", "wide", "run")
    # The stretch around the first anchor, one list for each place; its words are counted from ``low``.
    low = F.greatest(F.col("at") - WINDOW - slack, F.lit(0))
    around = _stretches(docs, met.select("did", "dhash", "at", low.alias("low")).distinct(), "low", F.lit(2 * (WINDOW + slack) + 1))
    around = around.withColumnRenamed("words", "stretch")
    both = starts.join(around, ["did", "dhash", "at"])

    def beside(word: Column, i: Column) -> Column:
        own = F.col("at") - F.col("off") + i - F.col("low")  # the word's own place in the stretch
        first = F.greatest(own - slack, F.lit(0))
        return F.array_contains(F.slice("stretch", first + 1, F.greatest(own + slack + 1 - first, F.lit(0))), word)

    n = F.size(F.filter("run", beside))
    found = both.filter(n >= F.ceil(F.lit(share) * F.col("wide") - 1e-9))
    found = found.select("did", "dhash", "run", "wide", (F.col("at") - F.col("off")).alias("pos")).distinct()
    return found.join(windows, ["run", "wide"]).select("did", "dhash", "item", "pos", "wide").distinct()


def phrase_hits(
    records: DataFrame, benchmark: DataFrame, key: str = "row_ord", body: str = "desc", item: str = "row_ord", item_body: str = "desc"
) -> DataFrame:
    """Every occurrence of a window of a benchmark item in a record text: ``did, dhash, item, pos, wide``.

    ``did, dhash`` is the record's key, ``pos`` the place of the window's first word in the record.
    """
    index = _index(records, benchmark, key, body, item, item_body, 0, 1.0)
    return reliable_checkpoint(records.sparkSession, _exact(*index))


def proximity_hits(
    records: DataFrame, benchmark: DataFrame, key: str = "row_ord", body: str = "desc", item: str = "row_ord", item_body: str = "desc",
    slack: int = SLACK, share: float = SHARE,
) -> DataFrame:
    """Windows of benchmark items that stand in a record text with words put in, left out or changed.

    A window is near at a place if the two rarest of its words that any record holds stand there in order, their
    distance changed by at most ``slack`` words, and ``share`` of all its words lie at most ``slack`` words off their places, as counted from the
    first of the two.  Returns ``did, dhash, item, pos, wide`` as ``phrase_hits`` does; exact occurrences are among
    them, and ``pos`` may be negative where a text begins inside a window.
    """
    index = _index(records, benchmark, key, body, item, item_body, slack, share)
    return reliable_checkpoint(records.sparkSession, _near(*index, slack, share))


def contaminated_records(
    records: DataFrame, benchmark: DataFrame, key: str = "row_ord", body: str = "desc", item: str = "row_ord", item_body: str = "desc"
) -> DataFrame:
    """Find benchmark passages in decision records.

    ``records`` are decision records (``row_ord, desc``) and ``benchmark`` records held back for evaluation, with the
    same fields.  An item's windows are its runs of ten words (all its words if fewer).  Term counts over all records
    choose the two rarest words of each distinct window; their postings, moved by their distance, are intersected; where
    they meet, the words of the text are joined to the windows by equality (exact) or compared with some slack (near).

    Returns ``row_ord, n_words, n_hit, n_items, items_sha256, contaminated, n_near``: words of the record, those inside
    any occurrence of a window, items with one, a digest of their sorted, comma-joined ids, and the number of items
    with a proximity match (see ``proximity_hits``), the exact ones among them.

    Null and empty texts have no words and no hits; an item without words is never found; repeated rows get equal
    results; repeated items count once, items with a null id count for ``n_hit`` only; null keys are carried; an
    empty table on either side gives no hits; other columns are ignored.  One frequent passage or word is spread over
    tasks, since postings meet by record, pair and place.
    """
    spark = records.sparkSession
    index = _index(records, benchmark, key, body, item, item_body, SLACK, SHARE)
    hits = reliable_checkpoint(spark, _exact(*index))
    near = _near(*index, SLACK, SHARE).groupBy("did", "dhash").agg(F.count_distinct("item").alias("n_near"))
    place = F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("wide") - 1)).alias("place")
    places = hits.select("did", "dhash", "pos", "wide").distinct().select("did", "dhash", place).distinct()
    n_hit = places.groupBy("did", "dhash").agg(F.count(F.lit(1)).alias("n_hit"))
    named = hits.groupBy("did", "dhash").agg(F.sort_array(F.collect_set("item")).alias("items"))
    docs = _keyed(records, key, body).select("row_ord", "did", "dhash", F.size(words_of(F.col("desc"))).cast("long").alias("n_words"))
    d = docs.join(n_hit.join(named, ["did", "dhash"]).join(near, ["did", "dhash"], "full"), ["did", "dhash"], "left")
    none = F.array().cast("array<string>")
    return d.select(
        "row_ord",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
