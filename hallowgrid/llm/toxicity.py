"""Toxicity of record texts: a learned lexicon as a trie, met by Levenshtein automata, judged in its context."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .memo import Remembered

#: Look-alike characters, and words that introduce a quotation or address the reader (fixed values).
LOOK_ALIKES = str.maketrans("013457@$!|", "oieastasil")
QUOTING = frozenset("said says say called calls wrote writes quote quoted quotes reported reports word words term termed dit dits appelé écrit citation sagte sagt nannte schrieb zitat dijo dice llamó escribió cita".split())
ADDRESSING = frozenset("you your you're youre yours u tu toi vous votre du dich dein ihr euch usted ustedes vosotros".split())
QUOTES = "\"“”„«»"
#: Words to either side of a hit that decide its context.
NEAR = 5
STEMS = range(3, 9)
FEATURES = 7
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def plain_word(raw: str) -> str:
    """Lower case without outer punctuation; look-alike characters inside become letters."""
    w = raw if raw.isalpha() else EDGE.sub("", raw)
    if not w or w.isalpha() or w.isdigit():
        return w
    w = w.translate(LOOK_ALIKES)
    return "".join(c for c in w if c.isalpha())


@dataclass
class Node:
    next: dict[str, int] = field(default_factory=dict)
    term: tuple[float, int] | None = None  # weight, edits allowed
    stem: tuple[float, int] | None = None


class Lexicon:
    """Terms and stems in one trie.

    A word is read by the intersection of the trie with the Levenshtein automaton of one edit: a state is the set of
    (trie node, edits so far) a prefix can have reached.  Sets are made when first needed and remembered by letter,
    so a word costs one look-up a letter; the memory starts afresh beyond ``most`` steps.
    """

    def __init__(self, terms: dict[str, float], stems: dict[str, float], most: int = 200_000):
        self.nodes, self.most = [Node()], most
        for w, weight in terms.items():
            self.nodes[self._path(w)].term = (weight, int(len(w) >= 5))
        for w, weight in stems.items():
            self.nodes[self._path(w)].stem = (weight, 0)
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.start = self._skip({(0, 0)})

    def _path(self, word: str) -> int:
        at = 0
        for c in word:
            if c not in self.nodes[at].next:
                self.nodes[at].next[c] = len(self.nodes)
                self.nodes.append(Node())
            at = self.nodes[at].next[c]
        return at

    def _skip(self, states: set) -> frozenset:
        """Adds what leaving out one trie letter reaches."""
        return frozenset(states | {(n, 1) for at, e in states if e == 0 for n in self.nodes[at].next.values()})

    def step(self, states: frozenset, c: str) -> frozenset:
        key = (states, c)
        out = self.steps.get(key)
        if out is None:
            reached = set()
            for at, e in states:
                nexts = self.nodes[at].next
                if c in nexts:
                    reached.add((nexts[c], e))
                if e == 0:
                    reached.add((at, 1))
                    reached.update((n, 1) for n in nexts.values())
            out = self._skip(reached)
            if len(self.steps) >= self.most:
                self.steps.clear()
            self.steps[key] = out
        return out

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the best term or stem, exact ones first; None without one."""
        states, best = self.start, None
        for c in word:
            states = self.step(states, c)
            if not states:
                break
            for at, e in states:
                stem = self.nodes[at].stem
                if stem and e == 0:
                    best = max(best or (0.0, 0), (stem[0], 0))
        else:
            for at, e in states:
                term = self.nodes[at].term
                if term and e <= term[1]:
                    found = (term[0], e)
                    if best is None or (found[1], -found[0]) < (best[1], -best[0]):
                        best = found
        return best


class Reader:
    """Features of a text under a lexicon; matches of distinct words are remembered within a bound."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float]):
        self.lexicon = Lexicon(terms, stems)
        self.seen = Remembered(lambda raw: self.lexicon.match(plain_word(raw)) or 0)

    def features(self, text: str | None) -> np.ndarray:
        """Bias; weight of open exact hits, open misspelt ones, quoted ones (all damped); share of addressed hits;
        whether there is any open hit, and more than one hit."""
        raw = (text or "").lower().split()
        out = np.zeros(FEATURES)
        out[0] = 1.0
        hits = [(i, m) for i, m in enumerate(map(self.seen.__getitem__, raw)) if m]
        addressed = 0
        for i, (weight, edits) in hits:
            left, right = raw[max(0, i - NEAR) : i], raw[i + 1 : i + 1 + NEAR]
            around = {EDGE.sub("", w) for w in (*left, *right)}
            opened = sum(c in QUOTES for w in (*left, raw[i][: len(raw[i]) // 2]) for c in w) % 2
            closed = any(c in QUOTES for w in (raw[i][len(raw[i]) // 2 :], *right) for c in w)
            quoted = (opened and closed) or (not around.isdisjoint(QUOTING) and around.isdisjoint(ADDRESSING))
            addressed += not around.isdisjoint(ADDRESSING)
            out[3 if quoted else 2 if edits else 1] += weight
        out[1:4] = np.log1p(out[1:4])
        if hits:
            out[4] = addressed / len(hits)
            out[5] = float(out[1] > 0)
            out[6] = float(len(hits) > 1)
        return out


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(records: DataFrame, labels: DataFrame, most: int, key: str, body: str, label: str) -> DataFrame:
    """``toxic, desc`` of at most ``most`` labelled records that are not held out, half of them of each class at most.

    Which ones depends on a hash of the key only.  Equal texts count once.  The list of keys is bounded by ``most``
    rows of 20 bytes, so it may be broadcast.
    """
    y = labels.select(F.col(key).alias("row_ord"), F.col(label).cast("int").alias("toxic")).filter("row_ord IS NOT NULL AND toxic IS NOT NULL")
    y = y.filter(~held_out(F.col("row_ord"))).groupBy("row_ord").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("row_ord")
    part = [y.filter(F.col("toxic") == c).orderBy(order, "row_ord").limit(most // 2) for c in (1, 0)]
    chosen = part[0].unionByName(part[1])
    found = records.select(F.col(key).alias("row_ord"), F.coalesce(F.col(body), F.lit("")).alias("desc")).join(F.broadcast(chosen), "row_ord")
    return found.select("toxic", "desc").dropDuplicates()


def _word_counts(batches):
    """Documents of each class that hold a word, summed in the task."""
    counts: dict[str, list[int]] = {}

    def emit():
        ws = list(counts)
        yield pa.RecordBatch.from_pydict({"word": pa.array(ws, pa.string()), "tox": pa.array([counts[w][1] for w in ws], pa.int64()), "clean": pa.array([counts[w][0] for w in ws], pa.int64())})
        counts.clear()

    for b in batches:
        for y, t in zip(b.column(0).to_pylist(), b.column(1)):
            for w in {plain_word(x) for x in t.as_py().lower().split()}:
                if 2 < len(w) <= 40:
                    counts.setdefault(w, [0, 0])[y] += 1
            if len(counts) >= 200_000:
                yield from emit()
    yield from emit()


def learn_lexicon(sample: DataFrame, most: int = 4000, share: float = 0.01) -> tuple[dict[str, float], dict[str, float]]:
    """Terms and stems that mark toxic records, with their log odds as weights; at most ``most`` of each.

    A term must occur in ``share`` of the toxic sample (4 records at least) and 200 times as often, relative to all
    words of its class, as in clean records.  A stem also must end in three different words; the shortest stem stands
    for the longer ones and for its words, and is itself lengthened as long as that loses next to nothing.
    """
    words = reliable_checkpoint(sample.sparkSession, sample.mapInArrow(_word_counts, "word string, tox long, clean long").groupBy("word").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean")))
    totals = words.agg(F.sum("tox"), F.sum("clean")).first()
    toxic, clean = (float(x or 0) for x in totals)
    if not toxic:
        return {}, {}
    least = max(4, math.ceil(share * sample.filter("toxic = 1").count()))
    odds = F.log((F.col("tox") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    strong = (F.col("tox") >= least) & (odds >= 4) & (F.col("clean") * 200 * toxic <= F.col("tox") * max(clean, 1.0))
    prefixes = F.transform(F.array(*[F.lit(n) for n in STEMS]), lambda n: F.when(F.length("word") >= n, F.substring(F.col("word"), F.lit(1), n)))
    stems = words.select(F.explode(F.array_compact(prefixes)).alias("word"), "tox", "clean", F.col("word").alias("of"))
    stems = stems.groupBy("word").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"), F.count("of").alias("n")).filter("n >= 3")

    def top(df: DataFrame) -> dict[str, tuple[float, int]]:
        rows = df.filter(strong).select("word", odds.alias("odds"), "tox").orderBy(F.desc("odds"), "word").limit(most).collect()
        return {r["word"]: (float(r["odds"]), r["tox"]) for r in rows}

    found, kept = top(stems), {}
    for w in sorted(found, key=lambda w: (len(w), w)):
        if any(w[:n] in found for n in range(STEMS[0], len(w))):
            continue
        while longer := [x for x in found if len(x) == len(w) + 1 and x.startswith(w) and found[x][1] >= 0.95 * found[w][1]]:
            w = longer[0]
        kept[w] = found[w][0]
    terms = {w: x for w, (x, _) in top(words).items() if not any(w[:n] in kept for n in STEMS)}
    return terms, kept


def fit(features: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; classes weigh alike.  Weights are drawn to a prior under which quoted
    hits count little, since few samples hold any."""
    prior = np.array([-3.0, 1.0, 0.5, 0.2, 0.5, 0.5, 2.0])
    w, ridge = prior.copy(), np.array([0.01, 0.5, 0.5, 5.0, 2.0, 0.5, 0.5])
    if not (len(y) and 0 < y.sum() < len(y)):
        return w
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))

    def loss(v: np.ndarray) -> float:
        return float((weight * np.logaddexp(0, (1 - 2 * y) * (features @ v))).sum() + 0.5 * (ridge * (v - prior) ** 2).sum())

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        grad = features.T @ (weight * (p - y)) + ridge * (w - prior)
        hess = (features * (weight * p * (1 - p))[:, None]).T @ features + np.diag(ridge)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def score_toxicity(
    records: DataFrame, labels: DataFrame, key: str = "row_ord", body: str = "desc", label: str = "toxic", most_labelled: int = 8000, threshold: float = 0.7
) -> DataFrame:
    """Score the toxicity of every decision record's text, for instance of docket comments.

    ``records`` has ``row_ord, desc``; ``labels`` has ``row_ord, toxic``.  Labels are used only of records whose
    ``crc32(row_ord as text)`` leaves a remainder other than 1 when divided by 3, and of these at most
    ``most_labelled`` (half of each class), chosen by a hash of the key.  They give a lexicon of terms and stems, and
    the weights of its hits: exact or one edit away, open or quoted, addressed to someone.  Key, language, source and
    label are never inputs of a score.

    Returns ``row_ord, held_out, score, predicted`` (1 from ``threshold`` on).  Null and empty texts get the score of
    a text without hits; null keys are carried and not held out; repeated rows stay repeated; without usable labels
    every text gets the prior's score; an empty table gives no rows; other columns are ignored.  Whole texts are read.
    """
    spark = records.sparkSession
    sample = reliable_checkpoint(spark, labelled_sample(records, labels, most_labelled, key, body, label))
    # Weights are fitted on features under a lexicon of the other half, as chance terms look perfect in their own.
    half = F.pmod(F.xxhash64("desc", F.lit("half")), F.lit(2))
    halves = [learn_lexicon(sample.filter(half == 1 - h)) for h in (0, 1)]
    apart = spark.sparkContext.broadcast(halves)

    def read(batches):
        readers = [Reader(*lexicon) for lexicon in apart.value]
        for b in batches:
            x = [readers[h].features(t.as_py()).tolist() for h, t in zip(b.column(2).to_pylist(), b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    split = sample.select("toxic", "desc", half.alias("half"))
    rows = split.mapInArrow(read, "toxic int, x array<double>").collect()  # at most most_labelled short rows
    weights = fit(np.array([r["x"] for r in rows]).reshape(-1, FEATURES), np.array([r["toxic"] for r in rows], float))
    sent = spark.sparkContext.broadcast(learn_lexicon(sample))

    def score(batches):
        reader = Reader(*sent.value)
        for b in batches:
            s = [1 / (1 + math.exp(-max(-30.0, min(30.0, float(reader.features(t.as_py()) @ weights))))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["row_ord", "score"])

    scored = records.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("desc")).mapInArrow(score, "row_ord long, score double")
    return scored.select("row_ord", held_out(F.col("row_ord")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
