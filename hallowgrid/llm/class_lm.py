"""Language model scores of record texts: a Brown-style class bigram learned by exchange clustering."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .memo import Remembered

#: Fixed sizes of the model; what is sent to tasks or the driver is bounded by them, not by the records.
TOP = 1024  # most frequent words that are clustered one by one
ENDINGS = 256  # groups of all other words, by a hash of their last three bytes
UNITS = TOP + ENDINGS
BEGIN, END = UNITS, UNITS + 1
CLASSES = 64
#: Frequent words whose counts every task knows; counts of rarer ones are joined.
HEAD = 65_536

SCORES = (
    "rid long, row_ord long, n_tokens long, n_known long, base double, score double, tail array<struct<word:string,n:int>>"
)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: bytes lower-case A-Z alone and split at ASCII blanks alone."""
    return (text or "").encode("utf-8").lower().split()


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def ending(word: Column) -> Column:
    """Group of a word, as :func:`ending_of` computes it."""
    last = F.substring(word.cast("binary"), -3, 3)
    return (F.crc32(last) % ENDINGS).cast("int") + TOP


def ending_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS + TOP


def _count_words(batches):
    counts: Counter = Counter()

    def emit():
        yield pa.RecordBatch.from_pydict({"word": pa.array([w.decode() for w in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
        counts.clear()

    for b in batches:
        for t in b.column(0):
            counts.update(words_of(t.as_py()))
            if len(counts) >= 300_000:
                yield from emit()
    yield from emit()


def word_counts(training: DataFrame) -> DataFrame:
    """``word, n`` over all training texts, summed in each task first."""
    return training.select("desc").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def unit_pairs(training: DataFrame, top: dict[bytes, int]) -> DataFrame:
    """``u, v, n``: adjacent units of all training texts, with a begin and an end; at most (UNITS + 2) squared rows."""
    size = UNITS + 2
    sent = training.sparkSession.sparkContext.broadcast(top)

    def run(batches):
        known = sent.value
        units = Remembered(lambda w: known[w] if w in known else ending_of(w))
        total = np.zeros(size * size, np.int64)
        for b in batches:
            for t in b.column(0):
                seq = np.array([BEGIN, *map(units.__getitem__, words_of(t.as_py())), END], np.int64)
                at, n = np.unique(seq[:-1] * size + seq[1:], return_counts=True)
                total[at] += n
        at = np.flatnonzero(total)
        for i in range(0, at.size, 1 << 18):
            k = at[i : i + (1 << 18)]
            yield pa.RecordBatch.from_pydict({"u": pa.array((k // size).astype(np.int32)), "v": pa.array((k % size).astype(np.int32)), "n": pa.array(total[k])})

    return training.select("desc").mapInArrow(run, "u int, v int, n long").groupBy("u", "v").agg(F.sum("n").alias("n"))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = 4) -> np.ndarray:
    """Class of each unit by exchange: every unit in turn moves to the class that raises the likelihood of class
    bigrams most, until a sweep moves none.  ``pairs`` has one row ``u, v, n`` for each pair; begin and end stay
    classes of their own.  The cost depends on the fixed numbers of units and classes only."""
    size = UNITS + 2
    m = np.zeros((size, size))
    np.add.at(m, (pairs[:, 0], pairs[:, 1]), pairs[:, 2])
    total = m.sum(0) + m.sum(1)
    rank = np.argsort(-total[:UNITS], kind="stable")
    of = np.empty(size, np.int64)
    of[rank] = np.arange(UNITS) % classes
    of[BEGIN], of[END] = classes, classes + 1
    k = classes + 2
    n = np.zeros((k, k))
    np.add.at(n, (of[pairs[:, 0]], of[pairs[:, 1]]), pairs[:, 2])

    def f(x):
        return x * np.log(np.maximum(x, 1e-300))

    for _ in range(sweeps):
        moved = 0
        for u in rank:
            if total[u] == 0:
                continue
            own = m[u, u]
            r, left = np.bincount(of, m[u], k), np.bincount(of, m[:, u], k)
            r[of[u]] -= own
            left[of[u]] -= own
            was = of[u]
            n[was] -= r
            n[:, was] -= left
            n[was, was] -= own
            rows, cols = n.sum(1), n.sum(0)
            gain = (f(n + r) - f(n)).sum(1) + (f(n + left[:, None]) - f(n)).sum(0)
            d = np.diag(n)
            gain += f(d + r + left + own) + f(d) - f(d + r) - f(d + left)
            gain -= f(rows + r.sum() + own) - f(rows) + f(cols + left.sum() + own) - f(cols)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[was] + 1e-9:
                best = was
            moved += best != was
            of[u] = best
            n[best] += r
            n[:, best] += left
            n[best, best] += own
        if not moved:
            break
    return of


@dataclass
class Model:
    """What a task needs to score: bounded by HEAD, UNITS and CLASSES."""

    head: dict[bytes, int]  # word to its place in the arrays below
    head_unit: np.ndarray
    head_count: np.ndarray
    unit_class: np.ndarray
    arrive: np.ndarray  # log10 of a class after a class
    emit: np.ndarray  # log10 of a unit in its class
    spread: np.ndarray  # log10 of a unit's words and one unknown, smoothed
    base: float  # log10 of the divisor of the base
    ends: int  # training texts


def build(head: list, pairs: np.ndarray, sizes: dict[int, tuple[int, int]], texts: int, tokens: int, distinct: int, classes: int) -> Model:
    of = exchange(pairs, classes)
    k = classes + 2
    n = np.zeros((k, k))
    np.add.at(n, (of[pairs[:, 0]], of[pairs[:, 1]]), pairs[:, 2])
    one = n.sum(0) + 1
    one[classes] = 0  # nothing returns to the begin
    arrive = (n + one / one.sum()) / (n.sum(1, keepdims=True) + 1)
    seen = np.zeros(UNITS + 2)
    np.add.at(seen, pairs[:, 1], pairs[:, 2])
    in_class = np.bincount(of[:UNITS], seen[:UNITS] + 1, k)
    emit = np.zeros(UNITS + 2)
    emit[:UNITS] = np.log10((seen[:UNITS] + 1) / in_class[of[:UNITS]])
    spread = np.zeros(UNITS + 2)
    for u in range(TOP, UNITS):
        count, words = sizes.get(u, (0, 0))
        spread[u] = np.log10(count + words + 1)
    units = [i if i < TOP else ending_of(w.encode()) for i, (w, _) in enumerate(head)]
    with np.errstate(divide="ignore"):
        arrive = np.log10(arrive)
    return Model(
        {w.encode(): i for i, (w, _) in enumerate(head)},
        np.array(units, np.int64),
        np.array([c for _, c in head], np.float64),
        of,
        arrive,
        emit,
        spread,
        float(np.log10(tokens + distinct + 1)),
        texts,
    )


def scorer(sent):
    def run(batches):
        m: Model = sent.value
        codes = Remembered(lambda w: m.head[w] if w in m.head else -ending_of(w))
        log_count = np.log10(m.head_count + 1)
        for b in batches:
            out = []
            for rid, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ws = words_of(text.as_py())
                listed = list(map(codes.__getitem__, ws))
                code = np.array(listed, np.int64)
                rare = code < 0
                place = np.where(rare, 0, code)
                unit = np.where(rare, -code, m.head_unit[place] if m.head_unit.size else 0)
                seq = m.unit_class[np.r_[BEGIN, unit, END]]
                known = ~rare
                counts = log_count[code[known]]
                grouped = unit[known] >= TOP
                score = m.arrive[seq[:-1], seq[1:]].sum() + m.emit[unit].sum() - m.spread[unit].sum() + counts[grouped].sum()
                base = counts.sum() + np.log10(m.ends + 1) - (len(ws) + 1) * m.base
                tail = Counter(w for w, c in zip(ws, listed) if c < 0)
                out.append((rid, key, len(ws) + 1, int(known.sum()) + (m.ends > 0), float(base), float(score), [{"word": w.decode(), "n": n} for w, n in tail.items()]))
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))]
            names = ["rid", "row_ord", "n_tokens", "n_known", "base", "score", "tail"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return run


def score_texts(records: DataFrame, key: str = "row_ord", body: str = "desc", classes: int = CLASSES) -> DataFrame:
    """Log10 probability of every decision record's text under a class bigram model of the training records.

    ``records`` has ``row_ord`` and ``desc``; training leaves out rows whose ``crc32(row_ord as text)`` has the
    remainder 2 when divided by 7.  The 1,024 most frequent words, and groups of all others by their ending, are put
    into classes by exchange; a word's probability is that of its class after the one before, of its unit in the
    class, and in a group of ``(c + 1) / (n + v + 1)`` over the group's words and one unknown.  Every text begins
    anew and has one end token.

    Word counts and unit bigrams are over all training texts.  Counts of rare words are joined, so nothing that grows
    with the vocabulary is sent to tasks; the frequent 65,536, which hold most tokens, are known to each task, so no
    key of the join is hot.

    Returns ``row_ord, held_out, n_tokens, n_known, train_tokens, base_score, score``; ``base_score`` is the add-one
    unigram.  Null and empty texts have the end token alone; null keys are training rows; repeated rows count as often
    as they occur and stay repeated; without training rows all counts are zero; an empty table gives no rows; other
    columns are ignored.
    """
    spark = records.sparkSession
    docs = records.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("desc"))
    training = docs.filter(~held_out(F.col("row_ord")))
    counts = reliable_checkpoint(spark, word_counts(training))
    texts = training.count()
    totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = (totals[0] or 0) + texts, totals[1] + (texts > 0)
    head = [(r["word"], r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(HEAD).collect()]  # HEAD rows at most
    top = {w.encode(): i for i, (w, _) in enumerate(head[:TOP])}
    table = unit_pairs(training, top).toArrow()  # (UNITS + 2)^2 rows at most
    pairs = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("u", "v", "n")], axis=1)
    grouped = counts.limit(0)
    if len(head) > TOP:  # the words after the last of the top, in the same order
        last, n = head[TOP - 1]
        grouped = counts.filter((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > last)))
    sizes = {r["u"]: (r["n"], r["v"]) for r in grouped.groupBy(ending(F.col("word")).alias("u")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    sent = spark.sparkContext.broadcast(build(head, pairs, sizes, texts, tokens, distinct, classes))

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "row_ord", "desc")
    scored = reliable_checkpoint(spark, rows.mapInArrow(scorer(sent), SCORES))
    tail = scored.select("rid", F.explode("tail").alias("t")).select("rid", "t.word", F.col("t.n").alias("times"))
    logs = tail.join(counts, "word").groupBy("rid").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"), F.sum("times").alias("known")
    )
    d = scored.drop("tail").join(logs, "rid", "left")
    more = F.coalesce("logs", F.lit(0.0))
    return d.select(
        "row_ord",
        held_out(F.col("row_ord")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
