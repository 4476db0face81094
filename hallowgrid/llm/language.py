"""Languages of news items: n-gram classifiers for the bits of language codewords, decoded by weighted loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, small_table

#: Lengths of the letter runs that are counted, with the blanks around words, and the buckets they are hashed to.
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Added to each bucket's count.
SMOOTH = 0.5
#: Codewords: up to so many languages every split of them is a bit, beyond that so many bits per doubling.
EXHAUSTIVE, BITS = 6, 10
#: Loss of a bit: log(1 + exp(-STEEP * margin)), 1 being the margin of an average text of the bit's side.
STEEP = 4.0
#: A prediction below this score is ambiguous.
SURE = 0.9
UNKNOWN = "und"
#: Letters of text, and cells of the gathered weights, that are worked on at once.
BLOCK, CELLS = 1 << 20, 1 << 22
#: Languages a task counts before it hands over what it has.
HELD = 64

_LETTERS: list[np.ndarray] = []
SCHEMA = "row_ord long, lang_pred string, score double, ambiguous boolean"


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str | None]):
    """Owner and bucket of every n-gram of a list of texts, order by order; owners ascend.

    Letters are lower-cased; whatever lies between them is one blank, which n-grams may have at their ends only.
    """
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.r_[0, np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])]
    letter = _letters()[codes]
    kept = letter | np.r_[True, letter[:-1]]  # the first blank after a word stays
    codes, owner, letter = codes[kept].astype(np.uint64), owner[kept], letter[kept]
    codes[~letter] = 0
    hashed = codes.copy()
    for n in ORDERS:
        if n > 1:
            if hashed.size < 2:
                return
            hashed = hashed[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        inner = np.ones(hashed.size, bool)
        for k in range(1, n - 1):
            inner &= letter[k : k + hashed.size]
        if n == 1:
            inner &= letter
        at = np.flatnonzero(inner)
        # A shared blank belongs to the text of the letter beside it.
        of = owner[at + ~letter[at]]
        mixed = (hashed[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        yield of, ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64) % BUCKETS


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 for each of n languages.

    Few languages get every split into two sides; more get random even splits, each the best of 32 for the closest
    pair of rows so far.
    """
    if n <= 1:
        return np.ones((n, 0), int)
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))  # the first language's side is +1
        return np.array([np.ones(splits.size, int), *(1 - 2 * (splits >> k & 1) for k in range(n - 1))])
    rng, side = np.random.default_rng(n), np.where(np.arange(n) < n // 2, -1, 1)
    bits, agree = BITS * int(np.ceil(np.log2(n))), np.zeros((n, n))
    np.fill_diagonal(agree, -np.inf)
    out = []
    for _ in range(bits):
        tries = [rng.permutation(side) for _ in range(32)]
        both = [agree + np.outer(t, t) for t in tries]
        best = min(range(32), key=lambda k: (both[k].max(), (both[k] == both[k].max()).sum()))
        agree = both[best]
        out.append(tries[best])
    return np.array(out).T


@dataclass(frozen=True)
class Model:
    """Languages with their codewords; weights of buckets for bits, and what an average text of a bit's side scores."""

    langs: list[str]
    codes: np.ndarray
    weights: np.ndarray
    strength: np.ndarray

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Mean weight of each text's n-grams for every bit, and the number of n-grams."""
        total, n = np.zeros((len(texts), self.codes.shape[1])), np.zeros(len(texts), np.int64)
        step = max(1, CELLS // max(1, self.codes.shape[1]))
        for of, bucket in grams(texts):
            n += np.bincount(of, minlength=len(texts))
            for k in range(0, of.size, step):
                own, w = of[k : k + step], self.weights[bucket[k : k + step]]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                total[own[first]] += np.add.reduceat(w, first, axis=0, dtype=np.float64)
        return total / np.maximum(n, 1)[:, None], n

    def decode(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the codeword of least loss, bits weighted by their strength."""
        margin, n = self.margins(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        share = self.strength / self.strength.sum() if self.strength.size else self.strength
        scaled = margin / np.where(self.strength > 0, self.strength, 1.0) * STEEP
        agree, differ = np.logaddexp(0, -scaled) * share, np.logaddexp(0, scaled) * share
        loss = agree @ (self.codes.T > 0) + differ @ (self.codes.T < 0)
        best = loss.argmin(axis=1)
        gap = loss - loss.min(axis=1, keepdims=True)
        score = 1.0 / np.exp(-STEEP * gap).sum(axis=1)
        pred = [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())]
        return pred, np.where(n > 0, np.round(score, 6), 0.0)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _blocks(batch: pa.RecordBatch, body: int):
    """Slices of a batch of about ``BLOCK`` letters; a longer text is alone."""
    lo = size = 0
    for i, t in enumerate(batch.column(body)):
        n = 64 + len(t.as_py() or "")
        if size and size + n > BLOCK:
            yield batch.slice(lo, i - lo)
            lo, size = i, 0
        size += n
    if batch.num_rows > lo:
        yield batch.slice(lo)


def _counted(batches):
    held: dict[str, np.ndarray] = {}

    def done():
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size, pa.string()), pa.array(at, pa.int32()), pa.array(n[at])], ["lang", "bucket", "n"])
        held.clear()

    for batch in batches:
        for part in _blocks(batch, 1):
            langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            names = {lang: k for k, lang in enumerate(dict.fromkeys(langs))}
            row = np.array([names[x] for x in langs], np.int64)
            found = list(grams(texts))
            for lang, k in names.items():
                if len(held) >= HELD and lang not in held:
                    yield from done()
                total = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for of, bucket in found:
                    total += np.bincount(bucket[row[of] == k] if len(names) > 1 else bucket, minlength=BUCKETS)
    yield from done()


def learn_languages(news: DataFrame, body: str = "snippet", label: str = "lang") -> Model:
    """Classifiers of all bits from the n-gram counts of every labelled news item.

    Counts are added up by language and bucket, then by bit and side: a side is the even mixture of its languages, so
    that a frequent language does not outweigh the others, and a bucket's weight is the logarithm of the sides' odds.
    What reaches the driver is one row for each language and ``BUCKETS`` rows of the bits.
    """
    given = news.select(F.col(label).cast("string").alias("lang"), F.col(body).alias("snippet")).filter("lang IS NOT NULL AND snippet IS NOT NULL")
    counts = given.mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = reliable_checkpoint(news.sparkSession, counts)
    sizes = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sizes)
    codes = codewords(len(langs))
    bits = codes.shape[1]
    if not bits:
        return Model(langs, codes, np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    side = np.where(codes > 0, 1, 0)
    on = side / side.sum(axis=0)
    off = (1 - side) / (1 - side).sum(axis=0)
    scale = 1.0 / (np.array([sizes[x] for x in langs], float) + SMOOTH * BUCKETS)
    rows = [(x, [float(v) for v in (np.r_[on[k], off[k]] * scale[k])]) for k, x in enumerate(langs)]
    shares = small_table(news.sparkSession, rows, "lang string, share array<double>")
    sums = [F.sum(F.col("n") * F.col("share")[b]).alias(f"s{b}") for b in range(2 * bits)]
    table = counts.join(shares, "lang").groupBy("bucket").agg(*sums).toArrow()
    p = np.zeros((BUCKETS, 2 * bits))
    p[table.column("bucket").to_numpy()] = np.column_stack([table.column(f"s{b}").to_numpy() for b in range(2 * bits)])
    p += SMOOTH * (np.c_[on, off] * scale[:, None]).sum(axis=0)
    one, other = p[:, :bits], p[:, bits:]
    weights = np.log(one / other)
    strength = np.minimum((one * weights).sum(axis=0), -(other * weights).sum(axis=0))
    return Model(langs, codes, weights.astype(np.float32), strength)


def detect_languages(news: DataFrame, model: Model, key: str = "row_ord", body: str = "snippet") -> DataFrame:
    """``row_ord, lang_pred, score, ambiguous`` of every news item by a learned model; see :func:`news_languages`."""
    sent = news.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in _blocks(batch, 1):
                pred, score = sent.value.decode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(score < SURE)], ["row_ord", "lang_pred", "score", "ambiguous"])

    return news.select(F.col(key).cast("long").alias("row_ord"), F.col(body).alias("snippet")).mapInArrow(run, SCHEMA)


def news_languages(news: DataFrame, key: str = "row_ord", body: str = "snippet", label: str = "lang") -> DataFrame:
    """Language of every news item, learned from the items that state one.

    ``news`` are news items (``row_ord, lang, snippet``).  Every item with a ``lang`` is learned from unless
    ``crc32(row_ord as text)`` leaves a remainder of 2 when divided by 4; a prediction reads the text alone.  Languages
    get codewords, a classifier of letter n-grams predicts each bit, and the codeword of least loss wins, bits weighted
    by how far they tell their sides apart.

    Returns ``row_ord, held_out, lang_pred, score`` (0 to 1, the winner's share) and ``ambiguous`` (score below
    ``SURE``: another codeword is nearly as close).  A text that is null, empty or without a letter is ``und`` with
    score 0 and ambiguous, and so is every text if no item states a language; a single language is always predicted.
    Null keys are carried and not held out; repeated rows stay repeated; ties go to the first language by name; an
    empty table gives no rows; other columns are ignored.  Texts of any length are read whole.
    """
    model = learn_languages(news.filter(~held_out(F.col(key))), body, label)
    found = detect_languages(news, model, key, body)
    return found.select("row_ord", held_out(F.col("row_ord")).alias("held_out"), "lang_pred", "score", "ambiguous")
