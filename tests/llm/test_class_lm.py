import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hallowgrid.llm import class_lm
from hallowgrid.llm.class_lm import exchange, score_texts

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None]


def held(k):
    return k is not None and zlib.crc32(str(k).encode()) % 7 == 2


def plain(docs):
    c = Counter(w for k, t in docs if not held(k) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    rows = []
    for k, t in docs:
        ws = tokens(t)
        rows.append((k, held(k), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)))
    return rows


def same(rows, docs):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r)[:6] for r in rows), key=key), sorted(plain(docs), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(6)
    tongues = [[f"{a}{b}{c}" for a in s for b in "aeiou" for c in s] for s in ("bdgk", "lmnr", "fstv")]
    out = []
    for i in range(700):
        words = tongues[i % 3]
        out.append((i, " ".join(words[min(int(rnd.expovariate(0.12)), len(words) - 1)] + rnd.choice(["", "", "", "X", str(rnd.randint(0, 40))]) for _ in range(rnd.randint(5, 60)))))
    return out


def test_base_agrees_and_classes_help(spark, docs, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", 90)  # most counts come from the join
    rows = score_texts(spark.createDataFrame(docs, "row_ord long, desc string"), classes=8).collect()
    same(rows, docs)
    out = [r for r in rows if r.held_out]
    assert len(out) > 50 and all(r.score <= 0 for r in rows)
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_one_word_texts_share_a_probability_below_one(spark, docs):
    """All one-word texts of the vocabulary together have a probability below one."""
    vocabulary = sorted({w for k, t in docs if not held(k) for w in tokens(t)[:-1]})
    free = [k for k in range(10_000, 100_000) if held(k)]
    probes = list(zip(free, vocabulary))
    rows = score_texts(spark.createDataFrame(docs + probes, "row_ord long, desc string"), classes=8)
    scored = {r.row_ord: r for r in rows.collect() if r.row_ord >= 10_000}
    assert len(scored) == len(vocabulary) and all(r.n_known == r.n_tokens == 2 for r in scored.values())
    assert sum(10**r.score for r in scored.values()) < 1


def test_exchange_separates_two_tongues():
    rnd = np.random.default_rng(1)
    pairs = [(a, b, int(rnd.integers(20, 40))) for s in (range(0, 10), range(10, 20)) for a in s for b in s]
    of = exchange(np.array(pairs), classes=2)
    assert len(set(of[:10])) == len(set(of[10:20])) == 1 and of[0] != of[10]


def test_awkward_rows(spark, awkward, docs):
    rows = score_texts(awkward).collect()
    same(rows, [(r.row_ord, r.desc) for r in awkward.collect()])
    assert score_texts(awkward.limit(0)).count() == 0
    alone = [(k, t) for k, t in docs if held(k)][:5]
    same(score_texts(spark.createDataFrame(alone, "row_ord long, desc string")).collect(), alone)
