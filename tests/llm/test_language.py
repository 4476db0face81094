import math
import random
import zlib
from collections import Counter

import numpy as np

from hallowgrid.llm import language as lang
from hallowgrid.llm.language import Model, codewords, detect_languages, grams, learn_languages, news_languages
from hallowgrid.llm.queries import QUERIES


def plain_grams(text):
    """N-grams of one text, letter by letter."""
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = " " + " ".join(s.split()) + " " if s.split() else ""
    return Counter(g for n in lang.ORDERS for g in (s[i : i + n] for i in range(len(s) - n + 1)) if " " not in g[1:-1] and g.strip())


def test_grams_agree_with_plain_ones():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abÉç 1,.\n漢😀\x00İ") for _ in range(rnd.randint(0, 30))) for _ in range(200)] + ["", None, "a", "12"]
    seen = {}
    for n, (of, bucket) in zip(lang.ORDERS, grams(texts)):
        assert (np.diff(of) >= 0).all()
        for k, t in enumerate(texts):
            want = Counter({g: c for g, c in plain_grams(t).items() if len(g) == n})
            own = Counter(bucket[of == k].tolist())
            assert sum(own.values()) == sum(want.values())
            if len(want) == 1:
                (g,) = want
                assert own == {seen.setdefault(g, next(iter(own))): want[g]}


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 7, 20, 100):
        c = codewords(n)
        assert set(np.unique(c)) == {-1, 1} and (abs(c.sum(axis=0)) < n).all()
        apart = [(c[i] != c[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n == 2 else 2 if n == 3 else c.shape[1] // 4)
    assert codewords(1).shape == (1, 0) and codewords(0).shape == (0, 0)


def test_decoding_agrees_with_plain_loss():
    rnd = np.random.default_rng(4)
    codes = codewords(4)
    m = Model(list("abcd"), codes, rnd.normal(size=(lang.BUCKETS, 7)).astype(np.float32), rnd.uniform(0.5, 2, 7))
    texts = ["grave marker", "pierre tombale", "", "12", "x"]
    pred, score = m.decode(texts)
    for k, t in enumerate(texts):
        buckets = [b for of, bucket in grams([t]) for b in bucket.tolist()]
        if not buckets:
            assert (pred[k], score[k]) == ("und", 0)
            continue
        margin = m.weights[buckets].astype(float).mean(axis=0) / m.strength
        share = m.strength / m.strength.sum()
        loss = [sum(s * math.log1p(math.exp(-4 * c * x)) for s, c, x in zip(share, code, margin)) for code in codes]
        assert pred[k] == "abcd"[int(np.argmin(loss))]
        assert abs(score[k] - 1 / sum(math.exp(-4 * (x - min(loss))) for x in loss)) < 1e-5


def test_counts_agree_with_plain_ones(spark):
    rows = [("en", "the grave of the fathers"), ("en", "a marker near the old wall"), ("fr", "la tombe du père"), ("de", "das alte Grab"), (None, "no language"), ("es", None), ("it", "123")]
    model = learn_languages(spark.createDataFrame(rows, "lang string, snippet string"))
    assert model.langs == ["de", "en", "fr"] and model.codes.shape == (3, 3)
    p = {}
    for x in model.langs:
        c = np.zeros(lang.BUCKETS)
        for y, t in rows:
            if x == y:
                for _, bucket in grams([t]):
                    np.add.at(c, bucket, 1)
        p[x] = (c + lang.SMOOTH) / (c.sum() + lang.SMOOTH * lang.BUCKETS)
    for b in range(3):
        one, other = ([p[x] for x, c in zip(model.langs, model.codes[:, b]) if c == s] for s in (1, -1))
        assert np.allclose(model.weights[:, b], np.log(np.mean(one, axis=0) / np.mean(other, axis=0)), atol=1e-5)


def test_awkward_items(spark, awkward):
    news = awkward.withColumnRenamed("desc", "snippet")
    out = news_languages(news).collect()
    assert len(out) == 10
    for r in out:
        assert 0 <= r.score <= 1 and r.held_out == (r.row_ord is not None and zlib.crc32(str(r.row_ord).encode()) % 4 == 2)
    assert Counter(r.lang_pred == "und" for r in out) == {True: 4, False: 6}
    assert news_languages(news.limit(0)).count() == 0
    assert {r.lang_pred for r in news_languages(news.selectExpr("row_ord", "snippet", "cast(null as string) lang")).collect()} == {"und"}
    one = news_languages(news.selectExpr("row_ord", "snippet", "'xx' lang")).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("xx", 1.0), ("und", 0.0)}


def test_mixed_text_is_ambiguous_and_many_languages_are_told_apart(spark):
    rnd = random.Random(7)
    parts = {f"l{k:02}": ["".join(rnd.choice("abcdefghijklmnop") for _ in range(3)) for _ in range(12)] for k in range(20)}
    text = lambda k, n=30: " ".join("".join(rnd.choices(parts[k], k=2)) for _ in range(n))
    rows = [(k, x, text(x)) for k in range(30) for x in parts]
    model = learn_languages(spark.createDataFrame(rows, "row_ord long, lang string, snippet string"))
    tests = [(i, x, text(x)) for i, x in enumerate([*parts] * 5)]
    got = {r.row_ord: r for r in detect_languages(spark.createDataFrame(tests, "row_ord long, lang string, snippet string"), model).collect()}
    assert all(got[i].lang_pred == x for i, x, _ in tests)
    both = detect_languages(spark.createDataFrame([(1, text("l01", 40) + " " + text("l02", 40))], "row_ord long, snippet string"), model).first()
    assert both.ambiguous and both.lang_pred in ("l01", "l02")


def test_held_out_accuracy(spark, sf):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op13_language_id"](spark, sf).collect()
    assert len(out) == len(truth)
    held = [r for r in out if r.held_out and any(c.isalpha() for c in truth[r.doc_id][1] or "")]
    right = sum(r.lang_pred == truth[r.doc_id][0] for r in held)
    assert right >= 0.98 * len(held) > 0
