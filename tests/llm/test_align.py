import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hallowgrid.llm import align
from hallowgrid.llm.queries import QUERIES

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = "abcdeéñ ßİſ\n\t  's't'reN1٣Ⅷ漢😀.,!?\u0301\u200b\x85\x1c\x1d\u2028\u3000\u180e\ufeff\u2028\xa0\u2581\r"


@pytest.fixture(scope="module")
def pair():
    return align.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read(), most=2_000)


def plain(pair, text):
    """Groups of a whole text by both libraries, token by token."""
    if not text:
        return []
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    sides, want = [[pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]], (" " + text).encode()
    if any(b"".join(s) != want for s in sides):
        return []
    ends = [np.cumsum([len(w) for w in s]).tolist() for s in sides]
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        i2, j2 = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        out.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    return out


def written(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


def want(pair, rows):
    found = [(k, plain(pair, t)) for k, t in rows]
    links = [Counter((x, y) for a, b in gs for x in a for y in b) for _, gs in found]
    count = Counter(p for ls in links for p in ls)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (k, gs), ls in zip(found, links):
        n_best = sum(n for p, n in ls.items() if count[p] == best[p[0]])
        row = (sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), ls.total(), n_best, sum(n * count[p] for p, n in ls.items()))
        out.append((k if k is not None else -1, *row, hashlib.sha256(written(gs).encode()).hexdigest() if gs else ""))
    return sorted(out), count


def got(df):
    return sorted((r.row_ord if r.row_ord is not None else -1, *r[1:]) for r in df.collect())


def test_units_agree_with_whole_texts(pair):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rnd.choice("ab \n漢é.") for _ in range(rnd.randint(0, 60))) for _ in range(1000)]
    texts += ["x ", "  ", " ", "\n", "a\n", "\n\na  b   c ", "<s> hi <|endoftext|> </s>", "a" * 5000, "漢" * 3000, None, ""]
    for k in range(0, len(texts), 500):
        part = texts[k : k + 500]
        block = pair.block(part)
        assert [block.groups(i) for i in range(len(part))] == [written(plain(pair, t)) for t in part]


def test_products_by_rows_agree_with_dense_ones(monkeypatch):
    monkeypatch.setattr(align, "SPREAD", 7)
    rnd = np.random.default_rng(3)
    for n, m, k in ((5, 4, 6), (9, 1, 3), (1, 8, 2)):
        a, b = (rnd.integers(0, 3, s) * rnd.integers(0, 2, s) for s in ((n, m), (m, k)))

        def csr(x):
            r, c = np.nonzero(x)
            return align.Csr.of(r[::-1], c[::-1], x[r, c][::-1], *x.shape)

        out = np.zeros((n, k), int)
        i, j, v = align._entries(csr(a), csr(b), k)
        out[i, j] = v
        assert (out == a @ b).all()


def test_records_with_awkward_texts(spark, awkward, pair, monkeypatch):
    monkeypatch.setattr(align, "CHUNK", 300)
    rows = [(r.row_ord, r.desc) for r in awkward.collect()]
    rnd = random.Random(9)
    rows += [(100 + k, "".join(rnd.choice("ab the\n of,Grave. 漢é") for _ in range(rnd.randint(0, 90)))) for k in range(60)]
    rows += [(200, "see \u2581 here"), (201, "aaaa " * 30), (201, "aaaa " * 30)]
    df = spark.createDataFrame(rows, "row_ord long, desc string").selectExpr("*", "'x' as chunk", "1 as pair", "2 as n").repartition(3)
    expected, count = want(pair, rows)
    assert got(align.align_records(df, A, B)) == expected
    assert {(r.a_id, r.b_id): r.n for r in align.link_counts(df, A, B).collect()} == count
    groups = [(r.row_ord, [(list(g.a), list(g.b)) for g in r.groups], r.a_ids) for r in align.aligned_groups(df, A, B).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]))
    assert [g[:2] for g in sorted(groups, key=key)] == sorted(((k, plain(pair, t)) for k, t in rows), key=key)
    assert all(ids == [i for a, _ in gs for i in a] for _, gs, ids in groups)
    assert align.align_records(df.limit(0), A, B).count() == align.link_counts(df.limit(0), A, B).count() == 0


def test_query_agrees_with_brute_force(spark, sf, pair):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    df = QUERIES["op11_token_alignment"](spark, sf)
    assert df.columns == ["doc_id", *align.DIGESTS.replace(",", "").split()[2::2]]
    assert got(df.withColumnRenamed("doc_id", "row_ord")) == want(pair, [(r.doc_id, r.text) for r in docs])[0]
