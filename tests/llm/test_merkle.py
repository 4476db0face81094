import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hallowgrid.llm.merkle import FIELDS, news_manifest


def loud():
    return {"snippet": F.upper("snippet")}


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digest(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root of a tree, and the (left, right) siblings of every leaf on its way there."""
    paths, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        nxt, own = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k : k + 8]
            for i, who in enumerate(owners[k : k + 8]):
                for leaf in who:
                    paths[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
            nxt.append(h("".join(run)))
            own.append([leaf for who in owners[k : k + 8] for leaf in who])
        nodes, owners = nxt, own
    return nodes[0], paths


def plain(rows):
    """Rows of (row_ord, name, lang, sig, snippet)."""
    shelves = {}
    for r in rows:
        shelves.setdefault(r[2], []).append(r)
    names = sorted(shelves, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for s in names:
        own = sorted(shelves[s], key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        trees.append((own, *climb([digest(r) for r in own])))
    root, above = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), up in zip(trees, above):
        for r, path in zip(own, paths):
            path = path + up
            folded = digest((*r[:4], None if r[4] is None else r[4].upper()))
            for left, right in path:
                folded = h(left + folded + right)
            out.append((r[0], digest(r), subroot, root, tuple(path), h("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=str)


def got(df):
    return sorted(((*r[:4], tuple((s.left, s.right) for s in r.path), *r[5:]) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "row_ord long, name string, lang string, sig long, snippet string")


@pytest.mark.parametrize("counts", [{"en": 1}, {"en": 8}, {"en": 9, "fr": 1}, {"en": 130, "de": 65, None: 8, "": 1, "zz": 2}])
def test_trees_of_many_shapes(spark, counts):
    rnd = random.Random(len(counts))
    rows = [(k * 7 % 1009, "Feed", lang, k, "grave" if k % 3 else "GRAVE é") for lang, n in counts.items() for k in range(n)]
    rnd.shuffle(rows)
    assert got(news_manifest(frame(spark, rows), received=loud())) == plain(rows)


def test_many_shelves(spark):
    rows = [(k, None, f"l{k % 70}", None, None) for k in range(200)]
    assert got(news_manifest(frame(spark, rows), received=loud())) == plain(rows)


def test_awkward_items(spark, awkward):
    news = awkward.select("row_ord", F.col("source").alias("name"), "lang", F.length("desc").cast("long").alias("sig"), F.col("desc").alias("snippet"), F.lit(1).alias("pos"), F.lit("x").alias("tree"), F.lit("y").alias("hash"))
    rows = [tuple(r) for r in news.select(*FIELDS).collect()] + [(None, None, None, None, None)] * 40
    news = news.unionByName(frame(spark, rows[-40:]), allowMissingColumns=True)
    assert got(news_manifest(news, received=loud())) == plain(rows)
    assert all(r.verified for r in news_manifest(news).collect())
    assert news_manifest(news.limit(0)).count() == 0
