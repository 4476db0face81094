import hashlib
import random
import re

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hallowgrid.llm import decontaminate
from hallowgrid.llm.decontaminate import contaminated_records, proximity_hits

P = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return P.findall((t or "").translate(LOW))


def plain(text, items):
    ws, hit, named = words(text), set(), set()
    for k, t in items:
        iw = words(t)
        wide = min(10, len(iw))
        for s in range(len(iw) - wide + 1 if iw else 0):
            for p in range(len(ws) - wide + 1):
                if ws[p : p + wide] == iw[s : s + wide]:
                    hit |= set(range(p, p + wide))
                    named.add(k)
    joined = ",".join(sorted(str(k) for k in named if k is not None))
    return (len(ws), len(hit), len(named - {None}), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))


def check(spark, docs, items):
    rec = spark.createDataFrame(docs, "row_ord long, desc string")
    ben = spark.createDataFrame(items, "row_ord long, desc string")
    got = contaminated_records(rec, ben).collect()
    assert len(got) == len(docs)
    want = sorted(((k is None, k or 0), plain(t, items)) for k, t in docs)
    assert sorted(((r.row_ord is None, r.row_ord or 0), tuple(r)[1:6]) for r in got) == want


def test_hits_agree_with_brute_force(spark):
    rnd = random.Random(4)
    vocab = ["grave", "the", "of", "Église", "42", "wall", "a", "Stone"]
    line = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, line(rnd.choice([1, 2, 3, 9, 10, 11, 14, 25]))) for i in range(25)]
    docs = []
    for i in range(80):
        t = line(rnd.randint(0, 40))
        if rnd.random() < 0.6:
            t += "," + items[rnd.randrange(25)][1].upper().replace("É", "É") + "; " + line(3)
        docs.append((i, t))
    check(spark, docs, items)


def test_awkward_rows(spark, awkward):
    docs = [(r.row_ord, r.desc) for r in awkward.collect()]
    items = [(1, "car park. Burial"), (1, "car park. Burial"), (2, ""), (3, None), (None, "found below"), (4, "the old chapel wall grave marker near the old chapel wall grave"), (5, "absent words")]
    check(spark, [d for d in docs if d[0] != 5], items)
    ben = spark.createDataFrame(items, "row_ord long, desc string")
    long = contaminated_records(awkward, ben).filter("row_ord = 5").first()
    assert (long.n_words, long.n_items, long.contaminated) == (21000, 1, True) and long.n_hit >= 20990
    assert contaminated_records(awkward.limit(0), ben).count() == 0
    assert contaminated_records(awkward, ben.limit(0)).filter("contaminated").count() == 0


def near(docs, items, slack=2, share=0.8):
    texts = [(k, words(t)) for k, t in docs]
    counts = Counter(w for _, ws in texts for w in ws)
    found = set()
    for item, t in items:
        iw = words(t)
        wide = min(10, len(iw))
        for s in range(len(iw) - wide + 1 if iw else 0):
            run = iw[s : s + wide]
            there = [i for i in range(wide) if counts[run[i]]]
            if len(there) < share * wide:
                continue
            picks = sorted(sorted(there, key=lambda i: (counts[run[i]], i))[:2])
            for k, ws in texts:
                for at, w in enumerate(ws):
                    if w != run[picks[0]]:
                        continue
                    if wide > 1:
                        gap = picks[1] - picks[0]
                        if run[picks[1]] not in ws[at + max(gap - slack, 1) : at + gap + slack + 1]:
                            continue
                    start = at - picks[0]
                    n = sum(run[i] in ws[max(start + i - slack, 0) : max(start + i + slack + 1, 0)] for i in range(wide))
                    if n >= share * wide:
                        found.add((k, str(item), start, wide))
    return found


def test_near_matches_agree_with_brute_force(spark):
    rnd = random.Random(8)
    vocab = [f"word{i}" for i in range(40)] + ["the"] * 10
    line = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(line(rnd.choice([1, 2, 5, 10, 14, 30])))) for i in range(20)]
    docs = []
    for i in range(60):
        copy = words(items[rnd.randrange(20)][1])
        for p in range(4, len(copy), 7):  # a word put in, left out or changed in every ten
            copy[p : p + rnd.choice([0, 1, 1])] = rnd.choice([[], ["other"], ["put", "in"]])
        docs.append((i, " ".join(line(rnd.randint(0, 20)) + copy + line(5))))
    rec = spark.createDataFrame(docs, "row_ord long, desc string")
    ben = spark.createDataFrame(items, "row_ord long, desc string")
    want = near(docs, items)
    keys = rec.select(F.col("row_ord").alias("did"), F.xxhash64("desc").alias("dhash"), "row_ord")
    got = proximity_hits(rec, ben).join(keys, ["did", "dhash"]).select("row_ord", "item", "pos", "wide").collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == want
    rows = {r.row_ord: r for r in contaminated_records(rec, ben).collect()}
    assert {k: r.n_near for k, r in rows.items()} == {k: len({i for d, i, _, _ in want if d == k}) for k, _ in docs}
    assert all(r.n_near >= r.n_items for r in rows.values()) and any(r.n_near > r.n_items for r in rows.values())


def test_a_changed_passage_is_near_though_no_window_is_whole(spark):
    item = [f"term{i}" for i in range(40)]
    copy = [w if i % 8 else "changed" for i, w in enumerate(item)]
    ben = spark.createDataFrame([(1, " ".join(item))], "row_ord long, desc string")
    for text, want in ((copy, (0, 1)), (item[::-1], (0, 0)), (item, (1, 1))):
        row = contaminated_records(spark.createDataFrame([(1, " ".join(text))], "row_ord long, desc string"), ben).first()
        assert (row.n_items, row.n_near) == want


def test_repetitive_items_take_linear_work(spark):
    n = 10_000
    docs = [(1, "grave " * n), (2, "grave wall " * n), (3, "wall " * 9)]
    items = [(1, "grave " * n), (2, "wall grave " * n)]
    rec = spark.createDataFrame(docs, "row_ord long, desc string")
    got = contaminated_records(rec, spark.createDataFrame(items, "row_ord long, desc string")).orderBy("row_ord").collect()
    assert [(r.n_words, r.n_hit, r.n_items) for r in got] == [(n, n, 1), (2 * n, 2 * n, 1), (9, 0, 0)]


@pytest.mark.parametrize("few, stays", [(16_000_000, True), (0, False)])
def test_only_postings_of_wanted_words_travel(spark, monkeypatch, few, stays):
    """Few wanted words are sent to the texts, whatever the threshold; many are met by a shuffle, with equal results."""
    monkeypatch.setattr(decontaminate, "_FEW", few)
    words = [f"w{k}" for k in range(40)]
    texts = [(k, " ".join(words[k % 20 :] + ["other"] * 30)) for k in range(60)]
    docs = decontaminate._keyed(spark.createDataFrame(texts, "row_ord long, desc string"), "row_ord", "desc")
    chosen = spark.createDataFrame([("w25", "w28", 3, 7), ("w39", None, None, 8)], "first string, second string, gap int, pair long")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        met = decontaminate.met_pairs(decontaminate._tokens(docs), chosen, 0)
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert ("BroadcastHashJoin" in plan, "SortMergeJoin" in plan) == (stays, not stays)
    assert sorted((r.did, r.pair, r["at"]) for r in met.collect()) == sorted([(k, p, q - k % 20) for k in range(60) for p, q in ((7, 25), (8, 39))])
