import random
import re
from collections import Counter

from pyspark.sql import functions as F

from hallowgrid.llm.quality_rules import RULES, Rule, measures, rate_records

P = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = P.findall(text)
    wins = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {p for k in range(len(w) - 4) if wins[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
    lines = [x for x in text.split("\n") if P.search(x)]
    base = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    return (*base, len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_counts_agree_with_a_plain_loop(spark):
    rnd = random.Random(2)
    parts = ["grave", "a", "é", "b#", "\n", "\n\n", "\t", "|", "\x0b", "\x85", "😀", "\xa0", "&<"]
    texts = ["".join(rnd.choice(parts) + rnd.choice([" ", "  ", ""]) for _ in range(rnd.randint(0, 90))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "row_ord long, desc string")
    for r in rate_records(df).collect():
        assert tuple(r)[1:7] == plain(texts[r.row_ord]), texts[r.row_ord]


def test_rules_take_effect(spark):
    clean = "the burial ground of the old chapel was found by the river and is to be kept as it was"
    rows = [
        (1, clean),
        (2, " | ".join(clean.split())),
        (3, " ".join(w.upper() + "!!" for w in clean.split())),
        (4, " ".join(f"{w} {w} {w}" for w in clean.split())),
        (5, " ".join(f"grave{i} stone{i} wall{i}" for i in range(20))),
        (6, clean + "\n" + clean),
    ]
    df = spark.createDataFrame(rows, "row_ord long, desc string")
    assert {r.row_ord for r in rate_records(df).collect() if r.kept} == {1}
    assert {r.row_ord for r in rate_records(df, rules=()).collect() if r.kept} == {1, 2, 3, 4, 5}
    assert {r.row_ord for r in rate_records(df, rules=(*RULES, Rule("n_words", low=50))).collect() if r.kept} == set()


def test_stop_words_may_have_many_marks(spark):
    text = "the!!!!!!!!!!! grave of.,.,.,.,.,.,., THE old" + "?" * 50 + " wall and" + "." * 300
    assert spark.createDataFrame([(text,)], "t string").select(measures(F.col("t"))["n_stop_words"]).first()[0] == 4


def test_awkward_rows(awkward):
    rows = rate_records(awkward).collect()
    assert len(rows) == 10
    assert sorted(tuple(r)[1:7] for r in rows) == sorted(plain(r.desc or "") for r in awkward.collect())
    assert all(not r.kept for r in rows if r.n_words == 0)
    assert rate_records(awkward.limit(0)).count() == 0
