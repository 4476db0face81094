import zlib

import pytest

from hallowgrid.llm.toxicity import Lexicon, Reader, plain_word, score_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automata_agree_with_edit_distances():
    terms = {"desecrate": 5.0, "ghoul": 4.0, "rot": 3.0, "filth": 4.5}
    lex = Lexicon(terms, {"vermi": 6.0})
    words = ["desecrate", "desecrte", "dessecrate", "desekrate", "dsecrte", "ghoul", "goul", "ghouls", "hgoul", "rot", "rat", "root", "filth", "flth", "vermin", "verminous", "vermi", "vormin", "", "x"]
    for w in words:
        near = [(distance(w, t), -x) for t, x in terms.items() if distance(w, t) <= (len(t) >= 5)]
        want = (6.0, 0) if w.startswith("vermi") else (-min(near)[1], min(near)[0]) if near else None
        assert lex.match(w) == want, w


def test_words_and_contexts():
    assert [plain_word(w) for w in ("gh0ul!!", "(f1lth),", "2024", "fi-lth", "...", "été")] == ["ghoul", "filth", "2024", "filth", "", "été"]
    r = Reader({"ghoul": 5.0, "filth": 5.0}, {})
    open_, quoted, said = (r.features(t) for t in ("you are a ghoul", 'the sign "filth" was removed', "the report said ghoul on the wall"))
    assert open_[1] > 0 and open_[3] == 0 and open_[4] == 1
    assert quoted[3] > 0 and quoted[1] == 0 and said[3] > 0
    assert r.features("a ghoull")[2] > 0 and r.features(None)[1:].sum() == r.features("")[1:].sum() == 0


@pytest.fixture(scope="module")
def made(spark):
    bad = ["ghoul", "filth", "vermin"]
    rows, labels = [], []
    for i in range(600):
        t = f"the county paper number {i} on plot {i % 7} near the old chapel wall"
        if i % 4 == 0:
            t += f" you {bad[i % 3]} and {bad[(i // 4) % 3]}"
        rows.append((i, t))
        if i % 5:
            labels.append((i, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "row_ord long, desc string"), spark.createDataFrame(labels, "row_ord long, toxic int")


def test_held_out_records_are_told_apart(made):
    docs, labels = made
    rows = score_toxicity(docs, labels).collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.row_ord).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7) == int(r.row_ord % 4 == 0)


def test_scores_do_not_use_held_out_labels(spark, made):
    docs, labels = made
    flipped = labels.selectExpr("row_ord", "CASE WHEN crc32(cast(cast(row_ord AS string) AS binary)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = (sorted(score_toxicity(docs, x).collect(), key=lambda r: r.row_ord) for x in (labels, flipped))
    assert a == b


def test_misspelt_terms_and_awkward_rows(spark, made, awkward):
    docs, labels = made
    extra = spark.createDataFrame([(9001, "you gh0ul, you fi1th"), (9002, None), (9003, "")], docs.schema)
    rows = {r.row_ord: r for r in score_toxicity(docs.unionByName(extra), labels).filter("row_ord > 9000").collect()}
    assert rows[9001].predicted == 1 and rows[9002].score == rows[9003].score < 0.5
    none = spark.createDataFrame([(None, 1), (1, None), (404, 1)], labels.schema)
    got = score_toxicity(awkward, none).collect()
    assert len(got) == 10 and all(r.predicted == 0 for r in got)
    assert score_toxicity(awkward.limit(0), labels.limit(0)).count() == 0
