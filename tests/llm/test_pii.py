import hashlib
import random
import re

from pyspark.sql import functions as F

from hallowgrid.llm.pii import joined, masked, personal_data

RX = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 10 <= len(d) <= 15


def plain(text):
    spans = [(m.start(), i, k, m.end()) for i, (k, rx) in enumerate(RX.items()) for m in rx.finditer(text or "") if ok(k, m[0])]
    counts = [sum(s[2] == k for s in spans) for k in RX]
    return counts, ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def check(rows, texts):
    for r in rows:
        counts, base = plain(texts[r.row_ord])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, texts[r.row_ord]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (texts[r.row_ord], base, r.spans)
        if base:
            assert set(base.split(",")) <= {f"{s.kind}:{s.start}:{s.end}" for s in r.spans}


def test_base_spans_agree_with_plain_matching(spark):
    rnd = random.Random(9)
    parts = ["a@b.c", "_x", "@d.e.f", "1.2.3.4", ".5", "256", "0", "4111 1111 1111 1111", "-", "+1 (988) 555-2485", "+", "(", ")", " ", "é", "😀", "12345678", ".", "+44 20 7946 0958", "x", "00378282246310005", "%"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "row_ord long, desc string")
    rows = personal_data(df).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_contexts_find_what_no_pattern_knows(spark):
    texts = [f"Please write to warden number{i}@graves.example.org about the plot." for i in range(12)]
    texts += ["Please write to warden KX-99812-77 about the plot.", "Catalogue shelf KX-55512-11 is closed.", "nothing 123456 here"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_ord long, desc string")
    rows = {r.row_ord: r for r in personal_data(df).collect()}
    assert [(s.kind, texts[12][s.start : s.end]) for s in rows[12].spans] == [("context", "KX-99812-77")]
    assert rows[13].spans == rows[14].spans == []
    check(rows.values(), texts)
    two = df.join(personal_data(df), "row_ord").withColumn("desc", masked(F.col("desc"), F.col("spans")))
    out = {r.row_ord: r.desc for r in two.collect()}
    assert out[0] == "Please write to warden [email] about the plot." and out[12] == "Please write to warden [context] about the plot."
    assert out[13] == texts[13]


def test_awkward_rows(spark, awkward):
    rows = personal_data(awkward).collect()
    assert len(rows) == 10 and all(r.spans == [] for r in rows)
    texts = {1: "1" * 60_000 + "a" * 60_000 + "@" + ".b" * 2000, 2: "1.2." * 9000, 3: None, 4: "5 " * 20_000}
    long = spark.createDataFrame(list(texts.items()), "row_ord long, desc string")
    check(personal_data(long).collect(), texts | {1: ""})  # no match, which plain matching takes minutes to see
    assert personal_data(awkward.limit(0)).count() == 0
    assert personal_data(awkward).select(joined(F.col("spans"))).distinct().count() == 1


def test_many_matches_in_one_text(spark):
    rnd = random.Random(3)
    texts = {1: " ".join(f"é{i} mail{i}@x{i}.org or 123-456{i:05d}," for i in range(30_000)), 2: "😀 a@b.c +1 (988) 555-2485 " * 500}
    texts[3] = " ".join(rnd.choice(["a@b.c", "1.2.3.4", "x", "12345678", "+1.2.3.4@b.c"]) for _ in range(5000))
    df = spark.createDataFrame(list(texts.items()), "row_ord long, desc string")
    found = personal_data(df).cache()
    rows = {r.row_ord: r for r in found.collect()}
    check(rows.values(), texts)
    out = df.join(found, "row_ord").select("row_ord", masked(F.col("desc"), F.col("spans")).alias("desc")).collect()
    for r in out:
        want, at, text = [], 0, texts[r.row_ord]
        for s in rows[r.row_ord].spans:
            if s.start >= at:
                want.append(text[at : s.start] + f"[{s.kind}]")
            at = max(at, s.end)
        assert r.desc == "".join(want) + text[at:]


def test_long_words_of_a_context_stay_whole(spark):
    long = "x" * 60
    # The word after each identifier differs, so only the two words before it can name row 9.
    texts = [f"a{long} {long} number{i}@graves.example.org {chr(98 + i)}" for i in range(8)]
    texts += [f"b{long} {long} KX-99812-77 y", f"a{long} {long} KX-55512-11 z"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_ord long, desc string")
    rows = {r.row_ord: r for r in personal_data(df).collect()}
    assert [s.kind for s in rows[9].spans] == ["context"] and rows[8].spans == []
