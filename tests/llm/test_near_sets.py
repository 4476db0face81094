import random
import time

import numpy as np

import corpus_pipeline as cp
from hallowgrid.llm.near_dup import fingerprint
from hallowgrid.llm.near_sets import FEW, first_of_groups, span


def plain(text):
    ws = (text or "").split()
    return {" ".join(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def similar(a, b):
    return a == b or bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def firsts(rows):
    """Brute force: the smallest (id, row) of each component of similar texts."""
    sets, up = {r: plain(t) for r, _, t in rows}, {r: r for r, _, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, _, _) in enumerate(rows):
        for b, _, _ in rows[i + 1 :]:
            if similar(sets[a], sets[b]):
                up[top(a)] = top(b)
    best = {}
    for r, k, _ in rows:
        best[top(r)] = min(best.get(top(r), (k is None, k or 0, r)), (k is None, k or 0, r))
    return {r for *_, r in best.values()}


def texts():
    rnd, out = random.Random(11), []
    for n in (30, 60, 120, 250):
        for _ in range(12):
            ws = [f"w{rnd.randrange(4000)}" for _ in range(n)]
            for _ in range(5):
                out.append(" ".join(ws))
                for _ in range(rnd.randint(0, max(1, n // 40))):
                    ws[rnd.randrange(n)] = f"c{rnd.randrange(4000)}"
    rnd.shuffle(out)
    return out


def test_groups_agree_with_brute_force(spark):
    rows = [(i, rnd if (rnd := (i * 7919) % 1009) % 9 else None, t) for i, t in enumerate([*texts(), "", None, " \t", "one two", "one  two"])]
    df = spark.createDataFrame(rows, "_row long, doc_id long, text string")
    got = [r._row for r in first_of_groups(df, "_row", "doc_id", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == firsts(rows) and len(got) < len(rows)
    assert first_of_groups(df.limit(0), "_row", "doc_id", "text").count() == 0


def test_stage_drops_near_copies_that_lie_beyond_three_bits(spark, sf):
    rows = [(i, i, t) for i, t in enumerate(texts())]
    pairs = [(a, b) for a, _, x in rows for b, _, y in rows if a < b and x != y and similar(plain(x), plain(y))]
    marks = [fingerprint(t) & (1 << 64) - 1 for *_, t in rows]
    assert any((marks[a] ^ marks[b]).bit_count() > 3 for a, b in pairs)
    out = cp.near_copies(spark, spark.createDataFrame([r[1:] for r in rows], "doc_id long, text string"), sf)
    assert {r.doc_id for r in out.collect()} == firsts(rows)


def test_stage_keeps_exactly_one_row_of_each_group(spark, sf):
    t = "grave marker near the old chapel wall"
    rows = [(5, t, "a"), (5, t, "b"), (None, t, "c"), (None, "another text with some words in it", "d"), (None, "another text with some words in it", "e"), (5, "a third text under the same id", "f")]
    out = cp.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), sf).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted([(5, t), (5, rows[5][1]), (0, rows[3][1])])


def test_rows_of_one_id_are_judged_by_their_own_text(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(5, f"see {item} here"), (5, "clean text"), (None, item), (None, "clean text"), (None, None), (7, f"x {item}"), (8, "clean text")]
    out = cp.benchmark_free(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == [(0, ""), (0, "clean text"), (5, "clean text"), (8, "clean text")]


def parts(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[top(a)] = top(b)
    return [top(i) for i in range(n)]


def test_indexed_buckets_agree_with_all_pairs():
    rnd = np.random.default_rng(5)
    for k in (2, FEW, FEW + 1, 150, 300):
        for share in (1.0, 0.95, 0.8, 0.5):
            core = np.arange(rnd.integers(1, 80))
            sets = [np.unique(np.r_[core[rnd.random(core.size) < share], rnd.integers(100, rnd.choice([112, 160, 10**6]), rnd.integers(1, 12))]) for _ in range(k)]
            links = span(np.array([s.size for s in sets]), np.concatenate(sets))
            plain_sets = [set(s.tolist()) for s in sets]
            near = [(a, b) for a in range(k) for b in range(a) if similar(plain_sets[a], plain_sets[b])]
            assert all(similar(plain_sets[a], plain_sets[b]) for a, b in links)
            got, want = parts(k, links), parts(k, near)
            assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_a_bucket_of_one_template_grows_with_its_sets():
    """All pairs lie at a similarity of about 0.74; 16,000 sets are compared in a time that all pairs would need for few."""
    n = 16_000
    sets = [np.r_[np.arange(196), 1000 + 40 * i + np.arange(34)] for i in range(n)]
    sets[-1] = sets[0][:-1]
    began = time.time()
    assert span(np.array([s.size for s in sets]), np.concatenate(sets)) == [(0, n - 1)]
    assert time.time() - began < 40


def test_long_texts_and_many_texts_of_one_template(spark):
    frame = " ".join(f"t{i}" for i in range(60))
    rows = [(i, i, f"{frame} " + " ".join(f"u{i}x{k}" for k in range(14))) for i in range(300)]
    long = " ".join(f"w{i}" for i in range(60_000))
    rows += [(300, 300, long), (301, 301, long + " tail"), (302, None, rows[5][2] + " tail"), (303, 5, rows[5][2])]
    df = spark.createDataFrame(rows, "row long, node long, desc string").selectExpr("*", "'x' AS first", "'y' AS bands", "'z' AS key")
    got = {r[0] for r in first_of_groups(df, "row", "node", "desc").collect()}
    assert got == firsts(rows)
