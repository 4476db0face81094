import random
from collections import defaultdict

import numpy as np
import xxhash

from hallowgrid.llm.near_dup import fingerprint, links, near_copies


def plain_mark(text):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    for blank in "\t\n\x0b\x0c\r":
        ws = ws.replace(blank, " ")
    ws = [w for w in ws.split(" ") if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(marks):
    """Brute force: component of each distinct fingerprint as its smallest member."""
    ms = sorted(set(marks))
    up = {m: m for m in ms}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ms):
        for b in ms[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {m: top(m) for m in ms}


def flip(x, rnd, n):
    for p in rnd.sample(range(64), n):
        x ^= 1 << p
    return x


def test_fingerprints_follow_the_definition():
    rnd = random.Random(1)
    words = ["Grave", "ÉGLISE", "wall", "the", "OLD", "\xa0", "漢"]
    for _ in range(200):
        t = "".join(rnd.choice(words) + rnd.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(rnd.randint(0, 30)))
        assert fingerprint(t) & (1 << 64) - 1 == plain_mark(t)
    assert fingerprint(None) == fingerprint("") == 0


def test_links_reach_what_brute_force_reaches(spark):
    rnd = random.Random(7)
    seeds = [rnd.getrandbits(64) for _ in range(40)]
    marks = list({flip(s, rnd, rnd.randint(0, 5)) for s in seeds for _ in range(12)})
    dense = rnd.getrandbits(64)
    marks += list({dense ^ rnd.getrandbits(9) for _ in range(300)} | {flip(dense, rnd, 2) for _ in range(200)})
    signed = [int(np.uint64(m).view(np.int64)) for m in marks]
    want = groups(marks)
    df = spark.createDataFrame([(m,) for m in signed], "fingerprint long").distinct()
    for in_place in (4096, 20, 3):
        pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links(df, in_place).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
        up = {m: m for m in want}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
        assert {m: top(m) for m in want} == want


def test_components_of_records(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice("abcdefghijklm") * rnd.randint(1, 4) for _ in range(200)) for _ in range(30)]
    texts = []
    for b in base:
        for _ in range(rnd.randint(1, 6)):
            ws = b.split()
            for _ in range(rnd.randint(0, 2)):
                ws[rnd.randrange(len(ws))] = "changed"
            texts.append(" ".join(ws))
    rows = list(enumerate(texts, start=100))
    df = spark.createDataFrame(rows, "row_ord long, desc string")
    got = near_copies(df).collect()
    mark = {i: plain_mark(t) for i, t in rows}
    root = groups(mark.values())
    first = defaultdict(lambda: 10**9)
    for i, m in mark.items():
        first[root[m]] = min(first[root[m]], i)
    assert len(got) == len(rows)
    for r in got:
        assert r.fingerprint == f"{mark[r.row_ord]:016x}" and r.component_id == first[root[mark[r.row_ord]]]
    assert len({r.component_id for r in got}) < len(rows)


def test_awkward_rows(awkward):
    rows = near_copies(awkward).collect()
    assert len(rows) == 10
    by = defaultdict(set)
    for r in rows:
        by[r.row_ord].add((r.fingerprint, r.component_id))
    assert by[2] == by[3] == by[4] == {("0" * 16, 2)}
    assert by[1] == by[6] and {c for _, c in by[1]} == {1} and {c for _, c in by[7]} == {7}
    assert ("0" * 16, 2) in by[None]
    assert near_copies(awkward.limit(0)).count() == 0
