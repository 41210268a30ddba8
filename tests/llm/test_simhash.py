import random

import numpy as np
import pytest
import xxhash

from parcelight.llm import jaccard, meeting, simhash
from parcelight.llm.components import components


def plain(text, size=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    k = min(size, len(w))
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute(nodes, bits):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("block", [4096, 5])
@pytest.mark.parametrize("bits", [4, 7])
def test_links_brute_force(spark, block, bits):
    """Crowded keys and others connect exactly what lies within the distance."""
    rnd = random.Random(bits)
    fps = set()
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(simhash.signed(x))
            for _ in range(rnd.choice((1, 2, 3, bits, bits + 1))):
                x ^= 1 << rnd.randrange(64)
    rows = spark.createDataFrame([(f,) for f in fps], "node long")
    out = {r["node"]: r["root"] for r in simhash.links(rows, bits, block=block, dense=2, pivots=2).collect()}
    want = brute(sorted(fps), bits)
    assert {n: out.get(n, n) for n in fps} == want


def test_cells_let_all_roots_meet(spark):
    rnd = random.Random(4)
    rows = [(k, 1000 * k + i, rnd.choice((1, 1, 1, 2, 3, 4 + i))) for k in range(3) for i in range((4, 40, 90)[k])] + [(9, i, 7) for i in range(50)]
    cells = {}
    for r in meeting.dealt(spark.createDataFrame(rows, "key long, node long, root long"), block=10).collect():
        cells.setdefault((r["key"], r["i"], r["j"]), []).append((r["node"], r["root"]))
    met = {(k, x[0], y[0]) for (k, _, _), members in cells.items() for x in members for y in members}
    assert all((k, a, b) in met for k, a, x in rows for l, b, y in rows if k == l and x != y and k != 9)
    assert not any(k == 9 for k, _, _ in cells) and max(map(len, cells.values())) < 45


def test_pairs_and_stars():
    cell = np.array([0, 0, 0, 1, 2, 2])
    got = [(a, b) for i, j in meeting.pairs(cell) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    assert got == [(0, 1), (0, 2), (1, 2), (4, 5)]
    a, b = meeting.stars(np.array([5, 9, 3, 20, 21]), np.array([9, 3, 3, 22, 20]))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(3, 5), (3, 9), (20, 21), (20, 22)]


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    random.Random(1).shuffle(edges)
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[i] == 100 for i in (100, 101, 102))


def test_group(docs):
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(500)]
    base = " ".join(rnd.choice(words) for _ in range(400))
    near = base.replace(" " + base.split()[7] + " ", " other ", 1)
    rows = [(5, base), (3, base.upper()), (9, near), (4, None), (8, ""), (7, " \t\n"), (6, "one two"), (None, "ONE TWO"), (6, "one two"), (2, " ".join(rnd.choice(words) for _ in range(50)))]
    out = simhash.group(docs(rows, extra=True)).collect()
    assert len(out) == len(rows)
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out), key=str)
    fps = sorted({plain(t) for _, t in rows})
    root = brute(fps, 4)
    least = {}
    for i, t in rows:
        if i is not None:
            least[root[plain(t)]] = min(i, least.get(root[plain(t)], i))
    assert got == sorted(((i, f"{plain(t):016x}", least[root[plain(t)]]) for i, t in rows), key=str)
    assert {r["component_id"] for r in out if r["doc_id"] in (4, 7, 8)} == {4}


def test_group_empty(docs):
    assert simhash.group(docs([])).count() == 0


def test_near_duplicates_keep_one(docs):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    a, b = text(300), text(300)
    copy = a[:]
    copy[150] = "changed"
    half = a[:150] + text(150)
    rows = [(1, " ".join(a)), (2, " ".join(copy)), (3, " ".join(b)), (4, " ".join(half)), (0, " ".join(b)), (None, " ".join(a)), (1, " ".join(a))]
    out = simhash.near_duplicates(docs(rows)).collect()
    assert {r["doc_id"] for r in out if r["kept"]} == {0, 1, 4}
    assert [r["copies"] for r in out if r["doc_id"] == 1] == [2]


def shingled(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("dense", [32, 1])
def test_pairs_around_the_similarity(docs, dense, monkeypatch):
    """Against brute force: a pair just above the similarity is one group, one just below is two; with sparse and with
    crowded shingles."""
    monkeypatch.setattr(jaccard.groups, "__defaults__", (2, dense))
    rnd = random.Random(17)
    rows, want = [], set()
    for i in range(0, 300, 2):
        a = [f"w{rnd.randrange(50000)}" for _ in range(rnd.randrange(120, 260))]
        a[:12] = [f"common{k}" for k in range(12)]
        tail = rnd.randrange(int(len(a) * 0.07), int(len(a) * 0.14))
        b = a[:-tail] + [f"v{rnd.randrange(50000)}" for _ in range(tail)]
        rows += [(i, " ".join(a)), (i + 1, " ".join(b))]
        x, y = shingled(rows[-2][1]), shingled(rows[-1][1])
        alike = len(x & y) / len(x | y)
        assert 0.7 < alike < 0.9
        want |= {i} if alike >= 0.8 else {i, i + 1}
    assert 180 < len(want) < 270
    out = simhash.near_duplicates(docs(rows)).where("kept").collect()
    assert {r["doc_id"] for r in out} == want


@pytest.mark.parametrize("block", [2048, 6])
def test_group_of_near_copies_brute_force(docs, block, monkeypatch):
    """A large group of near copies, some of them too far from most others, is grouped as all pairs would group it."""
    monkeypatch.setattr(jaccard, "dealt", lambda index: meeting.dealt(index, block))
    monkeypatch.setattr(jaccard.groups, "__defaults__", (1, 4))
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rnd.sample(range(120), i % 7):
            w[k] = f"x{i}{k}"
        rows.append((i, " ".join(w)))
    sets = [shingled(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in range(4):
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if len(x & y) >= 0.8 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    out = simhash.near_duplicates(docs(rows)).where("kept").collect()
    assert {r["doc_id"] for r in out} == set(label)


@pytest.mark.parametrize("listed", [False, True])
def test_pairs_of_two_roots_come_in_rounds(spark, listed):
    """Of two large groups a cell gives the nearest pairs first, and without most all; sketches rule pairs out with and
    without lists of keys."""
    near, far = [0, 0, 0, 0], [-1, -1, -1, -1]
    rows = [(5, k, k % 2, 100, 0, near if k < 4 else [1 << (k % 60), 0, 0, 0], [5]) for k in range(40)] + [(5, 99, 99, 100, 0, far, [5])]
    index = spark.createDataFrame(rows, "key long, node long, root long, n int, pos int, sketch array<long>, keys array<long>")
    index = index if listed else index.drop("keys")
    found = lambda most: {(r["a"], r["b"]) for r in jaccard.met(index, ("key",), 0.8, most).collect()}
    every = {(a, b) for a in range(40) for b in range(a, 40) if (a + b) % 2}
    assert found(None) == every
    assert found(4) == {(0, 1), (0, 3), (1, 2), (2, 3)}
    assert len(found(1)) == 1 and found(1) < found(4)


def test_pairs_are_made_under_the_first_shingle_that_both_have(spark):
    """under another one, or where too little comes after it, a pair is not compared again."""
    rows = [(key, node, node, 100, pos, [0] * 4, keys) for node, keys in ((1, [8, 5, 3]), (2, [7, 5, 3])) for pos, key in ((5, 5), (9, 3))]
    rows += [(4, node, node, 100, 19, [0] * 4, [4]) for node in (6, 7)]
    index = spark.createDataFrame(rows, "key long, node long, root long, n int, pos int, sketch array<long>, keys array<long>")
    assert [(r["a"], r["b"]) for r in jaccard.met(index, ("key",), 0.8).collect()] == [(1, 2)]
    assert jaccard.met(index.where("key = 4").drop("keys"), ("key",), 0.8).count() == 0
