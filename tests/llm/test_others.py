import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from parcelight.llm import ann, minhash, mixing, sharding
from parcelight.llm.common import numbered
from parcelight.llm.sharding import longest_first


def jaccard(a, b):
    return len(a & b) / max(1, len(a | b))


def test_fingerprint_edits(docs):
    rnd = random.Random(1)
    rows = [(i, " ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.randint(0, 200))) + "é" * (i % 3)) for i in range(40)]
    rows += [(40, None), (41, ""), (42, rows[3][1]), (None, "x y z é")]
    out = {r["doc_id"]: r for r in minhash.fingerprint_edits(docs(rows, extra=True)).collect()}
    ordered = sorted((r for r in rows if r[0] is not None), reverse=True) + [rows[-1]]
    assert len(out) == len(rows)
    for k, (i, t) in enumerate(ordered):
        t, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(t) // 3
        new = t[: len(t) - cut] + following[:cut]
        r = out[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        sets = [set(minhash.shingles(x.encode()).tolist()) for x in (t, new, following)]
        if all(sets):
            assert abs(r["near_edited"] - jaccard(*sets[:2])) < 0.25 and abs(r["near_next"] - jaccard(sets[0], sets[2])) < 0.25
    assert out[3]["fingerprint"] == out[42]["fingerprint"] and out[40]["fingerprint"] == out[41]["fingerprint"]
    assert minhash.fingerprint_edits(docs([])).count() == 0
    (one,) = minhash.fingerprint_edits(docs([(1, "abcdef")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0


def test_fingerprint_edits_of_one_id(docs):
    """Rows without an id, or of one id, are ordered by the hash of their texts over several ranges."""
    rnd = random.Random(3)
    rows = [(None if i % 2 else 7, " ".join(f"w{rnd.randrange(90)}" for _ in range(30))) for i in range(400)]
    hashed = docs(rows).selectExpr("doc_id", "text", "xxhash64(text) as h").collect()
    ordered = sorted((r for r in hashed), key=lambda r: (r["doc_id"] is None, r["h"], r["text"]))
    want = Counter()
    for k, r in enumerate(ordered):
        t, following = r["text"], ordered[(k + 1) % len(ordered)]["text"]
        want[r["doc_id"], hashlib.sha256((t[: len(t) - len(t) // 3] + following[: len(t) // 3]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in minhash.fingerprint_edits(docs(rows)).collect()) == want


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_numbered_rows(spark, chunk):
    rows = [(None, "x")] * 7 + [(1, None)] * 3 + [(1, "x"), (2, "x")]
    out = numbered(spark.createDataFrame(rows, "a long, b string"), chunk=chunk).collect()
    assert Counter((r["a"], r["b"], r["nth"]) for r in out) == Counter((*k, i) for k, n in Counter(rows).items() for i in range(n))
    assert numbered(spark.createDataFrame([], "a long, b string")).count() == 0


@pytest.mark.parametrize("hot", [200, 1])
def test_minhash_near_duplicates(docs, hot):
    rnd = random.Random(2)
    rows = []
    for i in range(30):
        w = [f"w{rnd.randrange(5000)}" for _ in range(150)]
        rows.append((i, " ".join(w)))
        w[rnd.randrange(150)] = "changed"
        rows.append((100 + i, " ".join(w)))
        if i % 3 == 0:
            rows.append((200 + i, " ".join(w[:75] + [f"v{k}{i}" for k in range(75)])))
    rows += [(500, None), (501, ""), (0, rows[0][1]), (None, rows[0][1])]
    out = Counter((r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(docs(rows, extra=True), hot=hot, block=2).collect())
    sets = [set(minhash.shingles((t or "").encode()).tolist()) for _, t in rows]
    label = list(range(len(rows)))
    for _ in range(3):
        for a in range(len(rows)):
            for b in range(len(rows)):
                if sets[a] == sets[b] or jaccard(sets[a], sets[b]) >= 0.8:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    assert out == Counter((i, least[c]) for (i, _), c in zip(rows, label, strict=True))
    assert minhash.near_duplicates(docs([])).count() == 0


def test_signature_estimates():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 4000, np.uint64)
    b = np.concatenate((a[:3000], rng.integers(0, 1 << 63, 1000, np.uint64)))
    assert abs(minhash.likeness(minhash.signature(a), minhash.signature(b)) - 0.6) < 0.15


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 32)).astype(np.float32)
    x[700:760] = x[699]  # copies: ties go to the smaller id
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [(5000, None, 0), (5050, [0.0] * 32, 0), (5100, [float("nan")] + [1.0] * 31, 0), (5150, [float("inf")] * 32, 0), (5200, [1.0], 0)]
    df = vectors(spark, rows + bad)
    out = ann.nearest(df, df.where("vec_id % 50 = 0")).collect()
    e = x.astype(np.float64)
    n = np.sqrt((e * e).sum(axis=1))
    hit = total = 0
    for q in range(0, 1500, 50):
        cosine = (e * e[q]).sum(axis=1) / (n * n[q])
        cosine[q] = -9
        want = np.lexsort((np.arange(1500), -cosine))[:5].tolist()
        got = sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - cosine[r["vec_id"]]) < 1e-12 for r in got)
        hit, total = hit + len({r["vec_id"] for r in got} & set(want)), total + 5
        if q == 700:
            assert [r["vec_id"] for r in got] == [699, 701, 702, 703, 704]
    assert hit / total >= 0.9 and {r["query_id"] for r in out} == set(range(0, 1500, 50))


def test_nearest_few_and_none(spark):
    df = vectors(spark, [(0, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (50, [0.0, 1.0], 0), (1, [2.0, 0.0], 0)])
    out = {(r["query_id"], r["rank"]): r["vec_id"] for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect()}
    assert out == {(0, 1): 1, (0, 2): 50, (50, 1): 0, (50, 2): 1}
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_nearest_of_odd_vectors(spark):
    """Extreme magnitudes, an id with several vectors, and lists too small for k results."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))
    rows = [(i, (v * 10.0 ** (200 if i % 3 == 0 else -200 if i % 3 == 1 else 0)).tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows + [(7, rows[7][1], 0), (7, [1e308] * 8, 1)], "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' as id", "'x' as list", "'x' as v", "'x' as near", "'x' as bound", "'x' as rank")
    out = ann.nearest(df, df.where("vec_id % 50 = 0"), lists=30, probe=0.04).collect()
    least = min(rows[7][1], [1e308] * 8)
    x[7] = np.array(least) / np.abs(least).max()
    n = np.sqrt((x * x).sum(axis=1))
    assert sorted((r["query_id"], r["rank"]) for r in out) == [(q, k) for q in (0, 50) for k in range(1, 6)]
    for r in out:
        q, v = r["query_id"], r["vec_id"]
        assert r["score"] == pytest.approx(float(x[q] @ x[v]) / (n[q] * n[v]), abs=1e-12) and q != v
    assert len({(r["query_id"], r["vec_id"]) for r in out}) == len(out)


def test_longest_first():
    assert longest_first([(1, 5), (2, 4), (3, 3), (4, 3), (5, 3)], 2) == {1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def test_shards(docs):
    rnd = random.Random(4)
    rows = [(i, "x" * rnd.randint(0, 400) + str(i)) for i in range(600)] + [(600 + i, "same text") for i in range(90)] + [(None, None), (None, ""), (3, "y"), (3, "y")]
    out = sharding.shard(docs(rows, extra=True)).collect()
    assert len(out) == len(rows) and {r["law"] for r in out} == {"bytes"} and all(r["grown_shard"] is None for r in out)
    loads, slots, where = Counter(), {}, {}
    for r in out:
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        where.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert max(loads.values()) - min(loads.values()) <= 0.02 * max(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) == set(range(16))
    assert all(len(s) == 1 for s in where.values())
    assert sharding.shard(docs([])).count() == 0


def test_one_row_many_times(docs):
    """Slots and draws of a row that makes up most of a table, with and without an id."""
    rows = [(None, "same text here", "en", "a")] * 900 + [(4, "same text here", "en", "a")] * 600 + [(i, f"some other text {i}", "en", "bc"[i % 2]) for i in range(300)]
    out = sharding.shard(docs(rows), shards=4, bins=8, cell=50).collect()
    assert len(out) == len(rows) and len({r["shard"] for r in out if r["size"] == 15}) == 1
    for s in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    mixed = mixing.mix(docs(rows), block=20).collect()
    again = mixing.mix(docs(rows[::-1]), block=20).collect()
    assert len(mixed) == len(rows) and Counter(map(tuple, mixed)) == Counter(map(tuple, again))
    for s in "abc":
        own = [r for r in mixed if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 10 and all(r["taken"] <= 3 * r["size"] for r in own)


def test_small_bins_share_a_shard(docs):
    rows = [(i, f"text {i % 700}") for i in range(3000)]
    out = sharding.shard(docs(rows), shards=2, bins=8, cell=50).collect()
    by = Counter(r["shard"] for r in out)
    assert len({(r["text_crc32"], r["shard"]) for r in out}) == 700 and sum(by.values()) == 3000
    for s in by:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(by[s]))


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing."""
    keys = sorted((k for k in sizes if k is not None), key=lambda k: k.encode()) + [None] * (None in sizes)
    w = {k: weights[i % 3] for i, k in enumerate(keys)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = total - sum(stopped.values())
        open_ = [k for k in keys if k not in stopped]
        share = {k: rest * w[k] / sum(w[j] for j in open_) for k in open_}
        over = [k for k in open_ if share[k] > most * sizes[k]]
        if not over:
            return stopped | share
        stopped |= {k: most * sizes[k] for k in over}


@pytest.mark.parametrize("block", [2000, 20])
def test_mix(docs, block):
    rnd = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(min(400, int(rnd.paretovariate(1.1) * 10)))), "en", rnd.choice(["a", "b", "c", "dé", None, "z"])) for i in range(1500)]
    rows += [(9000, None, "en", "a"), (9001, "", "en", "only"), (None, "one two", "en", "a"), (5, rows[5][1], "en", rows[5][3])]
    out = mixing.mix(docs(rows, extra=True), block=block).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    want = water(sizes)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= max(15, 0.01 * want[s]) for s in want)
    again = mixing.mix(docs(rows[::-1], extra=True), block=block).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_mix_small(docs):
    assert mixing.mix(docs([])).count() == 0
    (one,) = mixing.mix(docs([(1, "a b c", "en", "s")])).collect()
    assert one["taken"] == 3
    assert {r["taken"] for r in mixing.mix(docs([(1, "", "en", "s"), (2, None, "en", None)])).collect()} == {0}


def test_flight_keeps_totals():
    rng = np.random.default_rng(2)
    p, x = rng.uniform(0, 1, 200), rng.integers(1, 1000, 200)
    out = mixing.flight(p, x, random.Random(1))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and float(out @ x) == pytest.approx(float(p @ x))
