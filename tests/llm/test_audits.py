"""Operators 11 to 13 against brute force on small corpora and on whole test tables."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from parcelight.llm import divergence, interaction, passages, queries
from parcelight.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_divergence", "op12_passages", "op13_filter_audit"])
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "labels"):
        duck.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = duck.sql(queries.oracle_sql()[name])
    mine = queries.queries()[name](spark, SF).select(want.columns).collect()
    assert Counter(map(tuple, mine)) == Counter(want.fetchall())


# 11


def brute_divergence(rows, least=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [((lang or ""), (source or ""), Counter(term.findall((text or "").translate(lower)))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for k, _, c in docs if k == lang for t in c)
        kept = {t for t, n in df.items() if n >= least}
        counts = {}
        for k, source, c in docs:
            if k == lang:
                counts.setdefault(source, Counter()).update({t: n for t, n in c.items() if t in kept})
        whole = sum(counts.values(), Counter())
        p = lambda c: {t: 1 + 1000000000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        by, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for s in by:
            pairs = [(o, sum(f(by[s][t], by[o][t]) for t in kept)) for o in by if o != s]
            terms = [(t, f(by[s][t], q[t])) for t in kept if counts[s][t] > 0 and by[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(ranked)]
    return Counter(out)


def invented(rnd, n):
    vocabulary = ["the", "Été", "naïve", "日本", "x", "Ab", "zz", "q'r", "co-op", "ÀB", "n1n", "é"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for i in range(n):
        own = vocabulary[: 6 + 3 * (i % 8)]
        rows.append((i if i % 9 else None, None if i % 23 == 5 else " ".join(rnd.choice(own) for _ in range(rnd.randrange(12))), rnd.choice(["en", "de", None, "", "xx"]), rnd.choice(["a", "b", "c", None, ""])))
    return rows


def test_divergence(docs):
    rows = invented(random.Random(2), 400)
    rows += rows[:3] + [(900, "", "lonely", "s"), (901, "only here", "rare", "s"), (902, None, "rare", "t"), (903, "TOP top " * 3000, "en", "b")]
    out = divergence.audit(docs(rows, extra=True)).collect()
    assert Counter((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in out) == brute_divergence(rows)
    assert divergence.audit(docs([])).count() == 0


def test_probability_beyond_64_bits(spark):
    n, total, v = 9_000_000_000_000_000, 9_500_000_000_000_000, 1_000_000
    df = spark.createDataFrame([(n, total, v)], "n long, total long, v long").selectExpr("n", "total", "v")
    from pyspark.sql import functions as F

    (r,) = df.select(divergence.probability(F.col("n"), F.col("total"), F.col("v")).alias("p")).collect()
    assert r["p"] == 1 + 1000000000 * (n + 2) // (total + 2 * v)


def test_counts_of_a_task_that_go_on_early(docs, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    rows = invented(random.Random(4), 150)
    assert Counter(tuple(r) for r in divergence.audit(docs(rows)).collect()) == brute_divergence(rows)


# 12


def brute_passages(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def repetitive(rnd, n, words=5):
    """Few different words, passages in many surroundings, copies, edits and runs."""
    passage = [f"p{rnd.randrange(40)}" for _ in range(60)]
    rows = []
    for i in range(n):
        kind, own = i % 6, [f"w{rnd.randrange(words if i % 2 else 900)}" for _ in range(rnd.randrange(90))]
        if kind == 1:
            at = rnd.randrange(len(own) + 1)
            own[at:at] = passage[rnd.randrange(20) : rnd.randrange(30, 61)]
        elif kind == 2 and rows:
            own = (rnd.choice(rows)[1] or "").split()
            if own:
                own[rnd.randrange(len(own))] = "edit"
        elif kind == 3:
            own += ["run"] * rnd.randrange(80)
        elif kind == 4:
            own += own
        rows.append((i, rnd.choice([" ", "  ", "\n", " \t"]).join(own)))
    return rows


@pytest.mark.parametrize(("window", "seed", "group"), [(35, 16, 4096), (35, 16, 3), (9, 4, 5), (6, 5, 4096), (5, 5, 2)])
def test_passages(docs, window, seed, group):
    rows = repetitive(random.Random(window + group), 150)
    rows += [(200, None), (201, ""), (202, " \n"), (203, "é" * 500), (None, rows[9][1]), (None, rows[13][1] + " end"), (7, rows[7][1]), (7, "another text with this id"), (7, rows[7][1])]
    out = passages.dedup(docs(rows, extra=True), window=window, seed=seed, group=group, texts_too=True).collect()
    key = lambda r: (r[0] is None, *[-1 if x is None else x for x in r])
    mine = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in out), key=key)
    assert mine == sorted(brute_passages(rows, window), key=key)
    for r in out:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_passages_of_distinct_ids_and_none(docs):
    rows = repetitive(random.Random(77), 120, words=2)
    out = passages.dedup(docs(rows)).collect()
    assert sorted(tuple(r) for r in out) == sorted(x[:4] for x in brute_passages(rows, 35))
    assert passages.dedup(docs([])).count() == 0
    assert [tuple(r)[1:3] for r in passages.dedup(docs([(1, None)]), texts_too=True).select("doc_id", "n_words", "n_removed").collect()] == [(0, 0)]


def test_one_seed_in_thousands_of_surroundings(docs):
    """One passage of 40 words after and before different words: a seed's group is compared in one task or counted."""
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(25)] + [passage] + [f"b{i}x{k}" for k in range(25)])) for i in range(3000)]
    for group in (100, 4096):
        out = passages.dedup(docs(rows), group=group)
        assert out.where("n_words = 90 and n_removed = 40").count() == 3000


def test_a_very_long_text(docs):
    rnd = random.Random(8)
    long_ = " ".join(f"w{rnd.randrange(10**5)}" for _ in range(300_000))
    part = " ".join(long_.split()[150_000:150_050])
    out = {r["doc_id"]: r["n_removed"] for r in passages.dedup(docs([(1, long_), (2, f"other words {part} and others")])).collect()}
    assert out == {1: 50, 2: 50}


# 13


def brute_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    firsts = {}
    for i, t, *_ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    masks = []
    for i, t, _, source in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), any(c in "#$%&*|" for c in t), i is not None and firsts[t] < i]
        masks.append((source or "", fails, i in good, i in toxic))
    out = Counter()
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        lines, total = [], Counter()
        for order in permutations("ABCDE"):
            left = own
            for k, name in enumerate(order):
                at = "ABCDE".index(name)
                removed = [m for m in left if m[1][at]]
                after = [m for m in left if not m[1][at]]
                redundant = sum(m[1][at] for m in own) - len(removed)
                lines.append((part, "".join(order), k + 1, len(after), len(removed), redundant, sum(m[1][at] and sum(m[1]) == 1 for m in own), sum(m[2] for m in removed), sum(m[3] for m in removed), name))
                total[name] += len(removed)
                left = after
        out.update((*x[:-1], total[x[-1]]) for x in lines)
    return out


def test_filter_audit(spark, docs):
    rnd = random.Random(12)
    some = lambda n: " ".join(rnd.choice(["word", "Next", "more", "CAPS", "a|b", "5%", *[f"w{k}" for k in range(60)]][: rnd.choice([4, 66])]) for _ in range(n))
    rows = [(i, some(rnd.choice([3, 49, 50, 51, 90])), "en", rnd.choice(["s", "t", None, ""])) for i in range(120)]
    rows += [(i + 200, rows[i][1], "en", "s") for i in range(0, 120, 3)] + [(300, None, "en", "t"), (301, "", "en", "t"), (302, "É" * 90, "en", "t"), (None, rows[4][1], "en", "s"), (None, None, "en", None), rows[5], rows[5], (5, "same id, other text", "en", "s"), (303, "AB " * 40_000, "en", "s")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 260, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    out = interaction.audit_filters(docs(rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert Counter(tuple(r) for r in out) == brute_audit(rows, labels)
    assert interaction.audit_filters(docs([]), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_other_filters(docs):
    from pyspark.sql import functions as F

    failed = interaction.failures(docs([(1, "a"), (2, "bb"), (3, "bb")]), filters={"L": F.length("text") > 1})
    out = interaction.audit(failed, "LC").orderBy("filter_order", "step").collect()
    assert [(r["filter_order"], r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in out] == [("CL", 2, 1, 0, 0, 1), ("CL", 1, 1, 1, 1, 3), ("LC", 1, 2, 0, 1, 3), ("LC", 1, 0, 1, 0, 1)]
