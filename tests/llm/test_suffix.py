import hashlib
import random

import numpy as np
import pytest

from parcelight.llm import common, suffix


def brute(rows):
    """Rows (id, text) in order: removed flags for each."""
    seen, out = set(), []
    for _, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            w = raw[i : i + 100]
            if w in seen:
                gone[i : i + 100] = True
            seen.add(w)
        out.append(gone)
    return out


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 8)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(rnd.randint(10, 60)) for _ in range(6)] + ["ab" * 150, "x" * 260, line(14)]
    rows = []
    for i in range(n):
        parts = [line(rnd.randint(0, 40)) if rnd.random() < 0.6 else rnd.choice(shared) for _ in range(rnd.randint(0, 6))]
        rows.append((i, "\n".join(parts)))
    return rows + [(n, rows[3][1]), (n + 1, rows[4][1] + "z"), (n + 2, None), (n + 3, "")]


@pytest.mark.parametrize("group,rows,piece", [(1000, 20_000, 1 << 20), (3, 40, 300)])
def test_brute_force(spark, docs, monkeypatch, group, rows, piece):
    """The usual sizes, and ones so small that groups, frames and pieces are all cut."""
    for name, value in (("GROUP", group), ("ROWS", rows), ("PIECE", piece)):
        monkeypatch.setattr(suffix, name, value)
    table = corpus(7)
    if group < 1000:  # worker processes see the constants only through what runs in this one
        out = in_process([(i, t) for i, t in table])
    else:
        out = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.dedup(docs(table, extra=True)).collect()}
    for (i, t), gone in zip(table, brute(table), strict=True):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(raw) else 0
        want = (len(raw), int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest())
        assert out[i] == want, i


def in_process(table):
    """What the Spark steps do, with the same functions, on one table."""
    raws = [(t or "").encode() for _, t in table]
    row, at, h, owned, _ = suffix.found(raws)
    order = np.lexsort((at, row, h))
    groups, marks = {}, {}
    for k in order:
        groups.setdefault(int(h[k]), []).append(int(k))
    later = {}
    for members in groups.values():
        for a in range(0, len(members), suffix.GROUP):
            part = members[a : a + suffix.GROUP]
            low, high = suffix.offsets(owned[part])
            context = [raws[row[k]][at[k] - b : at[k] - lo + suffix.WINDOW] for k, lo, b in zip(part, low, high, strict=True)]
            repeated, *_ = suffix.resolve(np.zeros(len(part), np.int64), context, high, owned[part])
            for k, bits in zip(part, repeated, strict=True):
                marks.setdefault(int(row[k]), []).append((at[k], bits))
                for o in suffix.windows(np.array([owned[k] & ~bits], np.uint64))[1]:
                    start = int(at[k]) - int(o)
                    later.setdefault(raws[row[k]][start : start + suffix.WINDOW], []).append((int(row[k]), start))
    for places in later.values():
        for r, start in sorted(places)[1:]:
            marks.setdefault(r, []).append((start, np.uint64(1)))
    out = {}
    for k, ((i, _), raw) in enumerate(zip(table, raws, strict=True)):
        m = marks.get(k, [])
        data = np.frombuffer(raw, np.uint8)
        gone = suffix.covered(len(raw), np.array([p for p, _ in m], np.int64), np.array([b for _, b in m], np.uint64)) if m else np.zeros(len(raw), bool)
        spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(raw) else 0
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest())
    return out


def test_suffix_order_sorts_windows():
    rnd = random.Random(1)
    raw = bytes(rnd.choice(b"ab") for _ in range(400)) + b"ab" * 300
    data = np.frombuffer(raw, np.uint8)
    start = np.array([rnd.randrange(len(raw) - 100) for _ in range(300)])
    segment = np.sort(np.array([rnd.randrange(5) for _ in range(300)]))
    order = suffix.suffix_order(suffix.Hashes(data), data, start, segment)
    key = [(int(segment[k]), raw[start[k] : start[k] + 100], int(k)) for k in order]
    assert key == sorted(key)


def test_extension():
    raw = b"abcabcabd" + b"x" * 20
    h = suffix.Hashes(np.frombuffer(raw, np.uint8))
    assert h.extension(np.array([0]), np.array([3]), np.array([9])).tolist() == [5]
    assert h.extension(np.array([5]), np.array([8]), np.array([5]), back=True).tolist() == [5]


def test_repeated_ids_and_rows(docs):
    passage = " ".join(f"word{k}" for k in range(40))
    rows = [(None, passage), (5, passage), (5, passage), (5, "start " + passage), (7, "tail " + passage)]
    out = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix.dedup(docs(rows)).collect()), key=str)
    n = len(passage)
    assert (7, n + 5, n) in [(a, b, c - 1 if c > n else c) for a, b, c in out]
    assert (None, n, n) in out
    # one of the two different texts of document 5 comes first and keeps what the other loses
    assert sorted(c for a, _, c in out if a == 5)[0] == 0 and len(out) == 5


def test_texts_keep_whole_characters(docs):
    passage = "é" * 120
    rows = [(1, "a" + passage), (2, "bb" + passage + "c")]
    out = {r["doc_id"]: r for r in suffix.dedup(docs(rows), texts_too=True).collect()}
    assert out[2]["n_removed"] == 240 and out[2]["kept_text"] == "bbc"


def test_empty(docs):
    assert suffix.dedup(docs([])).count() == 0


def test_places_of_the_least():
    """One minimum finds the least and its place: the rightmost of equal ones, beyond the end of what there is."""
    x = np.random.default_rng(3).integers(0, 1 << 40, 500).astype(np.uint64) << np.uint64(24)
    x[100:180] = x[300:340:3].min()
    want = [i + len(w) - 1 - int(np.argmin(w[::-1])) for i, w in ((i, x[i : i + suffix.SPAN]) for i in range(len(x)))]
    assert suffix.rightmost_least(x).tolist() == want


def test_pieces_fit_where_arrays_are_not_mapped_anew(monkeypatch):
    """a piece's arrays stay below the size from which memory is mapped for each; pieces change no anchor."""
    assert 8 * (suffix.PIECE + suffix.WINDOW) < common.OWN_PAGES
    rnd = random.Random(3)
    rows = [bytes(rnd.choices(b"ab cd", k=n)) for n in (50, 99, 100, 101, 3000, 70_000, 140_000)]
    whole = []
    for piece in (1 << 20, suffix.PIECE):
        monkeypatch.setattr(suffix, "PIECE", piece)
        whole.append(suffix.found(rows)[:4])
    assert all((a == b).all() for a, b in zip(*whole, strict=True))
