"""Removal of byte strings that also start earlier in the corpus, by hash-compared suffix sorting.

Every window of ``WINDOW`` bytes is represented by its anchor: of the ``SPAN`` grams of ``GRAM`` bytes in it, the one with
the least hash (of its upper bits), the rightmost if several. Equal windows have the same anchor at the same place, so only occurrences of
anchors are dealt out by hash, one for about every 32 bytes, each with a second hash of all that its windows cover.
Occurrences that agree in both (64 bits for the anchor's own bytes, 64 for all that is covered) repeat the earliest of
them, and only that one goes on; an anchor that then occurs once is done. The others come together with the bytes around them, in groups of a bounded size.

In a group, polynomial prefix hashes and binary search give the common extension of any two suffixes. Windows inside the
common extension of an occurrence and the earliest one repeat. The windows that remain are sorted as suffixes, by
mergesort with comparisons through common extensions, logarithmic in the window's length, and neighbours that agree
over the whole window repeat. What these hashes call equal is compared byte by byte before it counts. An anchor with
more occurrences than a group holds has several groups; windows that are first in theirs then meet once more by 128 bits
of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, frames, in_parts, lean, packed, ranges, texts, unpacked

WINDOW, SPAN = 100, 64
GRAM = WINDOW - SPAN + 1
#: Occurrences of an anchor in a group, rows compared at a time, and bytes hashed at a time: arrays of eight bytes for each
#: stay in a core's cache, and under the size from which they would be mapped anew each time (``common.own_pages``).
GROUP, ROWS, PIECE = 1000, 4_000, 1 << 15
#: Bits of a gram's hash that are compared; the others have room for a place in two pieces.
PLACE = 42
#: Bytes of text looked at together: arrays have an entry for each byte, not for each word.
BYTES = 1 << 19
MIX = np.uint64(0x9E3779B97F4A7C15)
BASES = (0x5851F42D4C957F2D, 0xD6E8FEB86659FD93)
LAST = (1 << 63) - 1


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as they have been needed."""

    def __init__(self, base: int) -> None:
        self.bases = (base, pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)))) for b in self.bases)
        return self.up, self.down


_powers = tuple(Powers(b) for b in BASES)


class Hashes:
    """Polynomial prefix hashes of a byte array: any substring's hash is one subtraction and one product away."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        up, self.down = _powers[which].to(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[: len(data)]
        np.cumsum(terms, out=self.prefix[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def all(self, length: int) -> np.ndarray:
        """The hashes of all substrings of that length, by their starts."""
        return (self.prefix[length:] - self.prefix[:-length]) * self.down[: len(self.prefix) - length]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the longest common extension from a and b, up to most; back: of what ends there."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) >> 1
            shift = mid if back else 0
            same = self.of(a[open_] - shift, mid) == self.of(b[open_] - shift, mid)
            low[open_] = np.where(same, mid, low[open_])
            high[open_] = np.where(same, high[open_], mid - 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def rightmost_least(x: np.ndarray) -> np.ndarray:
    """Where the least of x[i : i + SPAN] is for each i, the rightmost if several; beyond the end of x of what there is.

    The upper PLACE bits are compared; the place goes into the others, so that one minimum finds both.
    """
    last = np.uint64((1 << 64 - PLACE) - 1)
    x = (x & ~last) | (last - np.arange(len(x), dtype=np.uint64))
    width = 1
    while width < SPAN:
        y = x.copy()
        np.minimum(x[:-width], x[width:], out=y[: len(x) - width])
        x, width = y, width * 2
    return (last - (x & last)).astype(np.int64)


def offsets(owned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest bit set."""
    low = np.log2((owned & (~owned + np.uint64(1))).astype(np.float64)).astype(np.int64)
    upper, lower = owned >> np.uint64(32), owned & np.uint64(0xFFFFFFFF)
    high = np.where(upper > 0, 32 + np.log2(np.maximum(upper, np.uint64(1))), np.log2(np.maximum(lower, np.uint64(1)))).astype(np.int64)
    return low, high


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes, owned windows and covered bytes' hashes of the anchors in the pieces starts to ends of data.

    Bit o of an anchor's owned windows is set if it is the anchor of the window that starts o bytes before it.
    """
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 3
    n = len(data) - GRAM + 1
    h = mixed(Hashes(data).all(GRAM)) | np.uint64(1)
    steps = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= WINDOW
    np.add.at(steps, starts[long], 1)
    np.add.at(steps, ends[long] - WINDOW + 1, -1)
    inside = np.flatnonzero(np.cumsum(steps[:n]) > 0)
    if not len(inside):
        return np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 3
    # an anchor's windows are neighbours: their anchors never step back
    place = rightmost_least(h)[inside]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    at = place[first]
    high, low = at - inside[first], at - inside[np.concatenate((first[1:], [len(inside)])) - 1]
    owned = below(high + 1) & ~below(low)
    return at, h[at], owned, mixed(Hashes(data, 1).of(at - high, high - low + WINDOW) ^ mixed(owned))


def pieces(rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """data, starts, ends, row numbers, places in the row: short texts together, long ones in overlapping pieces."""
    held, size = [], 0
    for k, raw in enumerate(rows):
        if len(raw) < WINDOW:
            continue
        for at in range(0, len(raw) - WINDOW + 1, PIECE):
            piece = raw[at : at + PIECE + WINDOW - 1]
            held.append((piece, k, at))
            size += len(piece)
            if size >= PIECE:
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) for x, _, _ in held])
    return np.frombuffer(b"".join(x for x, _, _ in held), np.uint8), np.concatenate(([0], ends[:-1])), ends, np.array([k for _, k, _ in held]), np.array([at for _, _, at in held])


def found(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place, hash, owned windows and covered bytes' hash of all anchors, by row and place. What two pieces own of
    one anchor is put together."""
    out = []
    for data, starts, ends, row, base in pieces(rows):
        at, h, owned, c = anchors(data, starts, ends)
        p = np.searchsorted(ends, at, side="right")
        out.append((row[p], at - starts[p] + base[p], h, owned, c))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * 3
    row, at, h, owned, c = (np.concatenate(x) for x in zip(*out, strict=True))  # pieces and anchors come by row and place
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] != at[:-1]))))
    if len(new) < len(row):
        c = mixed(np.add.reduceat(c, new)) if len(new) else c
    else:
        c = mixed(c)
    return row[new], at[new], h[new], np.bitwise_or.reduceat(owned, new) if len(new) else owned, c


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and from b agree over length, for each."""
    out = np.ones(len(a), bool)
    some = np.flatnonzero(length > 0)
    if len(some):
        n = length[some]
        differ = data[ranges(a[some], n)] != data[ranges(b[some], n)]
        out[some] = np.add.reduceat(differ, np.cumsum(n) - n) == 0
    return out


def suffix_order(hashes: Hashes, data: np.ndarray, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """A stable mergesort of the windows from start within each segment (segments stand together).

    In each round neighbouring sorted runs are merged: an element's place is its own index plus the number of elements
    of the other run before it, found by binary search. Two suffixes are compared at the end of their common extension.
    """
    n = len(start)
    order = np.arange(n)
    if not n:
        return order
    first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    size = np.diff(np.concatenate((first, [n])))
    base, end = np.repeat(first, size), np.repeat(first + size, size)
    local = np.arange(n) - base
    width, longest = 1, int(size.max())
    full = np.full(n, WINDOW)

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether window x sorts before window y; equal ones where ties."""
        e = hashes.extension(x, y, full[: len(x)])
        inner = np.minimum(e, WINDOW - 1)
        return np.where(e == WINDOW, ties, data[x + inner] < data[y + inner])

    while width < longest:
        run = local // width
        other = base + (run ^ 1) * width
        low = np.minimum(other, end)
        top = np.minimum(other + width, end)
        left = run % 2 == 0
        begin = low.copy()
        while True:
            open_ = np.flatnonzero(low < top)
            if not len(open_):
                break
            mid = (low[open_] + top[open_]) >> 1
            # for an element of the left run, those of the right count if smaller; for one of the right, also if equal
            earlier = before(start[order[mid]], start[order[open_]], ~left[open_])
            low[open_] = np.where(earlier, mid + 1, low[open_])
            top[open_] = np.where(earlier, top[open_], mid)
        to = base + (run // 2) * 2 * width + local % width + (low - begin)
        merged = np.empty_like(order)
        merged[to] = order
        order = merged
        width *= 2
    return order


def resolve(group: np.ndarray, context: list[bytes], left: np.ndarray, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which owned windows repeat one of an earlier row of their group (rows stand by group, then by document and place).

    Returns the repeated windows as bits, the data, where each row's anchor is in it, and the data's hashes object.
    """
    sizes = np.array([len(c) for c in context])
    data = np.frombuffer(b"".join(context), np.uint8)
    end = np.cumsum(sizes)
    begin = end - sizes
    anchor = begin + left
    hashes = Hashes(data)
    n = len(group)
    new = np.concatenate(([True], group[1:] != group[:-1]))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    rows = np.flatnonzero(first != np.arange(n))
    e = first[rows]
    right = hashes.extension(anchor[rows], anchor[e], np.minimum(end[rows] - anchor[rows], end[e] - anchor[e]))
    back = hashes.extension(anchor[rows], anchor[e], np.minimum(left[rows], left[e]), back=True)
    good = same_bytes(data, anchor[rows] - back, anchor[e] - back, back + right)
    # offsets o with WINDOW - right <= o <= back
    low, high = np.clip(WINDOW - right, 0, SPAN), np.clip(back + 1, 0, SPAN)
    bits = np.where(good & (high > low), below(high) & ~below(low), np.uint64(0)) & owned[rows]
    repeated = np.zeros(n, np.uint64)
    repeated[rows] = bits
    open_ = np.zeros(n, np.uint64)
    open_[rows] = owned[rows] & ~bits
    # an open window has a chance only if another row of the group has the same offset open
    i, o = windows(open_)
    if len(i):
        key = group[i] * SPAN + o
        order = np.lexsort((i, key))
        i, o, key = i[order], o[order], key[order]
        twin = np.concatenate(([False], key[1:] == key[:-1]))
        twin |= np.concatenate((twin[1:], [False]))
        i, o, key = i[twin], o[twin], key[twin]
        start = anchor[i] - o
        order = suffix_order(hashes, data, start, key)
        i, o, key, start = i[order], o[order], key[order], start[order]
        pair = np.flatnonzero((key[1:] == key[:-1]) & (hashes.of(start[1:], WINDOW) == hashes.of(start[:-1], WINDOW)))
        pair = pair[same_bytes(data, start[pair], start[pair + 1], np.full(len(pair), WINDOW))]
        np.bitwise_or.at(repeated, i[pair + 1], np.uint64(1) << o[pair + 1].astype(np.uint64))
    return repeated, data, anchor, hashes


def below(k: np.ndarray) -> np.ndarray:
    """Bits under k, for k from 0 to 64."""
    k = k.astype(np.uint64)
    return np.where(k >= 64, ~np.uint64(0), (np.uint64(1) << np.minimum(k, np.uint64(63))) - np.uint64(1))


def windows(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and offset of every set bit."""
    some = np.flatnonzero(bits)
    i, o = np.nonzero(np.unpackbits(bits[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return some[i], o.astype(np.int64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeats(docs: DataFrame) -> DataFrame:
    """doc, mark, starts for the documents with repeated windows, from docs (doc: order, mark, text): an array of
    struct (pos, bits), bit o for the window that starts o bytes before pos; no bit at all for all that the anchor owns."""
    who = "doc long, mark long"

    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, limit=BYTES):
            row, at, h, _, c = found(texts(batch))
            doc, mark = (batch.column(k).to_numpy()[row] for k in (0, 1))
            # what repeats an earlier occurrence of this very batch is settled; it travels under a key of its own
            order = np.lexsort((at, mark, doc, c, h))
            twin = np.zeros(len(h), bool)
            twin[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
            spread = mixed(mixed(doc.astype(np.uint64)) ^ at.astype(np.uint64))
            yield pa.RecordBatch.from_arrays([signed(np.where(twin, spread, h)), signed(np.where(twin, np.uint64(0), c)), pa.array(doc), pa.array(mark), pa.array(at.astype(np.int32)), pa.array(twin)], ["h", "c", "doc", "mark", "pos", "twin"])

    def told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by both hashes: those settled or like the one before, with part -1, and of the others those whose
        anchor occurs again, with the number of their group."""
        last, h, count, kept = None, None, 0, None  # the last row's hashes; the last anchor, its rows so far, its only row
        def settled(some: pa.RecordBatch) -> pa.RecordBatch:
            columns = [some.column(some.schema.get_field_index(k)) for k in ("h", "doc", "mark", "pos")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(some.num_rows, -1, np.int32))], ["h", "doc", "mark", "pos", "part"])

        for batch in batches:
            known = batch.column(5)
            if known.true_count:
                yield settled(batch.filter(known))
                batch = batch.filter(pc.invert(known))
            if not batch.num_rows:
                continue
            x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            twin = np.concatenate(([last == (x[0], y[0])], (x[1:] == x[:-1]) & (y[1:] == y[:-1])))
            last = (x[-1], y[-1])
            plain = pa.RecordBatch.from_arrays([batch.column(i) for i in (0, 2, 3, 4)], ["h", "doc", "mark", "pos"])
            if twin.any():
                yield settled(plain.filter(pa.array(twin)))
            plain, x = plain.filter(pa.array(~twin)), x[~twin]
            if not len(x):
                continue
            first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
            size = np.diff(np.concatenate((first, [len(x)])))
            nth, total = np.arange(len(x)) - np.repeat(first, size), np.repeat(size, size)
            if x[0] == h:
                nth[: size[0]] += count
                total[: size[0]] += count
                if kept is not None:
                    yield kept
            kept = None
            out = pa.RecordBatch.from_arrays([*plain.columns, pa.array((nth // GROUP).astype(np.int32))], [*plain.schema.names, "part"])
            if total[-1] == 1:
                kept = out.slice(len(x) - 1)
            h, count = x[-1], int(total[-1])
            some = out.filter(pa.array(total > 1))
            if some.num_rows:
                yield some

    listed = docs.mapInArrow(lean(list_anchors), f"h long, c long, {who}, pos int, twin boolean")
    again = cut(listed.repartition("h").sortWithinPartitions("h", "c", "doc", "mark", "pos").mapInArrow(lean(told_apart), f"h long, {who}, pos int, part int"))
    by_doc = again.where("part >= 0").groupBy("doc", "mark").agg(F.collect_list(F.struct("pos", "part")).alias("at"))

    def with_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in unpacked(batches, BYTES):
            row, at, h, owned, _ = found(raws)
            lists = batch.column(3)
            wanted = lists.flatten()
            sizes = np.diff(lists.offsets.to_numpy())
            asked = np.repeat(np.arange(batch.num_rows), sizes)
            pos, part = wanted.field("pos").to_numpy().astype(np.int64), wanted.field("part").to_numpy()
            most = 1 << 40
            place = np.searchsorted(row * most + at, asked * most + pos)  # every wanted place is an anchor
            mine = owned[place]
            low, high = offsets(mine)
            context = [raws[r][p - b : p - a + WINDOW] for r, p, a, b in zip(asked.tolist(), pos.tolist(), low.tolist(), high.tolist(), strict=True)]
            take = pa.array(asked)
            yield pa.RecordBatch.from_arrays(
                [signed(h[place]), pa.array(part), batch.column(0).take(take), batch.column(1).take(take), pa.array(pos.astype(np.int32)), signed(mine), pa.array(high.astype(np.int16)), pa.array(context, pa.binary())], CONTEXT
            )

    CONTEXT = ["h", "part", "doc", "mark", "pos", "owned", "back", "context"]
    contexts = by_doc.join(packed(docs), ["doc", "mark"]).select("doc", "mark", "z", "at").mapInArrow(lean(with_context), f"h long, part int, {who}, pos int, owned long, back short, context binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in frames(batches, ROWS, ("h", "part")):
            h, part = t["h"].to_numpy(), t["part"].to_numpy()
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (part[1:] != part[:-1])))
            group = np.cumsum(new) - 1
            owned = t["owned"].to_numpy().view(np.uint64)
            repeated, data, anchor, hashes = resolve(group, t["context"].to_pylist(), t["back"].to_numpy().astype(np.int64), owned)
            doc, mark, pos = t["doc"].to_numpy(), t["mark"].to_numpy(), t["pos"].to_numpy()
            some = np.flatnonzero(repeated)
            nothing = np.zeros(len(some), np.int64)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(doc[some]), pa.array(mark[some]), pa.array(pos[some]), signed(repeated[some]), *[pa.array(nothing)] * 2], RESULT)
            # groups of an anchor that may have others: their first windows go on
            full = np.bincount(group)[group] >= GROUP
            i, o = windows(np.where(full | (part > 0), owned & ~repeated, np.uint64(0)))
            if len(i):
                start = anchor[i] - o
                keys = [signed(mixed(x.of(start, WINDOW))) for x in (hashes, Hashes(data, 1))]
                yield pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(mark[i]), pa.array((pos[i] - o).astype(np.int32)), pa.array(np.zeros(len(i), np.int64)), *keys], RESULT)

    RESULT = ["doc", "mark", "pos", "bits", "k1", "k2"]
    compared = cut(contexts.repartition("h", "part").sortWithinPartitions("h", "part", "doc", "mark", "pos").mapInArrow(lean(compare), f"{who}, pos int, bits long, k1 long, k2 long"))
    whole = again.where("part < 0").select("doc", "mark", "pos", F.lit(0).cast("long").alias("bits"))
    marks = whole.unionByName(compared.where("bits <> 0").select("doc", "mark", "pos", "bits"))
    spread = compared.where("bits = 0")
    if not spread.isEmpty():
        firsts = spread.groupBy("k1", "k2").agg(F.min(F.struct("doc", "mark", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        later = spread.join(firsts, ["k1", "k2"]).where(F.struct("doc", "mark", "pos") > F.col("first"))
        marks = marks.unionByName(later.select("doc", "mark", "pos", F.lit(1).cast("long").alias("bits")))
    return marks.groupBy("doc", "mark").agg(F.collect_list(F.struct("pos", "bits")).alias("starts"))


def covered(n: int, pos: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of n bytes lie in a marked window."""
    i, o = windows(bits)
    steps = np.zeros(n + 1, np.int32)
    start = pos[i] - o
    np.add.at(steps, start, 1)
    np.add.at(steps, start + WINDOW, -1)
    return np.cumsum(steps[:n]) > 0


def whole_characters(raw: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """gone, less the bytes of characters that are only partly gone."""
    lead = (raw & 0xC0) != 0x80
    char = np.cumsum(lead) - 1
    kept = np.zeros(int(char[-1]) + 1 if len(char) else 0, bool)
    kept[char[~gone]] = True
    return gone & ~kept[char] if len(char) else gone


def prepared(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, bool]:
    """(rows, long, unique): rows has doc_id, doc, mark, text_hash, n_bytes, first (whether no earlier document has the
    same text); long has doc, mark, text of all rows with at least a window's bytes; unique: no id comes twice."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    rows = cut(base.select("doc_id", "doc", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("sha")))
    owner = rows.groupBy("sha").agg(F.min("doc").alias("owner"))
    rows = rows.join(owner, "sha").withColumn("first", F.col("doc") == F.col("owner")).drop("owner")
    unique = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    mark = F.lit(0).cast("long") if unique else F.xxhash64(F.unhex(F.sha2("text", 256)))  # tells texts of one id apart
    rows = rows.withColumn("mark", F.lit(0).cast("long") if unique else F.xxhash64("sha"))
    return rows, base.where(F.octet_length("text") >= WINDOW).select("doc", mark.alias("mark"), "text"), unique


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts_too: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs; with texts_too also text_hash (XXH64) and
    kept_text, without the characters that lie wholly in removed bytes (null where nothing was removed).

    A byte is removed if it lies in a string of 100 bytes that also starts earlier: in a document with a smaller id, or
    further left in the same one. A null text is the empty text. A null id comes after all others; different texts with
    one id come in the order of a hash. Repeated rows (same id, same text) are one document and share their result. An
    empty table gives no rows. Other columns of docs are ignored. Texts of any length are read whole.
    """
    rows, long_, unique = prepared(docs, id_col, text_col)
    rows = cut(rows)
    again = rows.where(~F.col("first")).select("doc", "mark").distinct()
    if not unique:
        long_ = cut(long_.dropDuplicates(["doc", "mark"]))
    found_ = repeats(long_)
    marks = found_.join(again, ["doc", "mark"], "left_anti")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in unpacked(batches, BYTES):
            row, at, _, owned, _ = found(raws)
            lists = batch.column(3)
            flat = lists.flatten()
            size = np.diff(lists.offsets.to_numpy())
            pos, bits = flat.field("pos").to_numpy().astype(np.int64), flat.field("bits").to_numpy().view(np.uint64).copy()
            most, whole = 1 << 40, np.flatnonzero(bits == 0)
            bits[whole] = owned[np.searchsorted(row * most + at, (np.repeat(np.arange(len(raws)), size) * most + pos)[whole])]
            end, out = np.cumsum(size), []
            for k, r in enumerate(raws):
                raw, own = np.frombuffer(r, np.uint8), slice(end[k] - size[k], end[k])
                gone = covered(len(raw), pos[own], bits[own])
                spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1]))))
                text = raw[~whole_characters(raw, gone)].tobytes().decode() if texts_too else None
                out.append((int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest(), text))
            if out:
                a, b, c, d = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c), pa.array(d, pa.string())], ["doc", "mark", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    done = marks.join(packed(long_), ["doc", "mark"]).select("doc", "mark", "z", "starts").mapInArrow(lean(finish), "doc long, mark long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    if not texts_too:
        done = done.drop("kept_text")
    done = done.dropDuplicates(["doc", "mark"])
    all_gone = ~F.col("first") & (F.col("n_bytes") >= WINDOW)
    either = lambda gone, partly, kept: F.when(all_gone, gone).otherwise(F.coalesce(partly, kept))
    more: list[Column] = [F.col("text_hash"), F.when(all_gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if texts_too else []
    return rows.join(done, ["doc", "mark"], "left").select(
        "doc_id",
        "n_bytes",
        either(F.col("n_bytes"), F.col("n_removed"), F.lit(0).cast("long")).alias("n_removed"),
        either(F.lit(1).cast("long"), F.col("n_spans"), F.lit(0).cast("long")).alias("n_spans"),
        either(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept_sha256"), F.lower(F.hex("sha"))).alias("kept_sha256"),
        *more,
    )

