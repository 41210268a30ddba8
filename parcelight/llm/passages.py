"""Substring dedup by seed and extend: passages of WINDOW words or more that occur anywhere else, down to the word.

Seeds are winnowed: of the SEED-word strings in a window the one with the least hash, so two equal windows have a seed in
the same place. Documents meet in their seeds and matches are extended both ways, as far as a window with the seed can
reach; what lies beyond has seeds of its own. Three steps keep a common seed from making pairs:

- Occurrences that agree in all that a window can reach around the seed (128 bits of hash) are settled as they are, and
  one of them stands for all.
- Those of a seed that differ are sorted by what follows it, once for each number of words before it that they have to
  agree in. The longest match of each is with a neighbour in that order, so no pair is looked at twice.
- A seed with more than GROUP different surroundings is extended to whole windows at once, which are counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, frames, in_parts, lean, packed, ranges, small, texts, unpacked

#: Words of a passage that counts as repeated, and of a seed.
WINDOW, SEED = 35, 16
#: Different surroundings of a seed that are compared in one task; rows compared at a time.
GROUP, ROWS = 1 << 16, 1 << 14
#: Documents without an id come last.
LAST = (1 << 63) - 1
#: An odd multiplier, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
EMPTY = hashlib.sha256(b"").hexdigest()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or largest) of each width neighbours."""
    pick, have = (np.minimum if least else np.maximum), 1
    while have < width:
        step = min(have, width - have)
        x, have = pick(x[:-step], x[step:]), have + step
    return x


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class Words:
    """The words of some texts in a row, with hashes of any stretch of them."""

    def __init__(self, raws: list[bytes], window: int, seed: int) -> None:
        lists = [r.split() for r in raws]
        self.size = np.fromiter(map(len, lists), np.int64, len(lists))
        self.end = np.cumsum(self.size)
        self.n = n = int(self.size.sum())
        self.window, self.seed, self.reach = window, seed, window - seed
        self.hash = np.fromiter((xxhash.xxh3_64_intdigest(w) for words in lists for w in words), np.uint64, n)
        power = np.full(n + 1, BASE, np.uint64)
        inverse = np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
        power[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hash * np.cumprod(power)[:n])))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the words from a up to b."""
        return mixed((self.sums[b] - self.sums[a]) * self.inverse[a])

    def seeds(self) -> tuple[np.ndarray, ...]:
        """text, place (in the row of all), first and last word that a window with the seed reaches, hash of the seed, of
        all that is reached: for each seed."""
        text = np.repeat(np.arange(len(self.size)), self.size)
        if self.n < self.window:
            nothing = np.zeros(0, np.int64)
            return nothing, nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
        begin, end = (self.end - self.size)[text], self.end[text]
        at = np.arange(self.n - self.seed + 1)
        h = self.of(at, at + self.seed)
        least = sliding(h, self.reach + 1, True)
        least[at[: len(least)] + self.window > end[: len(least)]] = 0  # windows do not go from one text into the next
        gap = np.zeros(self.reach, np.uint64)
        at = np.flatnonzero((sliding(np.concatenate((gap, least, gap)), self.reach + 1, False) == h) & (h > 0))
        low, high = np.maximum(at - self.reach, begin[at]), np.minimum(at + self.window, end[at])
        context = mixed(self.of(low, high) + (at - low).astype(np.uint64) * np.uint64(64) + (high - at).astype(np.uint64))
        return text[at], at, low, high, h[at], context


def extended(group: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words before and after its seed each row shares with others of its group, in matches that are long enough:
    words before and after add up to the number of columns. -1, -1 where there is none.

    left and right have a column for each word, the nearest first; a word that is not there is unlike any other.
    """
    n, reach = right.shape
    before, after = np.full(n, -1), np.full(n, -1)
    place = np.empty(n, np.int64)
    place[np.lexsort(right.T[::-1])] = np.arange(n)
    rows, kind = np.arange(n), group.astype(np.int64)
    for words in range(reach + 1):
        order = np.lexsort((place[rows], kind))
        rows, kind = rows[order], kind[order]
        same = kind[1:] == kind[:-1]
        shared = np.zeros(len(same), np.int64)
        a, b = rows[:-1][same], rows[1:][same]
        shared[same] = np.cumprod(right[a] == right[b], axis=1).sum(axis=1)
        best = np.full(len(rows), -1)
        best[1:][same] = shared[same]
        best[:-1][same] = np.maximum(best[:-1][same], shared[same])
        hit = best + words >= reach
        before[rows[hit]] = words  # grows from round to round
        after[rows[hit]] = np.maximum(after[rows[hit]], best[hit])
        alone = np.concatenate(([True], ~same)) & np.concatenate((~same, [True]))
        rows, kind = rows[~alone], kind[~alone]
        if words == reach or not len(rows):
            break
        # from now on rows have to agree in one word more before the seed
        order = np.lexsort((left[rows, words], kind))
        rows, old, word = rows[order], kind[order], left[rows, words][order]
        kind = np.cumsum(np.concatenate(([False], (old[1:] != old[:-1]) | (word[1:] != word[:-1]))))
    return before, after


def padded(codes: list[bytes], count: np.ndarray, reach: int, salt: int) -> np.ndarray:
    """Codes of 6 bytes, one row of up to reach for each list, as numbers; what is missing gets numbers of its own."""
    n = len(count)
    out = np.arange(n * reach, dtype=np.uint64).reshape(n, reach) * np.uint64(2) + np.uint64((1 << 63) + salt)
    flat = np.zeros((int(count.sum()), 8), np.uint8)
    flat[:, 2:] = np.frombuffer(b"".join(codes), np.uint8).reshape(-1, 6)
    out[np.arange(reach)[None, :] < count[:, None]] = flat.view(">u8")[:, 0]
    return out


def coded(h: np.ndarray) -> bytes:
    """The upper 48 bits of word hashes."""
    return h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """doc, mark, start, end: words of docs (doc, mark, text; no two rows alike in doc and mark) that lie in a window of so
    many words which occurs anywhere else. Stretches overlap; end may lie behind a text's last word."""
    reach = window - seed

    def list_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            w = Words(texts(batch), window, seed)
            text, at, _, _, h, c = w.seeds()
            doc, mark = (batch.column(k).to_numpy()[text] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([signed(h), signed(c), pa.array(doc), pa.array(mark), pa.array((at - (w.end - w.size)[text]).astype(np.int32))], ["h", "c", "doc", "mark", "pos"])

    seeds = docs.mapInArrow(lean(list_seeds), "h long, c long, doc long, mark long, pos int")
    several = seeds.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("p"), F.max("c").alias("q")).where("n > 1").select("h", (F.col("p") == F.col("q")).alias("alike"))
    met = cut(seeds.join(small(cut(several)), "h"))  # written first, or Spark would not split the rows of a common seed
    unlike = met.where("not alike").select("h", "c", "doc", "mark", "pos")
    kinds = cut(unlike.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "mark", "pos")).alias("one")))
    copied = unlike.join(kinds.where("n > 1").select("h", "c"), ["h", "c"], "left_semi")
    whole = met.where("alike").select("doc", "mark", "pos").unionByName(copied.select("doc", "mark", "pos"))
    settled = whole.select("doc", "mark", F.greatest(F.col("pos") - reach, F.lit(0)).alias("start"), (F.col("pos") + window).alias("end"))

    many = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("h", F.lit(True).alias("many"))
    told = kinds.join(small(cut(many)), "h", "left").select("one.*", F.col("many").isNotNull().alias("crowded"))
    asked = told.groupBy("doc", "mark").agg(F.collect_list(F.struct("pos", "crowded")).alias("at"))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in unpacked(batches):
            w = Words(raws, window, seed)
            _, at, low, high, h, _ = w.seeds()
            size = np.diff(batch.column(3).offsets.to_numpy())
            wanted = batch.column(3).flatten()
            row = np.repeat(np.arange(batch.num_rows), size)
            pos = wanted.field("pos").to_numpy().astype(np.int64)
            k = np.searchsorted(at, (w.end - w.size)[row] + pos)  # each is a seed
            at, low, high, h = at[k], low[k], high[k], h[k]
            crowded = wanted.field("crowded").to_numpy(zero_copy_only=False)
            left = [b"" if x else coded(w.hash[a:b][::-1]) for x, a, b in zip(crowded, low.tolist(), at.tolist(), strict=True)]
            right = [b"" if x else coded(w.hash[a:b]) for x, a, b in zip(crowded, (at + seed).tolist(), high.tolist(), strict=True)]
            many = np.where(crowded, high - window - low + 1, 0)
            first = ranges(low, many)
            offsets = np.concatenate(([0], np.cumsum(many))).astype(np.int32)
            windows = pa.ListArray.from_arrays(pa.array(offsets), signed(w.of(first, first + window)))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([signed(h), batch.column(0).take(take), batch.column(1).take(take), pa.array(pos.astype(np.int32)), pa.array((at - low).astype(np.int32)), pa.array(left, pa.binary()), pa.array(right, pa.binary()), windows], SEEN)

    SEEN = ["h", "doc", "mark", "pos", "back", "left", "right", "windows"]
    seen = cut(asked.join(packed(docs), ["doc", "mark"]).select("doc", "mark", "z", "at").mapInArrow(lean(around), "h long, doc long, mark long, pos int, back int, left binary, right binary, windows array<long>"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in frames(batches, ROWS, ("h",)):
            h, pos = t["h"].to_numpy(), t["pos"].to_numpy()
            sides = []
            for k, name in enumerate(("left", "right")):
                codes = t[name].to_pylist()
                sides.append(padded(codes, np.fromiter(map(len, codes), np.int64, len(codes)) // 6, reach, k))
            before, after = extended(np.cumsum(np.concatenate(([False], h[1:] != h[:-1]))), *sides)
            some = np.flatnonzero(before >= 0)
            start, end = pos[some] - before[some], pos[some] + seed + after[some]
            yield pa.RecordBatch.from_arrays([t["doc"].combine_chunks().take(pa.array(some)), t["mark"].combine_chunks().take(pa.array(some)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["doc", "mark", "start", "end"])

    plain = seen.where("size(windows) = 0").drop("windows").repartition("h").sortWithinPartitions("h")
    longer = plain.mapInArrow(lean(compare), "doc long, mark long, start int, end int")
    firsts = seen.where("size(windows) > 0").select("h", "doc", "mark", (F.col("pos") - F.col("back")).alias("low"), F.posexplode("windows").alias("nth", "window"))
    firsts = firsts.select("h", "window", "doc", "mark", (F.col("low") + F.col("nth")).alias("start"))
    place = F.struct("doc", "mark", "start")  # a window that holds its seed twice comes twice
    twice = firsts.groupBy("h", "window").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p < q").select("h", "window")
    counted = firsts.join(small(cut(twice)), ["h", "window"], "left_semi").select("doc", "mark", "start", (F.col("start") + window).alias("end"))
    return settled.unionByName(longer).unionByName(counted)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, group: int = GROUP, texts_too: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of docs; with texts_too also spans (array of start, end in
    words, the maximal removed runs) and kept_text, the words left, joined by one space.

    A word is removed if it lies in a window of so many words that also starts anywhere else, in another row or further on
    in this one; all occurrences go. Words are runs of anything but space and the ASCII controls 09 to 0D, compared as
    they are. Windows are judged on the input. A null text has no words. Rows with equal texts, repeated ones too, are
    documents of their own and so lose all words if they have a window. Ids may be null or come twice. An empty table
    gives no rows. Other columns of docs are ignored. Texts of any length are read whole.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = dict(base.dtypes)["doc_id"]

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            out = []
            for raw in texts(batch):
                words = raw.split()
                out.append((len(words), hashlib.sha256(b" ".join(words)).digest(), hashlib.sha256(raw).digest()))
            if out:
                n, kept, sha = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(sha, pa.binary())], ["doc_id", "doc", "n_words", "words_sha", "sha"])

    rows = cut(base.mapInArrow(lean(count_words), f"doc_id {id_type}, doc long, n_words long, words_sha binary, sha binary"))
    copies = rows.where(F.col("n_words") >= window).groupBy("sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", F.lit(True).alias("copied"))
    copies = small(cut(copies))
    unique = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    # texts of one id are told apart by a hash
    rows = cut(rows.join(copies, "sha", "left").withColumn("mark", F.lit(0).cast("long") if unique else F.xxhash64("sha")))
    long_ = base.where(F.octet_length("text") >= 2 * window - 1).select("doc", (F.lit(0).cast("long") if unique else F.xxhash64(F.unhex(F.sha2("text", 256)))).alias("mark"), "text")
    if not unique:
        long_ = cut(long_.dropDuplicates(["doc", "mark"]))
    # what has copies goes as a whole, so its stretches need not travel
    stretches = repeats(long_, window, seed, group).join(rows.where("copied").select("doc", "mark").distinct(), ["doc", "mark"], "left_anti")
    listed = stretches.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "end")).alias("at"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in unpacked(batches):
            end, flat = batch.column(3).offsets.to_numpy(), batch.column(3).flatten()
            starts, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            end = end - end[0]
            out = []
            for k, raw in enumerate(raws):
                words = raw.split()
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, starts[end[k] : end[k + 1]], 1)
                np.add.at(steps, np.minimum(ends[end[k] : end[k + 1]], len(words)), -1)
                gone = np.cumsum(steps)[:-1] > 0
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])
                edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])))).reshape(-1, 2)
                spans = [{"start": a, "end": b} for a, b in edge.tolist()] if texts_too else None
                out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest(), spans, kept.decode() if texts_too else None))
            if out:
                a, b, c, d = zip(*out, strict=True)
                span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a, pa.int64()), pa.array(b), pa.array(c, pa.list_(span)), pa.array(d, pa.string())], ["doc", "mark", "n_removed", "kept_sha256", "spans", "kept_text"])

    done = listed.join(packed(long_), ["doc", "mark"]).select("doc", "mark", "z", "at").mapInArrow(lean(finish), "doc long, mark long, n_removed long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept_text string")
    if not texts_too:
        done = done.drop("spans", "kept_text")
    all_gone = F.col("copied").isNotNull()
    out = rows.join(done, ["doc", "mark"], "left")
    n_words = F.col("n_words")
    columns = [
        "doc_id",
        "n_words",
        F.when(all_gone, n_words).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(all_gone, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("words_sha")))).alias("kept_sha256"),
    ]
    if not texts_too:
        return out.select(columns)
    whole = base.select("doc", (F.lit(0).cast("long") if unique else F.xxhash64(F.unhex(F.sha2("text", 256)))).alias("mark"), F.array_join(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), " ").alias("joined"))
    out = out.join(whole.dropDuplicates(["doc", "mark"]), ["doc", "mark"])
    span = F.array(F.struct(F.lit(0).alias("start"), n_words.cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return out.select(*columns, F.when(all_gone, span).otherwise(F.coalesce("spans", none)).alias("spans"), F.when(all_gone, F.lit("")).otherwise(F.coalesce("kept_text", "joined")).alias("kept_text"))


#: The digest's rows in DuckDB, by grouping all windows.
SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
  windows as (select r, i, sha256(array_to_string(w[i : i + 34], ' ')) as s from (select r, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
  repeated as (select s from windows group by 1 having count(*) > 1),
  gone as (select distinct r, unnest(range(i, i + 35)) as p from windows semi join repeated using (s)),
  words as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
  kept as (select r, count(*) as n, string_agg(word, ' ' order by p) as t from words anti join gone using (r, p) group by 1)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (r)"""
