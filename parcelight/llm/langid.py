"""Language identification by compression with per-language zstandard dictionaries.

A language's dictionaries are raw content: its sample texts, whole. A text of any length is compressed with each, and the
language whose dictionaries make it smallest is chosen. A narrow margin between the two smallest is a rejection.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
import regex
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_parts, lean, tool, unsigned_fraction

#: What a text is compared in: its lower-cased UTF-8 bytes, with a space for each ASCII character that is no letter.
LETTERS = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))
UNKNOWN = "und"
#: A text's margin is narrow if it is under a part of its compressed size, which is calibrated for each class of lengths:
#: texts of fewer bytes than the first of CLASSES, than the second, and others. It is as wide as it can be, within NARROW,
#: while it rejects at most the part LOST of the right texts of the calibration; the least with fewer than 1 / LOST.
CLASSES, NARROW, LOST = (129, 1025), (0.01, 0.02), 0.005
#: A language's texts are dealt into PARTS dictionaries; what a text takes with each is added up. That tells apart by less
#: than a byte, which short texts need, and serves long ones alike.
PARTS = 4
#: Matches from four bytes on, found by two hash tables: slower searches tell short texts apart less well.
SETTINGS = dict(window_log=21, chain_log=17, hash_log=17, search_log=1, min_match=4, target_length=8, strategy=zstandard.STRATEGY_DFAST, write_content_size=False, write_checksum=False, write_dict_id=False)
#: Goes before every text: with it a block is always compressed, not stored as it is, as short ones would be.
LEAD = b" " * 64
_letter = regex.compile(r"\p{L}").search


def normal(text: str) -> bytes:
    return text.lower().encode().translate(LETTERS)


@dataclass(frozen=True)
class Languages:
    """Dictionaries by language, and in the same order how common each language was in the sample's source."""

    names: tuple[str, ...]
    contents: tuple[tuple[bytes, ...], ...]
    counts: tuple[int, ...]
    narrow: tuple[float, ...] = (NARROW[0],) * (len(CLASSES) + 1)


class Classifier:
    def __init__(self, model: Languages) -> None:
        self.names, self.narrow, self.tools = model.names, model.narrow, []
        self.prior = sorted(range(len(model.names)), key=lambda i: (-model.counts[i], model.names[i]))
        for contents in model.contents:
            own = []
            for content in contents:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                settings = zstandard.ZstdCompressionParameters(**SETTINGS)
                d.precompute_compress(compression_params=settings)
                own.append(zstandard.ZstdCompressor(dict_data=d, compression_params=settings).compress)
            self.tools.append(own)

    def sizes(self, data: bytes) -> list[int]:
        return [sum(len(f(LEAD + data)) for f in own) for own in self.tools]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected): equal sizes go to the language more common in training."""
        if not text or not self.names or not _letter(text):
            return UNKNOWN, 0.0, True
        data = normal(text)
        best, score, margin = self.judge(data)
        return self.names[best], score, margin < self.narrow[bisect_right(CLASSES, len(data))]

    def judge(self, data: bytes) -> tuple[int, float, float]:
        """(place of the language, score, margin as a part of the compressed size)."""
        sizes = self.sizes(data)
        best = min(self.prior, key=sizes.__getitem__)
        least = sizes[best]
        score = 1.0 / sum(2.0 ** max(-60, (least - s) / PARTS) for s in sizes)  # a byte more halves a language's chance
        margin = min((s for i, s in enumerate(sizes) if i != best), default=2 * least) - least
        return best, score, margin / max(least, 1)


def calibrated(model: Languages, labelled: DataFrame) -> Languages:
    """The model with the margins that suit labelled (text, lang) it has not learned from, a bounded number of rows; the
    least margins where there are none."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)  # its sample is bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = classifier(shared)
        for batch in in_parts(batches):
            seen = []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if _letter(text):
                    data = normal(text)
                    best, _, margin = c.judge(data)
                    seen.append((bisect_right(CLASSES, len(data)), margin, c.names[best] == lang))
            if seen:
                a, b, d = zip(*seen, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.float64()), pa.array(d, pa.bool_())], ["size", "margin", "right"])

    seen = labelled.select("text", "lang").mapInArrow(lean(run, tools=True), "size int, margin double, right boolean").collect()
    narrow = []
    for k in range(len(model.narrow)):
        right = sorted(r["margin"] for r in seen if r["size"] == k and r["right"])
        narrow.append(min(max(right[int(LOST * len(right))], NARROW[0]), NARROW[1]) if LOST * len(right) >= 1 else NARROW[0])
    return replace(model, narrow=tuple(narrow))


def learn(labelled: DataFrame, sample: int = 400) -> Languages:
    """Dictionaries from labelled (text, lang): bounded numbers of rows, texts whole, while counts cover every row.

    Of each language about ``sample`` distinct texts are drawn by hash, of which there are so many however often one is
    repeated; all where there are fewer. Rows with a null or empty text or language teach nothing. Margins are calibrated
    on as many other texts.
    """
    rows = labelled.where("lang is not null and text is not null and text <> ''").select("lang", "text", F.xxhash64("text").alias("by"))
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("by").alias("texts")).collect()  # a row for each language
    if not found:
        return Languages((), (), ())
    chance = F.create_map(*[x for r in found for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["texts"])))])
    taught = unsigned_fraction(F.col("by"), F.lit(1)) < chance[F.col("lang")]
    once = lambda df: df.dropDuplicates(["lang", "by"])
    texts = sorted(once(rows.where(taught)).collect(), key=lambda r: r["by"])
    names = tuple(sorted(r["lang"] for r in found))
    own = [[normal(r["text"]) for r in texts if r["lang"] == n] or [b" " * 8] for n in names]
    counts = {r["lang"]: r["n"] for r in found}
    model = Languages(names, tuple(tuple(b"\n".join(x[k::PARTS] or x[:1]) for k in range(PARTS)) for x in own), tuple(counts[n] for n in names))
    others = once(rows.where(~taught & (unsigned_fraction(F.col("by"), F.lit(6)) < chance[F.col("lang")])))
    return calibrated(model, others)


def classifier(model: Broadcast) -> Classifier:
    """One classifier for each worker process."""
    return tool(("languages", hash(model.value)), lambda: Classifier(model.value))


def classify(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score and rejected added, without a shuffle.

    lang_pred is `und`, score 0 and rejected true where the text is null or has no letter, or no language was learned.
    Columns of docs other than the text are passed on, but for ones of those three names, which are replaced. Repeated
    rows and null ids are rows like others. Whole texts are compressed, however long.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its sample is bounded
    base = docs.drop("lang_pred", "score", "rejected")
    schema = ", ".join([*(f"`{n}` {k}" for n, k in base.dtypes), "lang_pred string, score double, rejected boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = classifier(shared)
        for batch in in_parts(batches, text_col):
            said = [c.predict(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            names, scores, rejected = zip(*said, strict=True) if said else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return base.mapInArrow(lean(run, tools=True), schema)


def held_out(id_: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text leaves this remainder; never for a null id."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % parts == part, F.lit(False))
