"""Exact byte-pair encoding by backtracking over longest matches, and decoding through an offset table.

A merge list orders its tokens; a sequence of tokens is what the merges produce exactly if every neighbouring pair is
compatible, that is, merging would not have joined across their border before both were complete. The encoder takes the
longest vocabulary match at each place (found by an Aho-Corasick automaton), shortens it while it is not compatible with
the token before, and steps back where nothing fits. A place found to be a dead end is never tried again, so the work
is linear in the text. Compatible pairs are kept in a table as they come up.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, lean, tool, trim

#: Distinct words remembered in a worker, and pairs of tokens.
KEPT, PAIRS = 100_000, 200_000

#: Bytes of text encoded together: what becomes of them takes some 20 times as much.
BYTES = 1 << 18

#: Pretoken pattern of the vocabulary file (fixed value), with white space as Unicode defines it.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Encoder:
    """The tokenizer of a vocabulary file (the text of its JSON) with word ends, lower case and byte-level symbols."""

    def __init__(self, file: str) -> None:
        spec = json.loads(file)
        model, self.special = spec["model"], {x["content"]: x["id"] for x in spec["added_tokens"]}
        end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        self.inner = symbols
        #: The last symbol of a word is another one than the same byte inside a word: moved up, out of the others' range.
        self.last = [chr(ord(c) + 0x1000) for c in symbols]
        self.end = end
        form = lambda t: t[: -len(end) - 1] + chr(ord(t[-len(end) - 1]) + 0x1000) if t.endswith(end) and t != end else t
        base = [*self.inner, *self.last]
        place = {c: i for i, c in enumerate(base)}
        self.strings = base[:]
        self.left, self.right = list(range(len(base))), list(range(len(base)))  # a base token is its own half
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            p, q = place[form(a)], place[form(b)]
            self.joined[p, q] = place[form(a) + form(b)] = len(self.strings)
            self.strings.append(form(a) + form(b))
            self.left.append(p)
            self.right.append(q)
        ids = {form(t): i for t, i in vocab.items()}
        self.ids = [ids[s] for s in self.strings]
        self.lengths = [len(s) for s in self.strings]
        self.match = ahocorasick.Automaton()
        for t, s in enumerate(self.strings):
            self.match.add_word(s, t)
        self.match.make_automaton()
        self.shorter = [next((place[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in place), -1) for s in self.strings]
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.find = regex.compile(PIECES).findall
        self.blank = regex.compile(r"\p{White_Space}+")
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        # decoding: the tokens' bytes one after another, each with the space that parts it from the one before
        by_id = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pieces = [(" " + by_id.get(i, "")).encode() if i in by_id else b"" for i in range(max(by_id) + 1)]
        self.offsets = np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave a and b side by side."""
        pair = a * len(self.strings) + b
        known = self.pairs.get(pair)
        if known is not None:
            return known
        p, q, limit = a, b, len(self.strings)
        while True:
            if self.joined.get((p, q), limit) < limit:
                ok = False
                break
            # undo the later of the two merges; base tokens have none to undo
            if p > q:
                limit, half = p, self.right[p]
                if half == p:
                    limit, half = q + 1, self.left[q]
                    if half == q:
                        ok = True
                        break
                    q = half
                else:
                    p = half
            else:
                limit, half = q + 1, self.left[q]
                if half == q:
                    limit, half = p, self.right[p]
                    if half == p:
                        ok = True
                        break
                    p = half
                else:
                    q = half
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[pair] = ok
        return ok

    def backtrack(self, symbols: str) -> list[int]:
        """The tokens of a word, given as symbols of which the last is marked as such."""
        n, lengths = len(symbols), self.lengths
        longest = [-1] * (n + 1)
        for last, t in self.match.iter(symbols):
            at = last + 1 - lengths[t]
            longest[at] = t  # matches come by rising end, so the longest of a place is the last
        open_ = [True] * (n + 1)
        out: list[int] = []
        at, t = 0, longest[0]
        while at < n:
            while t >= 0 and not (open_[at + lengths[t]] and (not out or self.compatible(out[-1], t))):
                t = self.shorter[t]
            if t >= 0:
                out.append(t)
                at += lengths[t]
                t = longest[at]
            else:
                open_[at] = False
                t = out.pop()
                at -= lengths[t]
        return out

    def word(self, piece: str) -> bytes:
        """The ids of a pretoken as little-endian unsigned 32-bit integers."""
        raw = piece.encode()
        tokens = self.backtrack("".join([self.inner[b] for b in raw[:-1]]) + self.last[raw[-1]])
        if len(self.words) >= KEPT:
            self.words.clear()
        self.words[piece] = out = np.array([self.ids[t] for t in tokens], "<u4").tobytes()
        return out

    def plain(self, text: str, out: list[bytes]) -> None:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case here knows no final form
            text = self.blank.sub(" ", text)
        known, word = self.words.get, self.word
        out += [known(x) or word(x) for x in self.find(text.lower())]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers. Special tokens' strings become their ids."""
        out: list[bytes] = []
        if self.cut is None or not any(s in text for s in self.special):
            self.plain(text, out)
        else:
            for part in self.cut.split(text):
                if part in self.special:
                    out.append(np.array([self.special[part]], "<u4").tobytes())
                else:
                    self.plain(part, out)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 bytes of the decoded text: token strings with a space between, as the vocabulary file has no decoder."""
        which = np.frombuffer(ids, "<u4")
        out = []
        for at in range(0, len(which), 1 << 16):
            x = which[at : at + (1 << 16)]
            start, length = self.offsets[x], self.offsets[x + 1] - self.offsets[x]
            move = np.repeat(start - (np.cumsum(length) - length), length)
            out.append(self.bytes[move + np.arange(len(move))].tobytes())
        return b"".join(out)[1:]


def encoder(file: Broadcast) -> Encoder:
    """One encoder for each worker process; what building it took besides is given back."""

    def make() -> Encoder:
        out = Encoder(file.value)
        trim()
        return out

    return tool(("encoder", hash(file.value)), make)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, decoded_too: bool = True) -> DataFrame:
    """Encode and decode every text of docs with the vocabulary file at path.

    Returns doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers), decoded_sha256 (of the
    decoded text's UTF-8), and with keep also ids (array of int) and, with decoded_too, decoded (string). One row for each input row, without
    a shuffle. A null text is the empty text, which has no tokens. Null ids and repeated rows are kept as they are;
    other columns of docs are ignored. Texts of any length are encoded whole.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:  # read where the driver is; a vocabulary file is of fixed size
        file = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(file)
        for batch in in_parts(batches, limit=BYTES):
            ids = [e.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())]
            if "decoded" in names:
                decoded = [e.decode(x) for x in ids]
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()))
            else:
                columns.append(pa.array([hashlib.sha256(e.decode(x)).hexdigest() for x in ids], pa.string()))
            if keep:
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), "<i4")))
            if "decoded" in names:
                columns.append(pa.array([x.decode() for x in decoded], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep + ["decoded"] * (keep and decoded_too)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {dict(base.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep + ", decoded string" * (keep and decoded_too)
    return base.mapInArrow(lean(run, tools=True), schema)
