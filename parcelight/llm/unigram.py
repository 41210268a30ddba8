"""Token counts of a unigram tokenizer, by a Viterbi pass that carries only scores and counts.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each place of a word. The best score of a place is
the best, over those pieces, of the score where the piece begins plus its own; ties go to the piece that begins
earliest, as only a better score replaces one already found. With the score goes the number of tokens so far, so no path
is kept or walked back. A character that is no piece takes the lowest score less 10; neighbouring ones melt into one
token, or into one for each of their UTF-8 bytes if the vocabulary has byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_parts, lean, tool

#: Distinct words remembered in a worker.
KEPT = 400_000
#: The sign that stands for a space.
SPACE = "▁"
PENALTY = 10.0


class Counter:
    """Counts the tokens of texts for a list of (piece, score); bytes_: pieces <0x00> to <0xFF> take unknown characters."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_: bool = True) -> None:
        vocab = {p: (len(p), s) for p, s in pieces if p}
        self.match = ahocorasick.Automaton()
        for p, v in vocab.items():
            self.match.add_word(p, v)
        self.match.make_automaton()
        self.single = {p for p in vocab if len(p) == 1}
        self.unknown = min(s for _, s in vocab.values()) - PENALTY
        self.bytes = bytes_ and all(f"<0x{b:02X}>" in vocab for b in range(256))
        self.words: dict[str, int] = {}

    def word(self, piece: str) -> int:
        """Tokens of one word, which has its space sign in front."""
        n = len(piece)
        score: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)  # tokens up to a place, a run of unknown characters that ends there not counted
        run = [0] * (n + 1)  # what that run counts for
        score[0] = 0.0
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (k, s) in self.match.iter(piece):
            ends[last + 1].append((last + 1 - k, s))
        for e in range(1, n + 1):
            best, at, kind = None, -1, False
            if piece[e - 1] not in self.single:
                ends[e].append((e - 1, self.unknown))
            for start, s in sorted(ends[e]):  # the earliest begins first; each place can be reached, so scores are known
                x = s + score[start]
                if best is None or x > best:
                    best, at = x, start
            kind = at == e - 1 and piece[e - 1] not in self.single
            score[e] = best
            if kind:
                count[e] = count[at]
                run[e] = run[at] + len(piece[at].encode()) if self.bytes else 1
            else:
                count[e] = count[at] + run[at] + 1
        out = count[n] + run[n]
        if len(self.words) >= KEPT:
            self.words.clear()
        self.words[piece[1:]] = out
        return out

    def count(self, text: str) -> int:
        """Tokens of a text: spaces become signs, one is put in front, and each sign begins a word."""
        if not text:
            return 0
        known, word = self.words.get, self.word
        parts = text.replace(" ", SPACE).removeprefix(SPACE).split(SPACE)
        return sum([known(x) or word(SPACE + x) for x in parts])


def model_pieces(path: str) -> list[tuple[str, float]]:
    """The pieces and scores of a sentencepiece model file, read where the driver is."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def counter(pieces: Broadcast) -> Counter:
    """One counter for each worker process."""
    return tool(("counter", hash(tuple(pieces.value))), lambda: Counter(pieces.value))


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points), n_tokens for each row of docs, without a shuffle.

    A null or empty text has no tokens. Null ids and repeated rows are kept as they are; other columns of docs are
    ignored. Texts of any length are counted whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(shared)
        for batch in in_parts(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array([c.count(t) for t in texts], pa.int64())], ["doc_id", "n_chars", "n_tokens"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(lean(run, tools=True), f"doc_id {dict(base.dtypes)['doc_id']}, n_chars long, n_tokens long")
