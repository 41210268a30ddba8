import hashlib
import random
import struct

import public_tokenizers
from tokenizers import Tokenizer, models, pre_tokenizers

from parcelight.llm import bpe, unigram

LETTERS = "abcdefghij  \n\t'sléÉßΣσςİıǅ中文123٣½Ⅷ!?#$%…— \u0085\x1c\x0b🙂👍’　THEÀﬁ▁<0x"


def texts():
    rnd = random.Random(3)
    out = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    return out + ["<|endoftext|>", "a<|startoftext|>b <|endoftext|> <|END", "a" * 5000, "", " ", "don't we've they'll 'Sam", "<s>", "a<0x0A> b", "▁a", "🙂🙂x🙂"]


def test_bpe_is_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = list(enumerate(texts())) + [(None, None), (1, "same"), (1, "same")]
    out = bpe.encode(docs(rows, extra=True), path, keep=True).collect()
    assert len(out) == len(rows)
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.setdefault(i, set()).add((len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), tuple(ids), decoded))
    for r in out:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), r["decoded"]) in want[r["doc_id"]]


def test_bpe_long_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), bpe.Encoder(open(path, encoding="utf-8").read())
    rnd = random.Random(5)
    for n in (1, 2, 50, 3000):
        word = "".join(rnd.choice("thenranigo") for _ in range(n))
        assert list(struct.unpack(f"<{len(mine.encode(word)) // 4}I", mine.encode(word))) == library.encode(word, add_special_tokens=False).ids


def test_unigram_counts_are_the_library(docs):
    pieces = unigram.model_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rows = list(enumerate(texts())) + [(-1, None)]
    out = {r["doc_id"]: (r["n_chars"], r["n_tokens"]) for r in unigram.token_counts(docs(rows, extra=True), pieces).collect()}
    assert out == {i: (len(t or ""), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}


def test_unigram_ties_and_unknowns():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("bb", -2.0)]
    library = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    mine = unigram.Counter(pieces)
    for t in ("ab", "aab", "abb", "abab bb", "xab", "axxb", "xx", "ab x"):
        assert mine.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


def test_empty(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encode(docs([]), path).count() == 0
    assert unigram.token_counts(docs([]), [("a", -1.0)]).count() == 0


def test_ids_without_decoded_texts(spark, docs):
    """The ids alone are sent when nobody wants the decoded texts; all other columns are the same."""
    table = docs([(1, "The cat's whiskers, café 12"), (2, None), (3, "")])
    path = public_tokenizers.path("word_bpe_49k.json")
    both, one = bpe.encode(table, path, keep=True), bpe.encode(table, path, keep=True, decoded_too=False)
    assert one.columns == both.columns[:-1]
    assert sorted(both.drop("decoded").collect()) == sorted(one.collect())


def test_encoder_keeps_within_its_limits(monkeypatch):
    """Words and pairs remembered never outgrow their limits, and forgetting them changes no ids."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        file = f.read()
    words = [f"{a}{b}ing" for a in ("re", "un", "qz", "over") for b in ("act", "bxk", "mak", "zzq", "plow")]
    plain = bpe.Encoder(file).encode(" ".join(words))
    monkeypatch.setattr(bpe, "KEPT", 3)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    e = bpe.Encoder(file)
    assert e.encode(" ".join(words)) == plain and len(e.words) <= 3 and len(e.pairs) <= 5
