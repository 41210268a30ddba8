import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def corpus(docs):
    rnd = random.Random(6)
    words = {"xx": [f"al{rnd.choice('abcde')}{rnd.choice('abc')}o{k}" .translate(str.maketrans("0123456789", "abcdefghij")) for k in range(900)], "yy": [f"ur{rnd.choice('vwxyz')}{rnd.choice('uvw')}i{k}".translate(str.maketrans("0123456789", "qrstuvwxyz")) for k in range(900)]}
    text = lambda lang, n: [rnd.choice(words[lang]) for _ in range(n)]
    rows, passage = [], " ".join(text("xx", 60))
    for i in range(60):
        lang = "xx" if i % 3 else "yy"
        rows.append((i, " ".join(text(lang, 120)), lang, f"s{i % 4}"))
    near = rows[7][1].split()
    near[60] = "changed"
    rows += [(100, " ".join(near), "xx", "s1"), (101, rows[8][1], "xx", "s2"), (102, "start " + passage + " " + rows[9][1][:50], "xx", "s1"), (103, " ".join(text("xx", 80)) + " " + passage, "xx", "s0")]
    rows += [(104, None, "xx", "s1"), (105, "12 34 !", None, "s1"), (None, " ".join(text("xx", 90)), None, None), (3, rows[3][1], "yy", "s3")]
    return docs(rows)


def test_stages(spark, corpus, tmp_path):
    kept, at = corpus.select(COLUMNS), {}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, kept, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        kept = spark.read.parquet(str(tmp_path / str(k)))
        at[name] = kept.collect()
        if name != "tokens":
            assert kept.columns == COLUMNS
    ids = lambda name: Counter(r["doc_id"] for r in at[name])
    everything = Counter(r["doc_id"] for r in corpus.collect())
    assert ids("language") == everything - Counter([104, 105])
    assert ids("near_duplicates") == ids("language") - Counter([100, 101, 3])
    texts = {r["doc_id"]: r["text"] for r in at["near_duplicates"]}
    for r in at["repeated_passages"]:
        if r["doc_id"] == 103:
            assert len(r["text"]) < len(texts[103]) - 250 and texts[103].startswith(r["text"][:300]) and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == texts[r["doc_id"]]
    before = {r["doc_id"]: r for r in at["repeated_passages"]}
    assert all(n <= 3 for n in ids("mixture").values()) and all(before[r["doc_id"]] == r for r in at["mixture"])
    words = lambda name: sum(len(r["text"].split()) for r in at[name])
    assert abs(words("mixture") - words("repeated_passages")) < 0.1 * words("repeated_passages")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r["doc_id"], tuple(library.encode(r["text"], add_special_tokens=False).ids)) for r in at["mixture"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in at["tokens"]) == want


def test_run_on_an_empty_table(spark, docs, tmp_path):
    docs([]).select(COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
