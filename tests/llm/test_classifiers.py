import random

from pyspark.sql import functions as F

from parcelight.llm import langid, quality
from parcelight.llm.common import table
from parcelight.llm.queries import op2_langid, op3_quality

SF = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    out = op2_langid(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_edges(docs):
    rnd = random.Random(1)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(6))
    rows = [(i, " ".join(word("abcde") for _ in range(80)), "xx") for i in range(20)] + [(i, " ".join(word("vwxyz") for _ in range(80)), "yy") for i in range(20, 40)]
    model = langid.learn(docs(rows + [(41, None, "xx"), (42, "abc", None), (43, "", "yy")]).select("text", "lang"))
    assert model.names == ("xx", "yy") and model.counts == (20, 20)
    asked = docs([(1, "abcde edcba baced"), (2, "zyxwv vwxyz wwxyz"), (3, None), (4, ""), (5, "123 !?"), (None, "abcde " * 20000), (1, "abcde edcba baced")], extra=True)
    out = [(r["doc_id"], r["lang_pred"]) for r in langid.classify(asked, model).collect()]
    assert out == [(1, "xx"), (2, "yy"), (3, "und"), (4, "und"), (5, "und"), (None, "xx"), (1, "xx")]
    none = langid.learn(docs([]).select("text", "lang"))
    assert [r["lang_pred"] for r in langid.classify(docs([(1, "abc")]), none).collect()] == ["und"]
    assert langid.classify(docs([]), model).count() == 0


def test_languages_reject_what_no_language_explains(spark):
    docs = table(spark, SF, "documents").select("text", "lang")
    model = langid.learn(docs)
    ask = langid.Classifier(model).predict
    rnd = random.Random(8)
    short = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (3, 5, 8) for _ in range(20)]
    tied = [t for t in short if langid.Classifier(model).judge(langid.normal(t))[2] == 0]
    assert tied and all(ask(t)[2] for t in tied)
    clean = [r["text"] for r in docs.where("length(text) > 100").limit(300).collect()]
    assert sum(ask(t)[2] for t in clean) <= 0.02 * len(clean)


def test_quality_held_out(spark):
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    out = op3_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in out if r["quality"] == q] for q in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in out)


def test_quality_edges(spark, docs):
    rows = [(i, "good plain words here " * 5, "en") for i in range(30)] + [(i, "bad### junk%%% bad###" * 5, "en") for i in range(30, 60)]
    marked = docs(rows).withColumn("quality", (F.col("doc_id") < 30).cast("int"))
    model = quality.learn(marked)
    assert quality.learn(marked) == model
    asked = docs([(1, "good words plain"), (2, "junk%%% bad###"), (3, None), (4, ""), (None, "plain " * 300_000)], extra=True)
    out = [(r["doc_id"], r["score"]) for r in quality.score(asked, model).select("doc_id", "score").collect()]
    assert out[0][1] > 0.5 > out[1][1] and out[2][1] == out[3][1] and len(out) == 5
    assert quality.score(docs([]), model).count() == 0
    empty = quality.learn(marked.where("false"))
    assert 0 <= quality.score(docs([(1, "x")]), empty).first()["score"] <= 1


def test_parts_of_long_texts_add_up(monkeypatch):
    text = b" ".join(b"w%d" % (k % 7) for k in range(50))
    whole = sorted(sum((x.tolist() for x in quality.features(text)), []))
    monkeypatch.setattr(quality, "STEP", 8)
    assert sorted(sum((x.tolist() for x in quality.features(text)), [])) == whole
