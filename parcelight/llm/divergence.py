"""Audit of how far the sources of a language diverge in the terms they use.

Each (language, source) group gives every kept term of its language a probability, by counts that are smoothed by two.
The divergence of two groups is a sum over all kept terms, but most terms are in one of them or in neither. By inclusion
and exclusion over the supports it is put together from parts that are short: a term that only one group has is priced
by its count alone, so a histogram of counts stands for all of them; the terms that both have are found by joining the
postings, and correct what the two histograms have added; the terms of neither are a constant times their number.
All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, in_parts, lean, small

#: Probabilities are in units of 1 / SCALE; counts are smoothed by SMOOTH.
SCALE, SMOOTH = 1_000_000_000, 2
#: Entries counted in a task, and MB of text read, before they go on.
HELD, HELD_MB = 200_000, 64
#: Everything in ASCII but letters to a blank, capitals to small letters.
FOLD = bytes(32 if c < 128 and not chr(c).isalpha() else c + 32 if 65 <= c <= 90 else c for c in range(256))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it). Each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = {}
        seen: dict[tuple, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), words in n.items():
                within = seen[lang, source]
                columns = [pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(words.values(), pa.int64()), pa.array([within[w] for w in words], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            n.clear()
            seen.clear()

        held = read = 0
        for batch in in_parts(batches):
            for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = Counter(text.encode().translate(FOLD).split(b" "))
                words.pop(b"", None)
                mine = n.setdefault((lang, source), Counter())
                held -= len(mine)
                mine.update(words)
                held += len(mine)
                seen.setdefault((lang, source), Counter()).update(words.keys())
                read += len(text)
            if held > HELD or read > HELD_MB << 20:
                yield from out()
                held = read = 0
        yield from out()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counted = rows.mapInArrow(lean(run), "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * v)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + SMOOTH), wide(total + SMOOTH * v)).cast("long")


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); 0 where both are 0, as in a language without kept terms."""
    return F.call_function("div", (p - q) * (p - q), F.greatest(p + q, F.lit(1)))


class Audit:
    """What the sources of docs use. min_docs: a term is kept if so many documents of its language have it.

    groups: lang, source, total (occurrences of kept terms), k (kept terms it has), v (kept terms of the language), zero
    (probability of a term it has not). postings: lang, source, term, n, p for the kept terms a group has, q (the whole
    language's p). Null text, lang or source is the empty string. Repeated rows count as often as they come. A language
    may keep no term; its groups are there all the same. An empty table has no groups.
    """

    def __init__(self, docs: DataFrame, min_docs: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> None:
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        counts = cut(term_counts(docs, lang_col, source_col, text_col))
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("whole")).where(F.col("df") >= min_docs).drop("df")
        kept = cut(kept)
        langs = small(cut(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("whole").alias("whole_total"))))
        used = cut(counts.drop("docs").join(kept, ["lang", "term"]))
        totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
        every = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
        none = F.lit(0).cast("long")
        groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "k", "v", "whole_total"])
        self.groups = cut(groups.withColumn("zero", F.when(F.col("v") > 0, probability(none, F.col("total"), F.col("v"))).otherwise(none)))
        self.postings = cut(
            used.join(small(self.groups.select("lang", "source", "total", "v", "whole_total")), ["lang", "source"])
            .withColumn("p", probability(F.col("n"), F.col("total"), F.col("v")))
            .withColumn("q", probability(F.col("whole"), F.col("whole_total"), F.col("v")))
            .select("lang", "source", "term", "n", "p", "q")
        )

    def pairs(self) -> DataFrame:
        """lang, a, b, value: the divergence of each two groups a < b of a language, summed over all its kept terms."""
        sides = ["source", "v", "k", "zero"]
        side = lambda df, x, cols: df.select("lang", *[F.col(c).alias(f"{c}_{x}") for c in cols])
        two = side(self.groups, "a", sides).join(side(self.groups, "b", sides), "lang").where("source_a < source_b")
        neither = two.select("lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"), ((F.col("v_a") - F.col("k_a") - F.col("k_b")) * distance(F.col("zero_a"), F.col("zero_b"))).alias("value"))

        histogram = self.postings.groupBy("lang", "source", "n", "p").agg(F.count(F.lit(1)).alias("terms"))
        against = histogram.join(small(side(self.groups, "b", ["source", "zero"])), "lang").where("source <> source_b")
        one = against.groupBy("lang", F.least("source", "source_b").alias("a"), F.greatest("source", "source_b").alias("b")).agg(F.sum(F.col("terms") * distance(F.col("p"), F.col("zero_b"))).alias("value"))

        priced = self.postings.join(small(self.groups.select("lang", "source", "zero")), ["lang", "source"])
        post = lambda x: priced.select("lang", "term", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "p", "zero")])
        c = F.col
        overlap = distance(c("p_a"), c("p_b")) - distance(c("p_a"), c("zero_b")) - distance(c("zero_a"), c("p_b")) + distance(c("zero_a"), c("zero_b"))
        both = post("a").join(post("b"), ["lang", "term"]).where("source_a < source_b").groupBy("lang", c("source_a").alias("a"), c("source_b").alias("b")).agg(F.sum(overlap).alias("value"))
        return neither.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    def terms(self, most: int = 10) -> DataFrame:
        """lang, source, item, value, rank: the terms that a group has more often than its language, most divergent first."""
        over = self.postings.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
        return over.withColumn("rank", F.row_number().over(ranking())).where(F.col("rank") <= most)


def ranking() -> Window:
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")


def audit(docs: DataFrame, most: int = 10, min_docs: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: part pair has each other source of the language, part term the most
    divergent terms of a group. Ties go by the item's bytes."""
    found = Audit(docs, min_docs)
    pairs = cut(found.pairs())
    ways = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    ranked = ways.withColumn("rank", F.row_number().over(ranking()))
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(ranked, "pair").unionByName(part(found.terms(most), "term"))


#: The same rows in DuckDB, by summing over all terms.
SQL = r"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
  occ as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
  kept as (select lang, term, count(*) as whole from occ group by 1, 2 having count(distinct r) >= 10),
  langs as (select lang, count(*) as v, sum(whole) as total from kept group by 1),
  counts as (select lang, source, term, count(*) as n from occ join kept using (lang, term) group by all),
  groups as (select lang, source, coalesce(sum(n), 0) as total from (select distinct lang, source from d) left join counts using (lang, source) group by all),
  p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v))::hugeint as p, (1 + (1000000000::hugeint * (k.whole + 2)) // (l.total + 2 * l.v))::hugeint as q
    from groups g join langs l using (lang) join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
  sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
  pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
  terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::bigint as value from p where n > 0 and p > q)
select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (from pairs union all from terms) qualify part = 'pair' or rank <= 10"""
