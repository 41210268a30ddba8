"""Audit of how text filters interact, over all orders in which they can be applied.

What a filter removes at a step depends only on which filters came before, not on their order. So with n filters a
document counts towards the n * 2^(n-1) edges of the subset lattice, each (filters already applied, next filter), and an
order is a path of n edges. Documents are first counted by what decides their share of all edges (part, failed filters,
labels); these counts are spread over the edges, and the edges joined to the steps of all orders.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: The white space between words.
GAP = r"[\x20\x09-\x0D]+"
#: Name of the filter that fails texts which a smaller id has as well.
COPY = "E"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides on its own."""
    words = F.array_remove(F.split(text, GAP), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", filters: Mapping[str, Column] | None = None) -> DataFrame:
    """doc_id, part, fails for each row of docs; fails has a bit for each filter: the given ones in order, the copies' last.

    The text's digest stands for the text where copies are looked for. A null text is the empty text, a null part the
    empty string. A row without an id has no smaller one and is smaller than none. Rows of one id and one text are not
    copies of each other.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    filters = text_filters(text) if filters is None else filters
    bits = sum((F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)) for k, fails in enumerate(filters.values())), F.lit(0))
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), bits.alias("fails"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")))
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(firsts, "digest", "left").select("doc_id", "part", (F.col("fails") + F.when(copy, F.lit(1 << len(filters))).otherwise(F.lit(0))).alias("fails"))


def audit(failed: DataFrame, names: str, good: DataFrame | None = None, toxic: DataFrame | None = None) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a row for each
    part of failed (doc_id, part, fails), each order of the filters and each step, zeros included.

    names: a letter for each bit of fails. good and toxic: ids of marked documents (repeated and null ones do no harm).
    Rows are counted one by one, repeated ones too. An empty table gives no rows.
    """
    marks = None
    for name, ids in (("good", good), ("toxic", toxic)):
        if ids is not None:
            some = ids.select(F.col(ids.columns[0]).alias("marked_id"), *[F.lit(name == x).alias(x) for x in ("good", "toxic")])
            marks = some if marks is None else marks.unionByName(some)
    if marks is None:
        marked = failed.withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    else:
        marks = marks.where("marked_id is not null").groupBy("marked_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        marked = failed.join(marks, failed["doc_id"] == marks["marked_id"], "left")
    one = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    classes = marked.select("part", "fails", one("good"), one("toxic")).groupBy("part", "fails", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))

    spark, size = failed.sparkSession, len(names)
    edges = [(before, k) for before in range(1 << size) for k in range(size) if not before >> k & 1]
    steps = [("".join(names[k] for k in p), s + 1, sum(1 << k for k in p[:s]), k) for p in permutations(range(size)) for s, k in enumerate(p)]
    edge_table = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(k).alias("filter")) for before, k in edges])
    step_table = spark.createDataFrame(steps, "filter_order string, step int, before int, filter int")  # size! * size rows

    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    fails, passed = F.col("fails").bitwiseAND(bit) != 0, F.col("fails").bitwiseAND(F.col("before")) == 0
    summed = lambda hit: F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0)))
    on_edges = (
        classes.withColumn("edge", F.explode(edge_table))
        .select("part", "fails", "good", "toxic", "n", "edge.before", "edge.filter")
        .withColumn("bit", bit)
        .groupBy("part", "before", "filter")
        .agg(
            summed(passed & ~fails).alias("kept"),
            summed(passed & fails).alias("removed"),
            summed(~passed & fails).alias("redundant"),
            summed(F.col("fails") == F.col("bit")).alias("unique_fails"),
            summed(passed & fails & F.col("good")).alias("good_lost"),
            summed(passed & fails & F.col("toxic")).alias("toxic_lost"),
        )
    )
    whole = Window.partitionBy("part", "filter")  # size! rows
    paths = on_edges.join(F.broadcast(step_table), ["before", "filter"])
    return paths.select("part", "filter_order", "step", *COUNTS, F.sum("removed").over(whole).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters A to E over documents, with marks from labels (doc_id, quality, toxic)."""
    return audit(failures(docs), "ABCDE", labels.where("quality = 1").select("doc_id"), labels.where("toxic = 1").select("doc_id"))


#: The same rows in DuckDB.
SQL = r"""
with recursive words as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
  firsts as (select text, min(doc_id) as first from words group by 1),
  marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
  f as (select part, (len(w) < 50)::int + (100 * len(list_distinct(w)) < 65 * len(w))::int * 2 + (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int * 4
      + regexp_matches(text, '[#$%&*|]')::int * 8 + coalesce(doc_id > first, false)::int * 16 as fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic
    from words join firsts using (text) left join marks using (doc_id)),
  classes as (select part, fails, good, toxic, count(*) as n from f group by all),
  orders as (select '' as filter_order, 0 as before, 0 as step, 0 as filter, 0 as done
    union all select filter_order || substr('ABCDE', k::int + 1, 1), done, step + 1, k::int, done + (1 << k::int) from orders, range(5) r(k) where (done >> k::int) % 2 = 0),
  whole as (select filter_order from orders where step = 5),
  steps as (select w.filter_order, o.step, o.before, o.filter from whole w join orders o on o.step > 0 and w.filter_order[1:o.step] = o.filter_order),
  edges as (select distinct before, filter from steps),
  counts as (select part, before, filter,
      coalesce(sum(n) filter (where fails & before = 0 and (fails >> filter) % 2 = 0), 0)::bigint as kept,
      coalesce(sum(n) filter (where fails & before = 0 and (fails >> filter) % 2 = 1), 0)::bigint as removed,
      coalesce(sum(n) filter (where fails & before <> 0 and (fails >> filter) % 2 = 1), 0)::bigint as redundant,
      coalesce(sum(n) filter (where fails = 1 << filter), 0)::bigint as unique_fails,
      coalesce(sum(n) filter (where fails & before = 0 and (fails >> filter) % 2 = 1 and good), 0)::bigint as good_lost,
      coalesce(sum(n) filter (where fails & before = 0 and (fails >> filter) % 2 = 1 and toxic), 0)::bigint as toxic_lost
    from classes, edges group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, filter)::bigint as shapley
from counts join steps using (before, filter)"""
