"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue of its shuffled documents, repeated up to `max_epochs` times. A
document's virtual finish time is the number of tokens its source has served by then, divided
by the source's weight. All copies sorted by that time and cut at the total budget are the
mixture. The cut lies at one virtual time for all sources; a source that has served all its
copies before stops there, so the others' shares grow by their weights: the time of the cut is
found from the sums per source alone, and copies beyond it are never made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramlag.llm.common import WORD, free

#: Hex digits of the shuffling hash that name the coarse and the fine bucket of a prefix sum.
DIGITS = 3


def word_count(text: str) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sums: DataFrame, max_epochs: int = 3, weights: tuple = (1, 2, 3)) -> DataFrame:
    """(source, source_size) -> with weight and target. One row per source goes through one task.

    Weights repeat over the sources in code point order, null last. The total of all sizes is
    shared by weight, at most `max_epochs` times a source's size each, the rest reshared.
    """
    everywhere = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everywhere.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    own = sums.withColumn("weight", F.element_at(listed, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    most = (F.col("source_size") * max_epochs).cast("double")
    by_ratio = everywhere.orderBy(most / F.col("weight"), "weight", "source")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumn("most", most).withColumn("filled", F.sum("most").over(upto))
    own = own.withColumn("weighed", F.sum("weight").over(upto))
    total, all_weight = F.sum("source_size").over(everywhere), F.sum("weight").over(everywhere)
    # virtual time at which the budget ends if just the sources up to this one are at their most
    own = own.withColumn("level", (total - F.col("filled") + F.col("most")) / (all_weight - F.col("weighed") + F.col("weight")))
    capped = F.col("most") <= F.col("level") * F.col("weight")
    # beyond the first source below its most, levels only fall
    own = own.withColumn("ends", F.max(F.when(~capped, F.col("level"))).over(everywhere))
    target = F.when(F.col("ends").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("ends") * F.col("weight")))
    return own.select("source", "source_size", "weight", target.alias("target"))


def queues(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    max_epochs: int = 3,
    weights: tuple = (1, 2, 3),
    seed: str = "mix",
) -> DataFrame:
    """All rows and columns of `docs` with _size, _source_size, _target, _before (words ahead of
    the row in its source's queue) and _taken (words the mixture takes, repeats counted); a name
    gets underscores behind it should `docs` have such a column.

    The last copy that a source may serve is cut at the word, so sources meet their targets to
    the word. A null source is a source of its own. Null and empty texts have size 0 and are
    never taken. Rows that repeat an id stand next to one another, by size and hash of the
    text; equal rows are interchangeable. An empty table gives an empty result.
    """
    placed = _placed(docs, id_column, text, source, max_epochs, weights, seed)
    own = [F.col("doc")[c].alias(c) for c in docs.columns]
    return placed.select(*own, *[F.col(c).alias(free(docs, f"_{c}")) for c in ("size", "source_size", "target", "before", "taken")])


def _placed(docs, id_column="doc_id", text="text", source="source", max_epochs=3, weights=(1, 2, 3), seed="mix") -> DataFrame:
    """(doc: the row, size, source_size, target, weight, before, taken).

    A hot source is no hot task: prefix sums come from sums per (source, hash bucket), and a
    window holds the rows of one bucket only.
    """
    name = F.concat(F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    key = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), word_count(text).alias("size"), F.md5(name).alias("order"), key.alias("key")
    ).withColumn("bucket", F.substring("order", 1, DIGITS))
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.withColumn("ahead", F.coalesce(F.sum("words").over(in_source), F.lit(0))).drop("words")
    per_source = sums.groupBy("key").agg(F.sum("words").alias("source_size"))
    named = per_source.withColumn("source", F.when(F.col("key") != "", F.expr("substring(key, 2)")))
    goals = targets(named, max_epochs, weights).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    # one row per bucket of a source: the goals join here, not to the rows
    places = ahead.join(goals.drop("source"), "key")
    in_bucket = Window.partitionBy("key", "bucket").orderBy("order", "size", F.xxhash64(F.col("doc")[text]))
    upto = F.sum("size").over(in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("in_bucket", upto - F.col("size")).join(places, ["key", "bucket"])
    placed = placed.withColumn("before", F.col("in_bucket") + F.col("ahead"))
    return placed.withColumn("taken", F.expr(TAKEN)).drop("in_bucket", "ahead", "bucket")


#: Whole passes over the source, then what the last pass reaches.
TAKEN = """
case when source_size = 0 then 0
else cast(floor(target) as bigint) div source_size * size
   + greatest(0, least(size, cast(floor(target) as bigint) % source_size - before)) end
"""


def finish_time(copy: Column) -> Column:
    """Virtual time at which a copy of a document has been served: the words of its source up to
    its last one, those of earlier passes counted, by the source's weight."""
    return (copy * F.col("source_size") + F.col("before") + F.col("size")) / F.col("weight")


def copies(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc, order, copy, finish, words): a row for each copy that the mixture takes, and how many words of it.

    The budget is spent at one virtual time for all sources. Copies that have finished by then are
    whole; the one that its source is being served then is cut at the word.
    """
    rows = _placed(docs, text=text, **options).where("taken > 0")
    each = rows.withColumn("copy", F.explode(F.expr("sequence(0, cast((taken - 1) div size as int))")))
    words = F.expr("least(size, taken - copy * size)")
    return each.select("doc", "key", "order", "size", "copy", finish_time(F.col("copy")).alias("finish"), words.alias("words"))


def mixture(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mixture as rows of `docs`: a row for each copy taken, columns as given, in the order of
    their finish times (sources and shuffled places among equal ones), range-sorted over all partitions.

    A copy that is cut holds its first words, joined by one space.
    """
    order = "finish", "key", "order", "size"
    fair = copies(docs, text, **options).repartitionByRange(*order).sortWithinPartitions(*order)
    whole = F.col("doc")[text]
    first = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), 1, F.col("words").cast("int")), " ")
    held = F.when(F.col("words") < F.col("size"), first).otherwise(whole)
    return fair.select(*[(held if c == text else F.col("doc")[c]).alias(c) for c in docs.columns])
