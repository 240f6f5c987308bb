"""Mixing sources to target weights, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import small, written

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone: the first 52 bits of an MD5."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def ranked(sources: DataFrame, key: str) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point of ``key``, null last.

    Range partitions are numbered apart and shifted by the sizes of those
    before them, so no task sorts all sources. The window that sums sizes has
    a row per partition.
    """
    placed = written(sources.repartitionByRange(F.col(key).asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col(key).asc_nulls_last()))
    return placed.join(F.broadcast(before), "part").withColumn("rank", inside - 1 + F.col("before")).drop("part", "before")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per source: ``source, source_size, weight, target``.

    ``sizes`` has ``source, size``. Sources take ``weights`` in turn, by code
    point with null last, and share the total size; a target stops at ``most``
    times its source's size and the excess goes to the others by weight, until
    none is above. Each turn of the loop is one aggregation over the sources
    that gives three numbers; it ends when no further source is capped.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.array(*[F.lit(w) for w in weights])
    per = written(ranked(per, "source").withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int"))), "weights")
    total, share = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1))).first()
    rest, capped = total, -1
    limit = F.col("source_size") * most
    while True:
        over = F.col("weight") * F.lit(float(rest)) / F.lit(float(share)) > limit
        n, taken, free = per.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == capped or not free:
            break
        rest, share, capped = total - taken, free, n
    even = F.col("weight") * F.lit(float(rest)) / F.lit(float(share))
    return per.select("source", "source_size", "weight", F.least(even, limit.cast("double")).alias("target"))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size``, the number of words of ``text``, and ``digest``, its MD5."""
    docs = docs.drop(*(c for c in ("size", "digest") if c in docs.columns and c != text))
    return docs.withColumns({"size": word_count(F.col(text)), "digest": F.md5(F.coalesce(F.col(text), F.lit("")))})


def placed(docs: DataFrame, key: str, source: str) -> DataFrame:
    """``docs`` with ``place``: 1, or the row's number among rows of equal ``key``, ``source`` and ``digest``.

    Only rows that repeat are numbered. They are counted by task, and a task's
    numbers begin where those of tasks before it end, so a row that repeats
    very often is spread over tasks.
    """
    alike = (key, source, "digest")

    def met(left: DataFrame, right: DataFrame, *more: str):
        pairs = [left[c].eqNullSafe(right[f"__{c}"]) for c in (*alike, *more)]
        return reduce(lambda x, y: x & y, pairs)

    repeated = written(docs.groupBy(*alike).count().where("count > 1").select(*(F.col(c).alias(f"__{c}") for c in alike)), "repeated")
    if repeated.isEmpty():
        return docs.withColumn("place", F.lit(1).cast("long"))
    few = small(repeated)
    once = docs.join(few, met(docs, few), "left_anti").withColumn("place", F.lit(1).cast("long"))
    several = written(docs.join(few, met(docs, few), "left_semi").withColumn("task", F.spark_partition_id()), "several")
    by_task = several.groupBy(*alike, "task").agg(F.count("*").alias("n"))
    before = by_task.withColumn("before", F.sum("n").over(Window.partitionBy(*alike).orderBy("task")) - F.col("n"))
    before = before.select(*(F.col(c).alias(f"__{c}") for c in (*alike, "task")), "before")
    inside = several.withColumn("place", F.row_number().over(Window.partitionBy(*alike, "task").orderBy("size")))
    numbered = inside.join(before, met(inside, before, "task")).withColumn("place", F.col("place") + F.col("before"))
    return once.union(numbered.select(*once.columns))


def mixed_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = "mix") -> DataFrame:
    """``copied`` of ``docs`` with ``size``."""
    return copied(sized(docs, text), key, source, weights, most, seed)


def copied(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = "mix") -> DataFrame:
    """``docs``, which ``sized`` gave ``size`` and ``digest``, with ``source_size, target, copies``, a row each.

    A source's rate is target / source_size. A document is taken floor(rate)
    times, plus once more if a number in [0, 1) made from its key, text, place
    among rows equal in these and in source, and ``seed`` is below the fraction; so reruns
    agree and none exceeds ``most`` copies, and rows of null or equal keys draw
    each a number of their own. Null and empty texts have size 0 and no
    bearing on targets; a source of size 0 has target 0 and no copies. Null is
    a source of its own. Further columns stay; those named as one of the new
    columns are replaced.
    """
    docs = docs.drop(*(c for c in ("source_size", "target", "copies", "place") if c in docs.columns))
    targets = source_targets(docs.select(F.col(source).alias("source"), "size"), weights, most)
    targets = targets.select(F.col("source").alias("__source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = hash_unit(F.lit(seed), F.col(key), F.col("digest"), F.col("place"))
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    mixed = placed(docs, key, source)
    return mixed.join(small(targets), F.col(source).eqNullSafe(F.col("__source"))).withColumn("copies", copies).drop("__source", "digest", "place")


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row of ``mixed_copies`` as often as it is taken, numbered in ``copy`` from 1."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
