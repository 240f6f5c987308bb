"""Deletes, truncation, snapshots, schema changes and routing, as reads of the changed table."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.types import SchemaError, column_type
from .spec import ColumnSpec, TableSpec


def without_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` that match no row of ``keys`` in the columns of ``keys``; null matches null."""
    other = keys.toDF(*(f"__{c}" for c in keys.columns))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys.columns])
    return df.join(other, same, "left_anti")


def truncated(df: DataFrame, ts: str, ranges: list[tuple[int, int]], unit: int = 10**3) -> DataFrame:
    """Rows outside all ``ranges`` [start, end), given in ``unit`` parts of a second; without ranges no row is left.

    Ranges are part of the statement, so they become one predicate that
    reaches the scan. Rows without a time stay.
    """
    if not ranges:
        return df.limit(0)
    t = F.col(ts).cast("timestamp")
    scale = 10**6 // unit
    hit = reduce(lambda a, b: a | b, [(t >= F.timestamp_micros(F.lit(a * scale))) & (t < F.timestamp_micros(F.lit(b * scale))) for a, b in ranges])
    return df.where(~F.coalesce(hit, F.lit(False)))


#: Buckets of time that many ranges are cut by, at most.
BUCKETS = 1 << 18


def truncated_by(df: DataFrame, ts: str, ranges: DataFrame, unit: int = 10**3) -> DataFrame:
    """As ``truncated``, with ``ranges`` a table of ``start, end``: without rows it takes all; ranges without a length or a bound take nothing.

    Time is cut into at most ``BUCKETS`` buckets of equal width between the
    first start and the last end. Of a range, the buckets that lie within it
    are counted at its two ends only, and running sums over the buckets say
    which are covered; the rest of it is one piece in each bucket of its ends,
    and of pieces that begin together the longest is kept. A row meets its own
    bucket's pieces in one equi-join, however many ranges there are; a bucket
    has few of them unless ranges crowd within one width.
    """
    scale = 10**6 // unit
    cut = ranges.select((F.col("start") * scale).cast("long").alias("a"), (F.col("end") * scale).cast("long").alias("b")).where("b > a").distinct()
    low, high = cut.agg(F.min("a"), F.max("b")).first()
    if low is None:
        return df.limit(0) if ranges.isEmpty() else df
    width = max(1, -(-(high - low) // BUCKETS))
    placed = cut.select("a", "b", F.expr(f"(a - {low}L) div {width}L").alias("first"), F.expr(f"(b - 1 - {low}L) div {width}L").alias("last"))
    steps = placed.where("last > first + 1").select(F.explode(F.array(F.struct((F.col("first") + 1).alias("bucket"), F.lit(1).alias("step")), F.struct(F.col("last").alias("bucket"), F.lit(-1).alias("step")))).alias("x")).select("x.*")
    steps = steps.groupBy("bucket").agg(F.sum("step").alias("step"))
    along = Window.orderBy("bucket")  # a row for each of BUCKETS at most
    spans = steps.select("bucket", F.sum("step").over(along).alias("depth"), F.lead("bucket").over(along).alias("next")).where("depth > 0")
    covered = spans.select(F.explode(F.expr("sequence(bucket, next - 1)")).alias("bucket")).distinct().select("bucket", F.lit(True).alias("whole"), F.lit(None).cast("array<struct<a:bigint,b:bigint>>").alias("pieces"))
    ends = placed.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("bucket"), "a", "b")
    ends = ends.select("bucket", F.greatest("a", F.col("bucket") * width + low).alias("a"), F.least("b", (F.col("bucket") + 1) * width + low).alias("b"))
    longest = ends.groupBy("bucket", "a").agg(F.max("b").alias("b"))  # of pieces that begin together the longest
    pieces = longest.groupBy("bucket").agg(F.lit(False).alias("whole"), F.array_sort(F.collect_list(F.struct("a", "b"))).alias("pieces"))
    known = covered.union(pieces).groupBy("bucket").agg(F.max("whole").alias("whole"), F.max("pieces").alias("pieces"))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.withColumn("__us", us).withColumn("__bucket", F.expr(f"if(__us >= {low}L and __us < {high}L, (__us - {low}L) div {width}L, null)"))
    met = rows.join(known.withColumnRenamed("bucket", "__bucket"), "__bucket", "left")
    hit = F.col("whole") | F.exists("pieces", lambda p: (F.col("__us") >= p["a"]) & (F.col("__us") < p["b"]))
    return met.where(~F.coalesce(hit, F.lit(False))).select(*df.columns)


def snapshot(df: DataFrame, partition: str, sequence: str, bounds: DataFrame) -> DataFrame:
    """Rows whose sequence is within their partition's bound in ``bounds`` (its name, ``upto``); partitions without one are left out.

    Bounds are a table, so there may be as many partitions as there are rows;
    Spark broadcasts it if it is small.
    """
    most = bounds.groupBy(partition).agg(F.max("upto").alias("__upto"))
    return df.join(most, partition).where(F.col(sequence) <= F.col("__upto")).select(*df.columns)


@dataclasses.dataclass(frozen=True)
class Change:
    """One step of a schema change: ``add`` (first, or after a column), ``drop``, ``retype`` or ``default``."""

    kind: str
    column: str
    spec: ColumnSpec | None = None
    after: str | None = None
    first: bool = False
    type: str | None = None
    default: object = None


def evolved(spec: TableSpec, changes: list[Change], name: str | None = None) -> TableSpec:
    """``spec`` after ``changes``, under ``name`` if it is renamed."""
    columns = list(spec.columns)
    for c in changes:
        at = next((k for k, x in enumerate(columns) if x.name == c.column), None)
        if c.kind == "add":
            if at is not None or c.spec is None:
                raise SchemaError(f"cannot add {c.column!r}")
            names = [x.name for x in columns]
            columns.insert(0 if c.first else names.index(c.after) + 1 if c.after else len(columns), c.spec)
            continue
        if at is None:
            raise SchemaError(f"no column {c.column!r}")
        if c.kind == "drop":
            if columns[at].semantic != "field":
                raise SchemaError(f"{c.column!r} is a {columns[at].semantic}")
            del columns[at]
        elif c.kind == "retype":
            column_type(c.type)
            columns[at] = dataclasses.replace(columns[at], type=c.type)
        elif c.kind == "default":
            columns[at] = dataclasses.replace(columns[at], default=c.default)
        else:
            raise SchemaError(f"unknown change {c.kind!r}")
    return TableSpec(name or spec.name, tuple(columns))


def routed(df: DataFrame, rules: list[tuple[str, Column]], rest: str = "rest") -> DataFrame:
    """``df`` with ``part``, the name of the first rule that holds, for ``partitionBy('part')``."""
    part = reduce(lambda otherwise, rule: F.when(rule[1], rule[0]).otherwise(otherwise), reversed(rules), F.lit(rest))
    return df.withColumn("part", part)
