"""Tables stored in named parts, each for the rows that its expression holds for, split and merged part by part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.types import SchemaError
from ..operators.conform import conformed
from ..operators.spec import TableSpec
from . import catalog
from .store import scratch_folder

#: The column that parts are folders of, and the options that hold their expressions.
PART, RULE = "part", "part."


def create(spark: SparkSession, name: str, spec: TableSpec, rules: dict[str, str]) -> None:
    """A Parquet table in parts; ``rules`` gives each part's expression."""
    if not rules or PART in spec.names:
        raise SchemaError(f"{name}: parts need expressions, and no column may be named {PART!r}")
    columns = ", ".join(f"{catalog.quoted(c.name)} {c.field().dataType.simpleString()}" for c in spec.columns)
    held = {f"column.{c.name}": f"{c.semantic}:{c.type}" for c in spec.columns} | {RULE + k: v for k, v in rules.items()}
    spark.sql(f"CREATE TABLE {catalog.quoted(name)} ({columns}, {PART} STRING) USING parquet PARTITIONED BY ({PART}) TBLPROPERTIES ({catalog._properties(held)})")


def rules_of(spark: SparkSession, name: str) -> dict[str, str]:
    return {k[len(RULE) :]: v for k, v in catalog.options_of(spark, name).items() if k.startswith(RULE)}


def _staged(rows: DataFrame, rules: dict[str, str], name: str) -> DataFrame:
    """``rows`` with the one part that holds each, in a scratch table; a row of none, or of several, is an error before any part changes."""
    fits = [F.coalesce(F.expr(rule), F.lit(False)) for rule in rules.values()]
    times = reduce(lambda a, b: a + b, [f.cast("int") for f in fits])
    part = reduce(lambda rest, x: F.when(x[1], x[0]).otherwise(rest), reversed(list(zip(rules, fits, strict=True))), F.lit(None).cast("string"))
    seen, at = Observation(), scratch_folder(rows.sparkSession, "parts")
    placed = rows.withColumn(PART, part).withColumn("__times", times)
    placed = placed.observe(seen, F.count_if(F.col("__times") == 0).alias("none"), F.count_if(F.col("__times") > 1).alias("several")).drop("__times")
    placed.write.parquet(at)
    if seen.get["none"] or seen.get["several"]:
        raise SchemaError(f"{name}: {seen.get['none']} rows are in no part, {seen.get['several']} in several")
    return rows.sparkSession.read.schema(placed.schema).parquet(at)


def insert(spark: SparkSession, name: str, spec: TableSpec, rows: DataFrame) -> None:
    """Append conformed ``rows``, each to the part that holds it."""
    _staged(conformed(rows, spec), rules_of(spark, name), name).write.insertInto(catalog.quoted(name))


def _replaced(rows: DataFrame, name: str) -> None:
    """Write ``rows`` in place of the files of the parts that they have, and of no others."""
    spark, mode = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, None)
    try:
        spark.conf.set(mode, "dynamic")
        rows.write.mode("overwrite").insertInto(catalog.quoted(name))
    finally:
        spark.conf.unset(mode) if before is None else spark.conf.set(mode, before)


def repartition(spark: SparkSession, name: str, old: list[str], into: dict[str, str]) -> None:
    """Put the rows of the parts ``old`` into the parts ``into``: one into several, several into one, or several into others.

    Only files of the parts named are read and written. Each of their rows
    must be in one part of ``into``, else nothing changes. The new rows stand
    in a scratch table first; then the parts that are written again replace
    their files, and the others go.
    """
    rules = rules_of(spark, name)
    if missing := [p for p in old if p not in rules]:
        raise SchemaError(f"{name}: no parts {missing}")
    if not old or not into or (clash := [p for p in into if p in rules and p not in old]):
        raise SchemaError(f"{name}: parts {clash} stay as they are" if old and into else f"{name}: both sides need a part")
    rows = spark.table(catalog.quoted(name)).where(F.col(PART).isin(old))
    staged = _staged(rows.drop(PART), into, name)
    filled = {r[0] for r in staged.select(PART).distinct().collect()}  # as many as ``into`` has
    _replaced(staged, name)
    for part in (p for p in old if p not in filled):
        spark.sql(f"ALTER TABLE {catalog.quoted(name)} DROP IF EXISTS PARTITION ({PART} = {catalog._text(part)})")
    catalog.set_options(spark, name, {RULE + p: None for p in old if p not in into} | {RULE + p: v for p, v in into.items()})
