"""Declared tables, views and databases in Spark's catalog: created, described, changed and dropped by SQL."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import SchemaError
from ..operators.conform import conformed
from ..operators.mutate import Change, evolved
from ..operators.spec import TableSpec


def quoted(name: str) -> str:
    """``a.b`` as two quoted parts."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(value: object) -> str:
    if value is None or isinstance(value, bool):
        return {None: "NULL", True: "true", False: "false"}[value]
    return repr(value) if isinstance(value, int | float) else _text(value)


def _properties(values: dict[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())


def create_database(spark: SparkSession, name: str, if_not_exists: bool = True, location: str | None = None, options: dict[str, str] | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    more = f" WITH DBPROPERTIES ({_properties(options)})" if options else ""
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if if_not_exists else ''}{quoted(name)}{where}{more}")


def create_table(spark: SparkSession, name: str, spec: TableSpec, if_not_exists: bool = True, options: dict[str, str] | None = None, comment: str | None = None, comments: dict[str, str] | None = None, location: str | None = None) -> None:
    """``spec`` as a Parquet table: its defaults are column defaults, and semantics and types are table properties."""
    if unknown := set(comments or {}) - set(spec.names):
        raise SchemaError(f"{name}: comments on unknown columns {sorted(unknown)}")
    columns = []
    for c in spec.columns:
        default = f" DEFAULT {_literal(c.default)}" if c.default is not None else ""
        note = f" COMMENT {_text(comments[c.name])}" if comments and c.name in comments else ""
        columns.append(f"{quoted(c.name)} {c.field().dataType.simpleString()}{default}{note}")
    held = {f"column.{c.name}": f"{c.semantic}:{c.type}" for c in spec.columns} | (options or {})
    where = f" LOCATION {_text(location)}" if location else ""
    note = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{quoted(name)} ({', '.join(columns)}) USING parquet{where}{note} TBLPROPERTIES ({_properties(held)})")


def insert(spark: SparkSession, name: str, spec: TableSpec, rows: DataFrame) -> None:
    """Append ``rows``, conformed; columns that they lack get the declared default."""
    conformed(rows, spec).write.insertInto(quoted(name))


def options_of(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def described(spark: SparkSession, name: str) -> DataFrame:
    """``column_name, spark_type, semantic, type, comment`` per column, in order."""
    held = options_of(spark, name)
    rows = []
    for place, c in enumerate(spark.catalog.listColumns(name)):
        semantic, _, kind = held.get(f"column.{c.name}", "field:").partition(":")
        rows.append((place, c.name, c.dataType, semantic, kind or None, c.description))
    return spark.createDataFrame(rows, "place int, column_name string, spark_type string, semantic string, type string, comment string").orderBy("place").drop("place")


def comment_on(spark: SparkSession, name: str, comment: str | None, column: str | None = None) -> None:
    """Set a table's or a column's comment; None takes it away."""
    if column is None:
        spark.sql(f"COMMENT ON TABLE {quoted(name)} IS {_literal(comment)}")
    else:
        spark.sql(f"ALTER TABLE {quoted(name)} ALTER COLUMN {quoted(column)} COMMENT {_text(comment or '')}")


def set_options(spark: SparkSession, name: str, options: dict[str, str | None]) -> None:
    """Set table options; None unsets one."""
    if put := {k: v for k, v in options.items() if v is not None}:
        spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ({_properties(put)})")
    if gone := [k for k, v in options.items() if v is None]:
        spark.sql(f"ALTER TABLE {quoted(name)} UNSET TBLPROPERTIES IF EXISTS ({', '.join(map(_text, gone))})")


def create_view(spark: SparkSession, name: str, sql: str, replace: bool = False, if_not_exists: bool = False) -> None:
    """A view that the catalog keeps, over catalog tables."""
    spark.sql(f"CREATE {'OR REPLACE ' if replace else ''}VIEW {'IF NOT EXISTS ' if if_not_exists else ''}{quoted(name)} AS {sql}")


def drop(spark: SparkSession, kind: str, name: str, if_exists: bool = False, cascade: bool = False) -> None:
    """Drop a ``table``, ``view`` or ``database``."""
    if kind not in ("table", "view", "database"):
        raise ValueError(f"cannot drop a {kind!r}")
    spark.sql(f"DROP {kind.upper()} {'IF EXISTS ' if if_exists else ''}{quoted(name)}{' CASCADE' if cascade and kind == 'database' else ''}")


#: Options that the catalog keeps for itself.
OWN_OPTIONS = ("transient_lastDdlTime", "numFiles", "totalSize", "numRows", "rawDataSize", "EXTERNAL", "serialization.format")


def _carried(spark: SparkSession, name: str) -> tuple[dict[str, str], str | None, dict[str, str]]:
    """(options, comment, column comments) that users gave a table."""
    options = {k: v for k, v in options_of(spark, name).items() if not k.startswith("column.") and k not in OWN_OPTIONS}
    return options, spark.catalog.getTable(name).description, {c.name: c.description for c in spark.catalog.listColumns(name) if c.description}


def evolve_table(spark: SparkSession, name: str, spec: TableSpec, changes: list[Change], location: str | None = None, rename: str | None = None) -> TableSpec:
    """Change a stored table; the new declaration. Options, comments and defaults stay as they were but for what ``changes`` says.

    Columns without a default that are added at the end, and changed defaults,
    are changes of the catalog alone; a changed default is that of later rows.
    Any other change, which Parquet tables cannot take, writes the table anew
    from its rows, conformed to the new types, and puts it in the old one's
    place once it stands; rows from before get the default of an added column
    there, and keep their nulls elsewhere. Values that a new type does not
    take stop the change, and the table stays as it was. ``versions`` has
    tables that change without being written anew.
    """
    new = evolved(spec, changes, rename and rename.rpartition(".")[2])
    in_place = all(c.kind == "default" or c.kind == "add" and not c.first and c.after is None and c.spec.default is None for c in changes)
    if in_place and {x.name for x in spec.columns} >= {c.column for c in changes if c.kind == "default"}:
        for c in changes:
            if c.kind == "add":
                spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({quoted(c.spec.name)} {c.spec.field().dataType.simpleString()})")
            else:
                spark.sql(f"ALTER TABLE {quoted(name)} ALTER COLUMN {quoted(c.column)} {'DROP DEFAULT' if c.default is None else f'SET DEFAULT {_literal(c.default)}'}")
        if added := {f"column.{c.spec.name}": f"{c.spec.semantic}:{c.spec.type}" for c in changes if c.kind == "add"}:
            set_options(spark, name, added)
        if rename:
            spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(rename)}")
        return new
    fresh, old = f"{name}__new", f"{name}__old"
    options, comment, comments = _carried(spark, name)
    create_table(spark, fresh, new, if_not_exists=False, options=options, comment=comment, comments={k: v for k, v in comments.items() if k in new.names}, location=location)
    try:
        rows = spark.table(quoted(name))
        added = {c.spec.name for c in changes if c.kind == "add"}
        plain = TableSpec(new.name, tuple(dataclasses.replace(c, source=None, default=c.default if c.name in added else None) for c in new.columns))
        insert(spark, fresh, plain, rows.select(*(c for c in rows.columns if c in new.names and c not in added)))
    except Exception:
        drop(spark, "table", fresh)
        raise
    spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(old)}")
    spark.sql(f"ALTER TABLE {quoted(fresh)} RENAME TO {quoted(rename or name)}")
    drop(spark, "table", old)
    return new


def total_rows(spark: SparkSession, name: str) -> int:
    return spark.table(quoted(name)).agg(F.count("*")).first()[0]
