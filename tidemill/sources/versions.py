"""Tables whose declaration changes while their files stay as they are.

Each change starts a version: a hidden catalog table that takes the rows
written from then on. The table that users see is a view over all versions,
in which each gives its columns as the newest declaration has them. The log
of versions, options and comments are the view's properties, so a change is a
change of the catalog alone.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import coerced
from ..functions.types import SchemaError, column_type
from ..operators.mutate import Change, evolved
from ..operators.spec import ColumnSpec, TableSpec
from . import catalog

#: Where the log is kept, in pieces that any catalog takes.
LOG, PIECE = "tidemill.log.", 3000
#: Families whose values a cast turns into another's, once they are known to fit.
CASTABLE = ("int", "float", "binary", "json")


class Version(NamedTuple):
    """A hidden table, and its columns by the number that each was given when it was added."""

    table: str
    columns: dict[int, ColumnSpec]


def _read_log(spark: SparkSession, name: str) -> list[Version]:
    held = catalog.options_of(spark, name)
    parts = sorted((int(k[len(LOG) :]), v) for k, v in held.items() if k.startswith(LOG))
    if not parts:
        raise SchemaError(f"{name} has no versions")
    return [Version(v["table"], {int(k): ColumnSpec(**c) for k, c in v["columns"].items()}) for v in json.loads("".join(p for _, p in parts))]


def _log_properties(log: list[Version]) -> dict[str, str]:
    text = json.dumps([{"table": v.table, "columns": {k: {"name": c.name, "type": c.type, "semantic": c.semantic, "source": c.source, "default": c.default} for k, c in v.columns.items()}} for v in log])
    return {f"{LOG}{k}": text[at : at + PIECE] for k, at in enumerate(range(0, len(text), PIECE))}


def _selected(version: Version, log: list[Version]) -> str:
    """The columns of the newest declaration, from the files of ``version``: its own, or what they were to hold when they were added."""
    out = []
    for number, c in log[-1].columns.items():
        kind = c.field().dataType.simpleString()
        own = version.columns.get(number)
        if own is None:
            born = next(v.columns[number] for v in log if number in v.columns)
            out.append(f"CAST({catalog._literal(born.default)} AS {kind}) AS {catalog.quoted(c.name)}")
        else:
            same = own.field().dataType == c.field().dataType
            value = catalog.quoted(own.name) if same else f"CAST({catalog.quoted(own.name)} AS {kind})"
            out.append(f"{value} AS {catalog.quoted(c.name)}")
    return f"SELECT {', '.join(out)} FROM {catalog.quoted(version.table)}"


def _publish(spark: SparkSession, name: str, log: list[Version], options: dict[str, str], comment: str | None, comments: dict[str, str], replace: bool) -> None:
    noted = lambda c: f" COMMENT {catalog._text(comments[c])}" if comments.get(c) else ""
    columns = ", ".join(catalog.quoted(c.name) + noted(c.name) for c in log[-1].columns.values())
    held = options | {f"column.{c.name}": f"{c.semantic}:{c.type}" for c in log[-1].columns.values()} | _log_properties(log)
    note = f" COMMENT {catalog._text(comment)}" if comment else ""
    rows = " UNION ALL ".join(_selected(v, log) for v in log)
    spark.sql(f"CREATE {'OR REPLACE ' if replace else ''}VIEW {catalog.quoted(name)} ({columns}){note} TBLPROPERTIES ({catalog._properties(held)}) AS {rows}")


def options_of(spark: SparkSession, name: str) -> dict[str, str]:
    """The user's own options."""
    return {k: v for k, v in catalog.options_of(spark, name).items() if not k.startswith((LOG, "column.", "view."))}


def _comments(spark: SparkSession, name: str) -> tuple[str | None, dict[str, str]]:
    return spark.catalog.getTable(name).description, {c.name: c.description for c in spark.catalog.listColumns(name) if c.description}


def declared(spark: SparkSession, name: str) -> TableSpec:
    """The newest declaration."""
    return TableSpec(name.rpartition(".")[2], tuple(_read_log(spark, name)[-1].columns.values()))


def versions(spark: SparkSession, name: str) -> list[tuple[str, TableSpec]]:
    """The hidden table and the declaration of each version, oldest first."""
    return [(v.table, TableSpec(name.rpartition(".")[2], tuple(v.columns.values()))) for v in _read_log(spark, name)]


def _hidden(spark: SparkSession, name: str, columns: dict[int, ColumnSpec]) -> Version:
    table = f"{name}__{uuid.uuid4().hex[:12]}"
    catalog.create_table(spark, table, TableSpec(table.rpartition(".")[2], tuple(columns.values())), if_not_exists=False)
    return Version(table, columns)


def create(spark: SparkSession, name: str, spec: TableSpec, options: dict[str, str] | None = None, comment: str | None = None, comments: dict[str, str] | None = None) -> None:
    """A table at its first version; one of that name must not exist."""
    if spark.catalog.tableExists(name):
        raise SchemaError(f"{name} exists")
    if unknown := set(comments or {}) - set(spec.names):
        raise SchemaError(f"{name}: comments on unknown columns {sorted(unknown)}")
    _publish(spark, name, [_hidden(spark, name, dict(enumerate(spec.columns)))], options or {}, comment, comments or {}, False)


def insert(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Append ``rows``, conformed to the newest declaration; columns that they lack, and nulls, get its defaults."""
    catalog.insert(spark, _read_log(spark, name)[-1].table, declared(spark, name), rows)


def alter(spark: SparkSession, name: str, changes: list[Change], rename: str | None = None) -> TableSpec:
    """Change the declaration, and the name if given; no file is read but to see that retyped values fit, and none is written.

    Rows from before hold, in a column added since, the default that it was
    added with; a default changed later is that of later rows, and nulls from
    before stay null. A column dropped and added again is a new one. Values
    that a new type does not take stop the change. Types other than numbers,
    bytes and JSON cannot become one another here; ``catalog.evolve_table``
    writes such a table anew.
    """
    log, old = _read_log(spark, name), declared(spark, name)
    new = evolved(old, changes, rename and rename.rpartition(".")[2])
    numbers = {c.name: k for k, c in log[-1].columns.items()}
    free = 1 + max(k for v in log for k in v.columns)
    for c in changes:
        if c.kind in ("add", "drop"):
            numbers.pop(c.column, None)
        if c.kind == "add":
            numbers[c.spec.name], free = free, free + 1
    columns = {numbers[c.name]: c for c in new.columns}
    _must_fit(spark, name, [(log[-1].columns[k], c) for k, c in columns.items() if k in log[-1].columns and log[-1].columns[k].type != c.type])
    options, (comment, comments) = options_of(spark, name), _comments(spark, name)
    kept = {c.name for k, c in columns.items() if k in log[-1].columns}
    if changes:
        log = [*log, _hidden(spark, name, columns)]
        _publish(spark, name, log, options, comment, {k: v for k, v in comments.items() if k in kept}, True)
    if rename:
        spark.sql(f"ALTER VIEW {catalog.quoted(name)} RENAME TO {catalog.quoted(rename)}")
    return new


def _must_fit(spark: SparkSession, name: str, retyped: list[tuple[ColumnSpec, ColumnSpec]]) -> None:
    rows, reasons = spark.table(catalog.quoted(name)), []
    for before, after in retyped:
        if column_type(after.type).family not in CASTABLE and column_type(after.type).spark != column_type(before.type).spark:
            raise SchemaError(f"{name}.{after.name}: {before.type} cannot become {after.type} without a rewrite")
        _, reason = coerced(F.col(catalog.quoted(before.name)), before.field().dataType, after.type)
        reasons.append(F.min(F.concat(F.lit(f"{after.name}: not a {after.type}: "), reason)))
    if reasons:
        wrong = [x for x in rows.agg(*[r.alias(f"r{k}") for k, r in enumerate(reasons)]).first() if x]
        if wrong:
            raise SchemaError(f"{name}.{wrong[0]}")


def set_options(spark: SparkSession, name: str, options: dict[str, str | None]) -> None:
    """Set options of the table; None unsets one."""
    log, held, (comment, comments) = _read_log(spark, name), options_of(spark, name), _comments(spark, name)
    _publish(spark, name, log, {k: v for k, v in (held | options).items() if v is not None}, comment, comments, True)


def comment_on(spark: SparkSession, name: str, comment: str | None, column: str | None = None) -> None:
    """Set the comment of the table or of a column; None takes it away."""
    log, held, (whole, comments) = _read_log(spark, name), options_of(spark, name), _comments(spark, name)
    if column is not None and column not in {c.name for c in log[-1].columns.values()}:
        raise SchemaError(f"{name}: no column {column!r}")
    _publish(spark, name, log, held, comment if column is None else whole, comments if column is None else comments | {column: comment or ""}, True)


def drop(spark: SparkSession, name: str) -> None:
    """Drop the table and all its versions."""
    hidden = [v.table for v in _read_log(spark, name)]
    catalog.drop(spark, "view", name)
    for table in hidden:
        catalog.drop(spark, "table", table)
