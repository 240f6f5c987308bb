"""Table declarations: tags name a series, fields carry values, one timestamp orders it."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable

from pyspark.sql import types as S

from ..functions.types import PRECISIONS, SchemaError, column_type

SEMANTICS = ("tag", "field", "timestamp")


@dataclasses.dataclass(frozen=True)
class ColumnSpec:
    """One declared column; ``source`` is the input's name for it where that differs, ``default`` fills nulls."""

    name: str
    type: str
    semantic: str = "field"
    source: str | None = None
    default: object = None

    def field(self) -> S.StructField:
        return S.StructField(self.name, column_type(self.type).spark, True, {"semantic": self.semantic, "type": self.type})


@dataclasses.dataclass(frozen=True)
class TableSpec:
    """A table's name and ordered columns, checked when made."""

    name: str
    columns: tuple[ColumnSpec, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "columns", tuple(self.columns))
        if not self.name:
            raise SchemaError("a table needs a name")
        if not self.columns:
            raise SchemaError(f"{self.name}: a table needs a column")
        seen: set[str] = set()
        for c in self.columns:
            if not c.name:
                raise SchemaError(f"{self.name}: a column needs a name")
            if c.name.lower() in seen:
                raise SchemaError(f"{self.name}: column {c.name!r} is declared twice, or differs by case only")
            seen.add(c.name.lower())
            if c.semantic not in SEMANTICS:
                raise SchemaError(f"{self.name}.{c.name}: unknown semantic {c.semantic!r}")
            if c.semantic == "timestamp" and column_type(c.type).family != "timestamp":
                raise SchemaError(f"{self.name}.{c.name}: {c.type} cannot be the timestamp")
            column_type(c.type)
        if sum(c.semantic == "timestamp" for c in self.columns) != 1:
            raise SchemaError(f"{self.name}: exactly one timestamp column is needed")

    @property
    def tags(self) -> list[str]:
        return [c.name for c in self.columns if c.semantic == "tag"]

    @property
    def time(self) -> str:
        return next(c.name for c in self.columns if c.semantic == "timestamp")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> S.StructType:
        return S.StructType([c.field() for c in self.columns])


def tag(name: str, type: str = "String", source: str | None = None) -> ColumnSpec:
    return ColumnSpec(name, type, "tag", source)


def field(name: str, type: str, source: str | None = None, default: object = None) -> ColumnSpec:
    return ColumnSpec(name, type, "field", source, default)


def timestamp(name: str, precision: str = "millisecond", source: str | None = None) -> ColumnSpec:
    if precision not in PRECISIONS:
        raise SchemaError(f"unknown precision {precision!r}")
    return ColumnSpec(name, PRECISIONS[precision], "timestamp", source)


def mapped(kind: type) -> TableSpec:
    """A dataclass as a table: fields that carry a ColumnSpec in ``metadata['column']``, under ``__table__`` or the class name in lower case."""
    fields: Iterable[dataclasses.Field] = dataclasses.fields(kind) if dataclasses.is_dataclass(kind) else ()
    columns = [dataclasses.replace(f.metadata["column"], name=f.metadata["column"].name or f.name, source=f.name) for f in fields if "column" in f.metadata]
    if not columns:
        raise SchemaError(f"{kind.__name__} declares no column")
    return TableSpec(getattr(kind, "__table__", kind.__name__.lower()), tuple(columns))
