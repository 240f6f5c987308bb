"""Conforming rows to a declared table: by name or place, strictly or with a quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType

from ..functions.coerce import REASONS, coerced, type_reason
from ..functions.types import SchemaError
from .spec import ColumnSpec, TableSpec

ERRORS = "array<struct<column:string,reason:string,raw:string>>"


def _sources(df: DataFrame, spec: TableSpec, by: str) -> list[tuple[ColumnSpec, str | None]]:
    if by == "position":
        if len(df.columns) != len(spec.columns):
            raise SchemaError(f"{spec.name}: {len(df.columns)} values for {len(spec.columns)} columns")
        return list(zip(spec.columns, df.columns, strict=True))
    known = {c.source or c.name for c in spec.columns}
    if unknown := [c for c in df.columns if c not in known]:
        raise SchemaError(f"{spec.name}: unknown columns {unknown}")
    return [(c, name if (name := c.source or c.name) in df.columns else None) for c in spec.columns]


def _pairs(df: DataFrame, spec: TableSpec, by: str, profile: str) -> list[tuple[ColumnSpec, Column, Column, Column | None]]:
    out = []
    for c, name in _sources(df, spec, by):
        if name is None:
            out.append((c, F.lit(None).cast(_kind(c, profile)), F.lit(None).cast("string"), None))
        else:
            x = F.col(f"`{name}`")
            out.append((c, *coerced(x, df.schema[name].dataType, c.type, profile), x))
    return out


def _kind(c: ColumnSpec, profile: str) -> DataType:
    return BinaryType() if profile == "bulk" and c.type == "Json" else c.field().dataType


def _filled(c: ColumnSpec, value: Column, profile: str) -> Column:
    value = value if c.default is None else F.coalesce(value, F.lit(c.default).cast(_kind(c, profile)))
    return value.alias(c.name, metadata=c.field().metadata)


def conformed(df: DataFrame, spec: TableSpec, by: str = "name", profile: str = "row", keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` in the columns of ``spec``; one bad cell fails the job that reads it, with its column and reason.

    ``by`` is ``name`` (unknown columns are an error, missing ones null) or
    ``position`` (as many columns as declared). Nulls pass for every type.
    Columns in ``keep`` are passed on as they are.
    """
    return df.select(*conformed_columns(df.drop(*keep), spec, by, profile), *keep)


def conformed_columns(df: DataFrame, spec: TableSpec, by: str = "name", profile: str = "row") -> list[Column]:
    """The columns of ``conformed``, in declared order, for a frame that has those of ``df``."""
    columns = []
    for c, value, error, _ in _pairs(df, spec, by, profile):
        stop = F.raise_error(F.concat(F.lit(f"{spec.name}.{c.name}: not a {c.type}: "), error)).cast(_kind(c, profile))
        columns.append(_filled(c, F.when(error.isNotNull(), stop).otherwise(value), profile))
    return columns


def errors(df: DataFrame, spec: TableSpec, by: str = "name", profile: str = "row") -> Column:
    """What is wrong with a row of ``df``: an array of (column, reason, raw)."""
    found = [F.when(error.isNotNull(), F.struct(F.lit(c.name).alias("column"), error.alias("reason"), x.cast("string").alias("raw"))) for c, _, error, x in _pairs(df, spec, by, profile) if x is not None]
    return F.array_compact(F.array(*found)).cast(ERRORS)


def judged(df: DataFrame, spec: TableSpec, by: str = "name", profile: str = "row") -> DataFrame:
    """As ``conformed``, but rejected cells are null and listed in ``_errors`` (column, reason, raw)."""
    columns = [_filled(c, value, profile) for c, value, _, _ in _pairs(df, spec, by, profile)]
    return df.select(*columns, errors(df, spec, by, profile).alias("_errors"))


def refusal(df: DataFrame, spec: TableSpec, by: str = "name", profile: str = "row") -> DataFrame:
    """One row: whether ``conformed`` would refuse ``df``, for how many rows, and the least column and reason; every declared column is judged."""
    each = df.select(errors(df, spec, by, profile).alias("e")).where(F.size("e") > 0)
    per = each.agg(F.count("*").alias("bad_rows"), F.min(F.array_min(F.transform("e", lambda x: F.struct(x["column"], x["reason"])))).alias("first"))
    return per.select(F.lit(spec.name).alias("table_name"), (F.col("bad_rows") > 0).alias("refused"), "bad_rows", F.col("first.column").alias("first_column"), F.col("first.reason").alias("first_reason"))


def accepted(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where(F.size("_errors") == 0).drop("_errors")


def quarantined(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where(F.size("_errors") > 0)


def rejection_report(judged_rows: DataFrame, table: str) -> DataFrame:
    """Rejected cells by column and reason, with the least raw value as a sample."""
    each = judged_rows.select(F.explode("_errors").alias("e")).select("e.*")
    return each.groupBy(F.lit(table).alias("table_name"), F.col("column").alias("column_name"), "reason").agg(F.count("*").alias("rejected"), F.min("raw").alias("sample"))


def rejections(df: DataFrame, spec: TableSpec, by: str = "name", profile: str = "row") -> DataFrame:
    """``rejection_report`` of rows that are not judged yet: counts and samples of each column and reason side by side, in one aggregation without a key."""
    kept, cells = [], []
    for (c, _, error, x), (_, name) in zip(_pairs(df, spec, by, profile), _sources(df, spec, by), strict=True):
        for reason in (*REASONS, type_reason(df.schema[name].dataType)) if name is not None else ():
            hit, at = F.coalesce(error == reason, F.lit(False)), len(kept)
            cells += [F.count_if(hit).alias(f"n{at}"), F.min(F.when(hit, x.cast("string"))).alias(f"s{at}")]
            kept.append((c.name, reason))
    each = F.array(*(F.struct(F.lit(spec.name).alias("table_name"), F.lit(name).alias("column_name"), F.lit(reason).alias("reason"), F.col(f"n{k}").alias("rejected"), F.col(f"s{k}").alias("sample")) for k, (name, reason) in enumerate(kept)))
    return df.agg(*cells).select(F.explode(each).alias("x")).select("x.*").where("rejected > 0")


def merged(*batches: DataFrame) -> DataFrame:
    """Union of batches whose columns have the same names, order and types; drift is an error."""
    first = batches[0]
    for other in batches[1:]:
        if [(f.name, f.dataType) for f in other.schema] != [(f.name, f.dataType) for f in first.schema]:
            raise SchemaError("batches differ in schema")
    out = first
    for other in batches[1:]:
        out = out.unionByName(other)
    return out
