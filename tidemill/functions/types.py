"""The declared column types and what Spark stores for each."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as S


class SchemaError(ValueError):
    """A table, column or type declaration that cannot hold."""


class ColumnType(NamedTuple):
    """``family`` picks the coercion; ``low`` and ``high`` bound integers; ``unit`` is a time unit's share of a second."""

    name: str
    spark: S.DataType
    family: str
    low: int | None = None
    high: int | None = None
    unit: int | None = None


def _int(name: str, spark: S.DataType, bits: int, signed: bool) -> ColumnType:
    low = -(1 << (bits - 1)) if signed else 0
    return ColumnType(name, spark, "int", low, low + (1 << bits) - 1)


_LONG = S.LongType()
TYPES: dict[str, ColumnType] = {
    t.name: t
    for t in (
        _int("Int8", S.ByteType(), 8, True),
        _int("Int16", S.ShortType(), 16, True),
        _int("Int32", S.IntegerType(), 32, True),
        _int("Int64", _LONG, 64, True),
        _int("Uint8", S.ShortType(), 8, False),
        _int("Uint16", S.IntegerType(), 16, False),
        _int("Uint32", _LONG, 32, False),
        _int("Uint64", S.DecimalType(20, 0), 64, False),
        ColumnType("Float32", S.FloatType(), "float"),
        ColumnType("Float64", S.DoubleType(), "float"),
        ColumnType("Bool", S.BooleanType(), "bool"),
        ColumnType("String", S.StringType(), "string"),
        ColumnType("Binary", S.BinaryType(), "binary"),
        ColumnType("Json", S.StringType(), "json"),
        ColumnType("Date", S.DateType(), "date"),
        ColumnType("Datetime", S.TimestampType(), "timestamp", unit=10**6),
        ColumnType("TimestampSecond", S.TimestampType(), "timestamp", unit=1),
        ColumnType("TimestampMillisecond", S.TimestampType(), "timestamp", unit=10**3),
        ColumnType("TimestampMicrosecond", S.TimestampType(), "timestamp", unit=10**6),
        ColumnType("TimestampNanosecond", _LONG, "timestamp", unit=10**9),
        ColumnType("TimeSecond", _LONG, "time", unit=1),
        ColumnType("TimeMillisecond", _LONG, "time", unit=10**3),
        ColumnType("TimeMicrosecond", _LONG, "time", unit=10**6),
        ColumnType("TimeNanosecond", _LONG, "time", unit=10**9),
    )
}
#: Time precision to timestamp type.
PRECISIONS = {"second": "TimestampSecond", "millisecond": "TimestampMillisecond", "microsecond": "TimestampMicrosecond", "nanosecond": "TimestampNanosecond"}
#: Integers that doubles hold exactly.
SAFE = 2**53 - 1
INT64 = (-(2**63), 2**63 - 1)
INT32 = (-(2**31), 2**31 - 1)


def column_type(name: str) -> ColumnType:
    try:
        return TYPES[name]
    except KeyError:
        raise SchemaError(f"unknown type {name!r}") from None
