"""Strict coercion of a column to a declared type, as Column expressions.

``coerced`` gives two columns: the value in the target's Spark type, null where
it is null or rejected, and the reason of a rejection, else null. Nothing is
cast before a predicate has let it through, so no expression fails under ANSI
rules. A column of a family that the target does not take is rejected in every
row that has a value. Instants count in UTC, whatever the session's zone, and
so do dates and times without a zone; only texts of times that name none are
read in the session's zone.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S

from .types import INT32, INT64, SAFE, ColumnType, column_type

INTEGRAL = (S.ByteType, S.ShortType, S.IntegerType, S.LongType)
FLOATING = (S.FloatType, S.DoubleType)
INSTANT = (S.TimestampType, S.TimestampNTZType, S.DateType)
NESTED = (S.StructType, S.ArrayType, S.MapType)


def _judged(x: Column, ok: Column, value: Column, reason: str) -> tuple[Column, Column]:
    fine = F.coalesce(ok, F.lit(False))
    return F.when(x.isNotNull() & fine, value), F.when(x.isNotNull() & ~fine, F.lit(reason))


def _refused(x: Column, target: ColumnType, source: S.DataType) -> tuple[Column, Column]:
    return F.lit(None).cast(target.spark), F.when(x.isNotNull(), F.lit(type_reason(source)))


def type_reason(source: S.DataType) -> str:
    return f"type:{source.simpleString().partition('(')[0].partition('<')[0]}"


#: Why a cell can be rejected, besides for its type.
REASONS = ("range", "invalid_date")


def integral(x: Column, source: S.DataType, low: int, high: int) -> Column | None:
    """Whether ``x`` is a whole number from ``low`` to ``high``; None for a family that holds no numbers.

    Doubles are compared as doubles, and beyond 2^53 none passes, since such a
    double need not be the number that was meant.
    """
    if isinstance(source, INTEGRAL):
        return x.cast("decimal(20,0)").between(F.expr(f"{low}BD"), F.expr(f"{high}BD"))
    if isinstance(source, S.DecimalType):
        return (x == F.floor(x)) & (x >= F.expr(f"{low}BD")) & (x <= F.expr(f"{high}BD"))
    if isinstance(source, FLOATING):
        return (x == F.floor(x)) & x.between(float(max(low, -SAFE)), float(min(high, SAFE)))
    return None


def epoch(x: Column, unit: int) -> Column:
    """Whole units since 1970 of a timestamp, toward zero; null where nanoseconds overflow."""
    return _units(F.unix_micros(x.cast("timestamp")), unit)


def _units(micros: Column, unit: int) -> Column:
    if unit > 10**6:
        return F.try_multiply(micros, F.lit(unit // 10**6))
    by = F.lit(10**6 // unit)
    size = F.abs(micros)
    return micros if unit == 10**6 else F.round((size - size % by) / by).cast("long") * F.signum(micros).cast("long")


DAY_US = 86_400_000_000


def micros(x: Column, source: S.DataType) -> Column:
    """Microseconds since 1970 of an instant; a date, or a time without a zone, stands for that of UTC, whatever the session's zone."""
    if isinstance(source, S.DateType):
        return F.unix_date(x).cast("long") * DAY_US
    if isinstance(source, S.TimestampNTZType):
        seconds = F.hour(x) * 3600 + F.minute(x) * 60
        return F.unix_date(x.cast("date")).cast("long") * DAY_US + seconds.cast("long") * 10**6 + (F.extract(F.lit("SECOND"), x) * 10**6).cast("long")
    return F.unix_micros(x)


def _whole_days(us: Column) -> Column:
    return F.call_function("div", us - F.pmod(us, F.lit(DAY_US)), F.lit(DAY_US))


def _number_text(x: Column, source: S.DataType) -> Column:
    """A double as JSON texts have it: shortest digits, plain from 0.000001 up to 10^21, ``null`` where it is no number."""
    text = x.cast("string")
    x, size = text.cast("double"), F.abs(text.cast("double"))
    trimmed = lambda scale: F.regexp_replace(text.cast(f"decimal(38,{scale})").cast("string"), r"\.?0+$", "")
    far = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E-", "e-"), r"E(\d)", "e+$1")
    plain = F.when(x == 0, "0").when(size < 1e-6, far).when(size < 1e-3, trimmed(24)).when((size < 1e7) & (x != F.floor(x)), text)
    plain = plain.when((size < 1e21) & (x == F.floor(x)), text.cast("decimal(38,0)").cast("string")).when(size < 1e21, trimmed(10)).otherwise(far)
    return F.when(F.isnan(x) | (size == float("inf")), F.lit("null")).otherwise(plain)


def json_text(x: Column, source: S.DataType) -> Column:
    """``x`` as JSON text, null members and elements kept; the text ``null`` where it is null.

    Numbers that are not finite are null at every depth, and instants are ISO
    text in UTC with milliseconds. Integers of 64 bits are written as numbers,
    and bytes in base 64: those two are ours.
    """
    quoted = lambda t: F.substring(F.to_json(F.array(t)), F.lit(2), F.length(F.to_json(F.array(t))) - 2)
    if isinstance(source, S.StructType):
        parts = [F.concat(F.lit(("," if k else "") + json.dumps(f.name, ensure_ascii=False) + ":"), json_text(x[f.name], f.dataType)) for k, f in enumerate(source)]
        text = F.concat(F.lit("{"), *parts, F.lit("}"))
    elif isinstance(source, S.ArrayType):
        text = F.concat(F.lit("["), F.array_join(F.transform(x, lambda e: json_text(e, source.elementType)), ","), F.lit("]"))
    elif isinstance(source, S.MapType):
        pair = lambda e: F.concat(quoted(e["key"].cast("string")), F.lit(":"), json_text(e["value"], source.valueType))
        text = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(x), pair), ","), F.lit("}"))
    elif isinstance(source, FLOATING):
        text = _number_text(x, source)
    elif isinstance(source, (*INTEGRAL, S.DecimalType, S.BooleanType)):
        text = x.cast("string")
    elif isinstance(source, INSTANT):
        us = micros(x, source)
        rest = F.call_function("div", F.pmod(us, F.lit(DAY_US)), F.lit(1000))
        part = lambda by, size, width: F.lpad(F.pmod(F.call_function("div", rest, F.lit(by)), F.lit(size)).cast("string"), width, "0")
        day = F.date_from_unix_date(_whole_days(us).cast("int")).cast("string")
        text = F.concat(F.lit('"'), day, F.lit("T"), part(3_600_000, 24, 2), F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit("."), part(1, 1000, 3), F.lit('Z"'))
    elif isinstance(source, S.BinaryType):
        text = F.concat(F.lit('"'), F.base64(x), F.lit('"'))
    elif isinstance(source, S.StringType):
        text = quoted(x)
    else:
        text = F.to_json(x) if isinstance(source, S.VariantType) else quoted(x.cast("string"))
    return F.coalesce(text, F.lit("null"))


def coerced(x: Column, source: S.DataType, target: str, profile: str = "row") -> tuple[Column, Column]:
    """(value, reason) of ``x``, a column of type ``source``, as ``target``; ``profile`` is ``row`` or ``bulk``, whose JSON is UTF-8 bytes and whose seconds and milliseconds of the day have 32 bits."""
    to = column_type(target)
    if isinstance(source, S.NullType):
        return F.lit(None).cast(to.spark), F.lit(None).cast("string")
    if to.family == "int":
        ok = integral(x, source, to.low, to.high)
        return _refused(x, to, source) if ok is None else _judged(x, ok, x.cast(to.spark), "range")
    if to.family == "float":
        return (x.cast(to.spark), F.lit(None).cast("string")) if isinstance(source, (*INTEGRAL, *FLOATING, S.DecimalType)) else _refused(x, to, source)
    if to.family in ("bool", "string"):
        return (x, F.lit(None).cast("string")) if isinstance(source, type(to.spark)) else _refused(x, to, source)
    if to.family == "binary":
        if isinstance(source, S.BinaryType):
            return x, F.lit(None).cast("string")
        return (F.encode(x, "UTF-8"), F.lit(None).cast("string")) if isinstance(source, S.StringType) else _refused(x, to, source)
    if to.family == "json":
        if not isinstance(source, (S.StringType, *NESTED, *INTEGRAL, *FLOATING, *INSTANT, S.BooleanType, S.DecimalType)):
            return _refused(x, to, source)
        text = x if isinstance(source, S.StringType) else F.when(x.isNotNull(), json_text(x, source))
        return (F.encode(text, "UTF-8") if profile == "bulk" else text), F.lit(None).cast("string")
    if to.family == "date":
        if isinstance(source, INSTANT):
            return F.date_from_unix_date(_whole_days(micros(x, source)).cast("int")), F.lit(None).cast("string")
        ok = integral(x, source, *INT32)
        return _refused(x, to, source) if ok is None else _judged(x, ok, F.date_from_unix_date(x.cast("int")), "range")
    if to.family == "time":
        narrow = profile == "bulk" and to.unit <= 10**3
        ok = integral(x, source, *(INT32 if narrow else INT64))
        return _refused(x, to, source) if ok is None else _judged(x, ok, x.cast("long"), "range")
    return _timestamp(x, source, to)


def _timestamp(x: Column, source: S.DataType, to: ColumnType) -> tuple[Column, Column]:
    if isinstance(source, S.StringType):
        moment = F.try_to_timestamp(x)
        value, reason = _timestamp(moment, S.TimestampType(), to)
        return value, F.when(x.isNotNull() & moment.isNull(), F.lit("invalid_date")).otherwise(reason)
    if isinstance(source, INSTANT):
        whole = _units(micros(x, source), to.unit)
    else:
        ok = integral(x, source, *INT64)
        if ok is None:
            return _refused(x, to, source)
        whole = F.when(ok, x.cast("long"))
    if to.unit > 10**6:
        return _judged(x, whole.isNotNull(), whole, "range")
    us = whole if to.unit == 10**6 else F.try_multiply(whole, F.lit(10**6 // to.unit))
    return _judged(x, us.isNotNull(), F.timestamp_micros(us), "range")


def wire(x: Column, target: str) -> Column:
    """A coerced value as the number that is sent for it: days, or units since 1970."""
    to = column_type(target)
    if to.family == "date":
        return F.unix_date(x)
    return epoch(x, to.unit) if to.family == "timestamp" and to.unit <= 10**6 else x
