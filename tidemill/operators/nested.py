"""Sparse columns, nested values, attributes and text terms."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from ..functions.coerce import INTEGRAL, coerced
from ..functions.types import SchemaError


def dense(values: str, mask: str, size: str) -> Column:
    """The ``size`` rows of a sparse column: ``values`` holds the non-null ones in order, ``mask`` has a bit per row that is null, lowest bit of the first byte first."""
    bit = f"getbit(cast(conv(hex(substring({mask}, cast(floor(i / 8) as int) + 1, 1)), 16, 10) as int), cast(i % 8 as int))"
    every = f"sequence(0, cast({size} as int) - 1)"
    held = f"zip_with(filter({every}, i -> {bit} = 0), {values}, (i, v) -> struct(i as i, v as v))"
    gaps = f"transform(filter({every}, i -> {bit} = 1), i -> struct(i as i, element_at({values}, cast(null as int)) as v))"
    return F.expr(f"if({size} = 0, slice({values}, 1, 0), transform(array_sort(concat({held}, {gaps})), x -> x.v))")


def decimal_text(high: Column, low: Column, scale: int) -> Column:
    """All 39 digits of (high 2^64 + unsigned low) / 10^scale as text, the point before the last ``scale``: exact for each number of 128 bits, also those beyond Spark's 38 digits."""
    low, step, limb = low.cast("decimal(20,0)"), F.expr("18446744073709551616BD"), 10**9
    unsigned = F.when(low < 0, low + step).otherwise(low)
    rest = F.pmod(high, F.lit(limb))
    # Division truncates, so a high near the least long has no room for taking the rest away first.
    whole = F.call_function("div", high, F.lit(limb))
    upper = (whole - F.when(high < whole * limb, 1).otherwise(0)).cast("decimal(11,0)")
    # Spark rounds products to 34 digits, so the last nine are kept apart: upper 2^64 + first is the rest of the number.
    lower = F.lpad((rest.cast("decimal(9,0)") * step + unsigned).cast("decimal(30,0)").cast("string"), 39, "0")
    first, last = F.substr(lower, F.lit(1), F.lit(30)).cast("decimal(30,0)"), F.substr(lower, F.lit(31)).cast("long")
    most = (upper * step + first).cast("decimal(31,0)")
    borrow = (most < 0) & (last > 0)
    digits = F.concat(F.lpad(F.abs(most + borrow.cast("int")).cast("decimal(31,0)").cast("string"), 30, "0"), F.lpad(F.when(borrow, limb - last).otherwise(last).cast("string"), 9, "0"))
    sign = F.when(most < 0, "-").otherwise("")
    return F.concat(sign, F.substr(digits, F.lit(1), F.lit(39 - scale)), F.lit("."), F.substr(digits, F.lit(40 - scale), F.lit(scale))) if scale else F.concat(sign, digits)


def decimal_of(high: Column, low: Column, scale: int, precision: int = 38) -> tuple[Column, Column]:
    """((high 2^64 + unsigned low) / 10^scale as an exact decimal, reason): refused as ``range`` beyond ``precision`` digits."""
    value = decimal_text(high, low, scale).try_cast(f"decimal({precision},{scale})")
    return value, F.when(high.isNotNull() & low.isNotNull() & value.isNull(), F.lit("range"))


@dataclasses.dataclass(frozen=True)
class ListOf:
    item: object


@dataclasses.dataclass(frozen=True)
class StructOf:
    fields: dict[str, object]


@dataclasses.dataclass(frozen=True)
class Decimal:
    precision: int
    scale: int


@dataclasses.dataclass(frozen=True)
class Vector:
    size: int


@dataclasses.dataclass(frozen=True)
class Interval:
    """``unit`` is ``months``, ``micros`` or ``mixed`` (a struct of months, days and nanoseconds)."""

    unit: str


@dataclasses.dataclass(frozen=True)
class JsonNative:
    pass


def _bound(value: Column, use) -> Column:
    """``use`` of ``value``, which stands in the plan once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pair(value: Column, reason: Column) -> Column:
    return F.struct(value.alias("v"), reason.alias("r"))


def coerced_nested(x: Column, source: S.DataType, target: object) -> tuple[Column, Column]:
    """(value, reason) of ``x`` as a nested ``target``: one of the above, or the name of a declared type at the leaves.

    Lists and structs are refused as a whole for the first cell in them that
    does not fit, named by its place; a member that the source lacks is null,
    one that the target lacks is refused. Values go up with their reasons, so
    a plan grows with the number of members, not with the depth.
    """
    if isinstance(target, ListOf | StructOf) or isinstance(target, Interval) and target.unit == "mixed":
        both = _judged(x, source, target)
        return both["v"], both["r"]
    return _leaf(x, source, target)


def _judged(x: Column, source: S.DataType, target: object) -> Column:
    """A struct of the value ``v`` and the reason ``r`` of ``x``."""
    if isinstance(target, Interval) and target.unit == "mixed":
        target = StructOf({"months": "Int32", "days": "Int32", "nanoseconds": "Int64"})
    if isinstance(target, ListOf):
        if not isinstance(source, S.ArrayType):
            return _pair(*_refused(x, "type:list"))
        each = F.transform(x, lambda e: _judged(e, source.elementType, target.item))

        def whole(items: Column) -> Column:
            wrong = F.filter(F.transform(items, lambda e, i: F.when(e["r"].isNotNull(), F.concat(F.lit("["), i.cast("string"), F.lit("]:"), e["r"]))), lambda r: r.isNotNull())
            values = F.transform(items, lambda e: e["v"])
            return _pair(F.when(F.size(wrong) == 0, values), F.try_element_at(wrong, F.lit(1)))

        return _bound(each, whole)
    if isinstance(target, StructOf):
        if not isinstance(source, S.StructType) or set(source.names) - set(target.fields):
            return _pair(*_refused(x, "type:struct"))
        members = F.struct(*[(_judged(x[n], source[n].dataType, t) if n in source.names else _pair(F.lit(None), F.lit(None).cast("string"))).alias(n) for n, t in target.fields.items()])

        def whole(m: Column) -> Column:
            reason = F.coalesce(*[F.when(m[n]["r"].isNotNull(), F.concat(F.lit(f".{n}:"), m[n]["r"])) for n in target.fields])
            return _pair(F.when(reason.isNull(), F.struct(*[m[n]["v"].alias(n) for n in target.fields])), reason)

        return _bound(F.when(x.isNotNull(), members), lambda m: F.when(m.isNotNull(), whole(m)))
    return _pair(*_leaf(x, source, target))


def _refused(x: Column, why: str) -> tuple[Column, Column]:
    return F.lit(None), F.when(x.isNotNull(), F.lit(why))


def _leaf(x: Column, source: S.DataType, target: object) -> tuple[Column, Column]:
    if isinstance(target, str):
        return coerced(x, source, target)
    if isinstance(target, Decimal):
        if not isinstance(source, (S.DecimalType, *INTEGRAL)):
            return _refused(x, "type:decimal")
        value = x.cast("string").try_cast(f"decimal({target.precision},{target.scale})")
        fine = value.isNotNull() & (value == x)
        return F.when(fine, value), F.when(x.isNotNull() & ~F.coalesce(fine, F.lit(False)), F.lit("range"))
    if isinstance(target, Vector):
        return vector_of(x, target.size) if isinstance(source, S.ArrayType) else _refused(x, "type:vector")
    if isinstance(target, Interval):
        return _interval(x, source, target.unit)
    value = F.try_parse_json(x) if isinstance(source, S.StringType) else F.to_variant_object(x)
    return value, F.when(x.isNotNull() & value.isNull(), F.lit("json"))


def _interval(x: Column, source: S.DataType, unit: str) -> tuple[Column, Column]:
    if isinstance(source, S.YearMonthIntervalType if unit == "months" else S.DayTimeIntervalType):
        return x, F.lit(None).cast("string")
    whole, reason = coerced(x, source, "Int32" if unit == "months" else "Int64")
    made = F.make_ym_interval(F.lit(0), whole) if unit == "months" else whole * F.expr("interval '0.000001' second")
    return made, reason


def vector_of(values: Column, size: int) -> tuple[Column, Column]:
    """(array of floats, reason): a vector is accepted if it has ``size`` numbers and none is null."""
    fine = F.coalesce((F.size(values) == size) & ~F.exists(values, lambda x: x.isNull()), F.lit(False))
    return F.when(fine, values.cast("array<float>")), F.when(values.isNotNull() & ~fine, F.lit("dimension"))


#: What stands between words, and a character that is a word of its own.
BETWEEN, HAN = r"[^\p{L}\p{M}\p{N}_]+", r"(\p{IsHan})"


def terms(text: Column, fold: bool = True, analyzer: str = "english") -> Column:
    """The words of a text: runs of letters, marks, digits and underscores of any script, lower-cased if ``fold``; the ``chinese`` analyzer takes each Han character as a word."""
    if analyzer not in ("english", "chinese"):
        raise ValueError(f"unknown analyzer {analyzer!r}")
    text = F.regexp_replace(text, HAN, " $1 ") if analyzer == "chinese" else text
    return F.split(F.lower(text) if fold else text, BETWEEN)


def has_terms(text: Column, wanted: list[str], fold: bool = True, analyzer: str = "english") -> Column:
    """Whether a text has all ``wanted`` terms as whole words; a term of several words, or Han characters, has to stand in one piece."""
    joined = lambda x: F.concat(F.lit(" "), F.trim(F.array_join(terms(x, fold, analyzer), " ")), F.lit(" "))
    here = joined(text)
    return F.coalesce(reduce(lambda a, b: a & b, [F.contains(here, joined(F.lit(w))) for w in wanted], F.lit(True)), F.lit(False))


def promoted(df: DataFrame, attributes: str, keys: dict[str, str], prefix: str = "") -> DataFrame:
    """``df`` with a typed column for each of ``keys`` of a JSON ``attributes`` column; values that do not fit are null.

    A key is one name, whatever dots, spaces or quotes it holds (not both kinds of quotes).
    """
    v = F.try_parse_json(F.col(attributes))

    def path(key: str) -> str:
        if "'" in key and '"' in key:
            raise SchemaError(f"{key!r} has both kinds of quotes")
        return f'$["{key}"]' if "'" in key else f"$['{key}']"

    return df.withColumns({prefix + k: F.try_variant_get(v, path(k), kind) for k, kind in keys.items()})


def attribute_keys(df: DataFrame, attributes: str) -> DataFrame:
    """The distinct top-level keys of a JSON column."""
    return df.select(F.explode(F.json_object_keys(attributes)).alias("key")).distinct()
