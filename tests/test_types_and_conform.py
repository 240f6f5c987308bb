import dataclasses
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.functions.coerce import coerced, wire
from tidemill.functions.types import TYPES, SchemaError
from tidemill.operators import conform
from tidemill.operators.spec import ColumnSpec, TableSpec, field, mapped, tag, timestamp


def results(spark, kind, values, target, profile="row"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    value, reason = coerced(F.col("x"), df.schema["x"].dataType, target, profile)
    return [tuple(r) for r in df.select(value, reason).collect()]


def test_there_are_24_types():
    assert len(TYPES) == 24


@pytest.mark.parametrize("name", [n for n, t in TYPES.items() if t.family == "int"])
def test_integer_bounds(spark, name):
    t = TYPES[name]
    got = results(spark, "decimal(38,0)", [None if v is None else Decimal(v) for v in (t.low, t.high, 0, t.low - 1, t.high + 1, None)], name)
    assert got == [(t.low, None), (t.high, None), (0, None), (None, "range"), (None, "range"), (None, None)]


def test_doubles_as_integers(spark):
    nan, inf = float("nan"), float("inf")
    assert results(spark, "double", [1.0, 1.5, nan, inf, -inf, 300.0, -0.0, None], "Int8") == [(1, None), *[(None, "range")] * 5, (0, None), (None, None)]
    assert results(spark, "double", [2.0**53 - 1, 2.0**53, -(2.0**53), 1e300], "Int64") == [(2**53 - 1, None), *[(None, "range")] * 3]
    assert results(spark, "long", [2**63 - 1, -(2**63)], "Int64") == [(2**63 - 1, None), (-(2**63), None)]
    assert results(spark, "long", [-1, 5], "Uint64") == [(None, "range"), (Decimal(5), None)]


@pytest.mark.parametrize(("kind", "value", "target"), [("string", "1", "Int8"), ("boolean", True, "Int8"), ("string", "1", "Float64"), ("long", 1, "Bool"), ("long", 1, "String"), ("long", 1, "Binary"), ("boolean", True, "TimestampSecond"), ("string", "1", "TimeSecond"), ("boolean", True, "Date")])
def test_other_families_are_refused(spark, kind, value, target):
    (good, reason), (none, no_reason) = results(spark, kind, [value, None], target)
    assert good is None and reason.startswith("type:") and none is None and no_reason is None


def test_text_binary_json(spark):
    assert results(spark, "string", ["ab", None], "Binary") == [(b"ab", None), (None, None)]
    assert results(spark, "string", ["not json"], "Json") == [("not json", None)]
    assert results(spark, "struct<a:int,b:string>", [(1, None)], "Json") == [('{"a":1,"b":null}', None)]


def test_times_truncate_and_dates_floor(spark):
    df = spark.sql("select timestamp '1969-12-31 23:59:58.5' as x union all select timestamp '2024-01-01' union all select null")
    made = {k: coerced(F.col("x"), df.schema["x"].dataType, k)[0] for k in ("Date", "TimestampSecond", "TimestampMillisecond", "TimestampNanosecond")}
    rows = df.select(*[c.alias(k) for k, c in made.items()]).select(*[wire(F.col(k), k).alias(k) for k in made]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(-1, -1, -1500, -1_500_000_000), (19723, 1704067200, 1704067200000, 1704067200000000000), (None,) * 4], key=str)
    assert results(spark, "timestamp", [dt.datetime(2500, 1, 1, tzinfo=dt.UTC)], "TimestampNanosecond") == [(None, "range")]
    assert results(spark, "string", ["2024-13-01", None], "TimestampSecond") == [(None, "invalid_date"), (None, None)]
    assert results(spark, "long", [2**62], "TimestampSecond") == [(None, "range")]


def test_time_of_day_profiles(spark):
    assert results(spark, "long", [2**31, 5], "TimeSecond") == [(2**31, None), (5, None)]
    assert results(spark, "long", [2**31, 5], "TimeSecond", "bulk") == [(None, "range"), (5, None)]
    assert results(spark, "long", [2**31], "TimeMicrosecond", "bulk") == [(2**31, None)]


SPEC = TableSpec("metrics", (tag("host"), field("usage", "Float64"), timestamp("ts")))


def test_spec_rules():
    for columns in ((), (tag("a"),), (timestamp("t"), timestamp("u")), (tag("a"), tag("A"), timestamp("t")), (tag(""), timestamp("t")), (ColumnSpec("t", "Int64", "timestamp"),), (ColumnSpec("x", "Int7"), timestamp("t"))):
        with pytest.raises(SchemaError):
            TableSpec("t", columns)
    with pytest.raises(SchemaError):
        TableSpec("", (timestamp("t"),))
    assert SPEC.tags == ["host"] and SPEC.time == "ts" and SPEC.schema()["ts"].metadata == {"semantic": "timestamp", "type": "TimestampMillisecond"}


def test_mapped_class(spark):
    @dataclasses.dataclass
    class Metric:
        deviceId: str = dataclasses.field(metadata={"column": tag("device_id")})
        usage: float = dataclasses.field(metadata={"column": field("", "Float64")})
        at: int = dataclasses.field(metadata={"column": timestamp("ts")})

    spec = mapped(Metric)
    assert spec.name == "metric" and spec.names == ["device_id", "usage", "ts"]
    got = conform.conformed(spark.createDataFrame([("a", 1, 1000)], "deviceId string, usage long, at long"), spec)
    assert got.columns == spec.names and got.first()["usage"] == 1.0
    with pytest.raises(SchemaError):
        mapped(int)


def test_conform_by_name_and_place(spark):
    df = spark.createDataFrame([(1000, "a")], "ts long, host string")
    row = conform.conformed(df, SPEC).first()
    assert row["usage"] is None and row["ts"] == dt.datetime(1970, 1, 1, 0, 0, 1)
    for bad in (df.withColumn("more", F.lit(1)),):
        with pytest.raises(SchemaError):
            conform.conformed(bad, SPEC)
    with pytest.raises(SchemaError):
        conform.conformed(df, SPEC, by="position")
    with pytest.raises(Exception, match="usage: not a Float64"):
        conform.conformed(df.withColumn("usage", F.lit("x")), SPEC).collect()


def test_quarantine(spark):
    spec = TableSpec("q", (field("a", "Int8"), field("b", "Uint8"), timestamp("ts")))
    rows = conform.judged(spark.createDataFrame([(1, 2, 3), (300, -1, 3), (None, 4, None)], "a long, b long, ts long"), spec)
    assert conform.accepted(rows).count() == 2 and conform.quarantined(rows).count() == 1
    assert {tuple(r) for r in conform.rejection_report(rows, "q").collect()} == {("q", "a", "range", 1, "300"), ("q", "b", "range", 1, "-1")}


def test_union_refuses_drift(spark):
    a = spark.createDataFrame([(1,)], "x long")
    assert conform.merged(a, a).count() == 2
    with pytest.raises(SchemaError):
        conform.merged(a, a.select(F.col("x").cast("int")))


def test_both_reports_agree(spark):
    spec = TableSpec("r", (tag("a", "Int8"), field("b", "Bool"), field("c", "TimestampSecond"), field("missing", "String"), timestamp("ts")))
    rows = spark.sql("select * from values (1L, 'x', '2024-01-01', 1L), (300L, null, 'no', 2L), (null, 'y', '2024-13-01', null), (-400L, 'z', null, 3L) as t(a, b, c, ts)")
    for df in (rows, rows.limit(0)):
        plain = conform.rejection_report(conform.judged(df, spec), "r")
        assert sorted(map(tuple, conform.rejections(df, spec).collect())) == sorted(map(tuple, plain.collect()))
    assert {(r["column_name"], r["reason"], r["rejected"], r["sample"]) for r in conform.rejections(rows, spec).collect()} == {("a", "range", 2, "-400"), ("b", "type:string", 3, "x"), ("c", "invalid_date", 2, "2024-13-01")}
