"""Cell coercions and conforming, over lineitem and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import coerced, wire
from ..operators import conform
from ..operators.spec import TableSpec, field, tag, timestamp
from .registry import query, table

EVENT = TableSpec("event", (tag("user_id", "Int64"), tag("event_type"), field("value", "Float64"), field("props", "Json"), field("note", "String"), timestamp("ts")))


def _each(df: DataFrame, keys: list[str], made: dict[str, tuple[str, str]], profile: str = "row") -> DataFrame:
    """``keys``, and for each name a coerced column and its reason; ``made``: name to (column, type)."""
    out = [F.col(k) for k in keys]
    for name, (source, kind) in made.items():
        value, reason = coerced(F.col(source), df.schema[source].dataType, kind, profile)
        out += [value.alias(name), reason.alias(f"{name}_error")]
    return df.select(*out)


@query("""
SELECT l_orderkey, l_linenumber,
  CASE WHEN q BETWEEN -128 AND 127 THEN q::TINYINT END AS q8, CASE WHEN NOT q BETWEEN -128 AND 127 THEN 'range' END AS q8_error,
  CASE WHEN p = trunc(p) AND p BETWEEN -2147483648 AND 2147483647 THEN p::INTEGER END AS p32,
  CASE WHEN NOT (p = trunc(p) AND p BETWEEN -2147483648 AND 2147483647) THEN 'range' END AS p32_error,
  CASE WHEN k BETWEEN 0 AND 255 THEN k::SMALLINT END AS k8, CASE WHEN NOT k BETWEEN 0 AND 255 THEN 'range' END AS k8_error,
  NULL::SMALLINT AS s16, 'type:string' AS s16_error
FROM (SELECT *, l_quantity * 4 AS q, l_extendedprice AS p, l_suppkey - 20 AS k FROM lineitem)
""")
def coerce_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_quantity * 4 as q", "l_extendedprice as p", "l_suppkey - 20 as k", "l_returnflag as s")
    return _each(df, ["l_orderkey", "l_linenumber"], {"q8": ("q", "Int8"), "p32": ("p", "Int32"), "k8": ("k", "Uint8"), "s16": ("s", "Int16")})


@query("""
SELECT l_orderkey, l_linenumber,
  CASE WHEN big BETWEEN 0 AND 18446744073709551615 THEN big::DECIMAL(20,0)::VARCHAR END AS u64, CASE WHEN NOT big BETWEEN 0 AND 18446744073709551615 THEN 'range' END AS u64_error,
  CASE WHEN wide = trunc(wide) AND abs(wide) <= 9007199254740991 THEN wide::BIGINT END AS i64,
  CASE WHEN NOT (wide = trunc(wide) AND abs(wide) <= 9007199254740991) THEN 'range' END AS i64_error
FROM (SELECT l_orderkey, l_linenumber, (l_partkey - 5)::DECIMAL(38,0) * 18446744073709551 AS big, l_extendedprice * 100000000000 AS wide FROM lineitem)
""")
def coerce_uint64(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "cast(cast(l_partkey - 5 as decimal(18,0)) * 18446744073709551BD as decimal(38,0)) as big", "l_extendedprice * 100000000000D as wide")
    return _each(df, ["l_orderkey", "l_linenumber"], {"u64": ("big", "Uint64"), "i64": ("wide", "Int64")}).withColumn("u64", F.col("u64").cast("string"))


@query("""
SELECT event_id, v::FLOAT AS f32, NULL::VARCHAR AS f32_error, user_id::DOUBLE AS f64, NULL::VARCHAR AS f64_error, NULL::DOUBLE AS text, 'type:string' AS text_error
FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'inf'::DOUBLE ELSE value END AS v FROM events)
""")
def coerce_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, float("inf")).otherwise(F.col("value"))
    df = table(spark, sf_dir, "events").withColumn("v", v)
    return _each(df, ["event_id"], {"f32": ("v", "Float32"), "f64": ("user_id", "Float64"), "text": ("event_type", "Float64")})


@query("""
SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes, octet_length(encode(text))::BIGINT AS n_bytes, NULL::VARCHAR AS bytes_error FROM documents
""")
def coerce_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    value, reason = coerced(F.col("text"), df.schema["text"].dataType, "Binary")
    return df.select("doc_id", F.hex(F.coalesce(value, F.lit(b""))).alias("bytes"), F.octet_length(value).cast("long").alias("n_bytes"), reason.alias("bytes_error"))


@query("""
SELECT event_id, props AS verbatim,
  '{"u":' || user_id || ',"t":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '"' || event_type || '"' END || '}' AS packed,
  '[' || user_id || ',' || event_id || ']' AS listed,
  '{"n":null,"m":{"a":null,"b":' || event_id || '},"w":' || event_id % 100 * 1000000 || ',"h":' || event_id || '.5,"at":"' || strftime(ts - INTERVAL 20000 DAY, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}' AS odd,
  '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"' AS moment
FROM events
""")
def coerce_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    df = table(spark, sf_dir, "events").withColumns({"s": F.struct(F.col("user_id").alias("u"), kind.alias("t")), "a": F.array("user_id", "event_id")})
    odd = F.struct(F.lit(float("nan")).alias("n"), F.create_map(F.lit("a"), F.lit(float("inf")), F.lit("b"), F.col("event_id").cast("double")).alias("m"), (F.col("event_id") % 100 * 1e6).alias("w"), (F.col("event_id") + 0.5).alias("h"), (F.col("ts") - F.expr("interval 20000 days")).alias("at"))
    made = _each(df.withColumn("odd", odd), ["event_id"], {"verbatim": ("props", "Json"), "packed": ("s", "Json"), "listed": ("a", "Json"), "odd": ("odd", "Json"), "moment": ("ts", "Json")})
    return made.select("event_id", "verbatim", "packed", "listed", "odd", "moment")


@query("""
SELECT event_id, (early::DATE - DATE '1970-01-01')::INTEGER AS days, (n / 1 - 20000)::INTEGER AS given,
  CASE WHEN value <> trunc(value) THEN 'range' END AS fraction_error
FROM (SELECT event_id, value, event_id % 40000 AS n, ts - INTERVAL 20000 DAY AS early FROM events)
""")
def coerce_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").selectExpr("event_id", "value", "event_id % 40000 - 20000 as n", "ts - interval 20000 days as early")
    out = _each(df, ["event_id"], {"d": ("early", "Date"), "g": ("n", "Date"), "fraction": ("value", "Date")})
    return out.select("event_id", wire(F.col("d"), "Date").alias("days"), wire(F.col("g"), "Date").alias("given"), "fraction_error")


@query("""
SELECT event_id, us // 1000000 AS s, us // 1000 AS ms, us, us * 1000 AS ns, e * 1000 AS from_ms, CASE WHEN value <> trunc(value) THEN 'range' END AS fraction_error
FROM (SELECT event_id, value, epoch_us(ts - INTERVAL 20000 DAY) AS us, event_id - 5000 AS e FROM events)
""")
def coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").selectExpr("event_id", "value", "ts - interval 20000 days as early", "event_id - 5000 as e")
    kinds = {"s": "TimestampSecond", "ms": "TimestampMillisecond", "us": "TimestampMicrosecond", "ns": "TimestampNanosecond"}
    out = _each(df, ["event_id"], {k: ("early", t) for k, t in kinds.items()} | {"e": ("e", "TimestampMillisecond"), "fraction": ("value", "TimestampSecond")})
    return out.select("event_id", *[wire(F.col(k), t).alias(k) for k, t in kinds.items()], wire(F.col("e"), "TimestampMicrosecond").alias("from_ms"), "fraction_error")


@query("""
SELECT event_id, CASE WHEN event_id % 5 > 0 THEN epoch_us(date_trunc('second', ts)) END AS at_us, CASE WHEN event_id % 5 = 0 THEN 'invalid_date' END AS at_us_error, value > 50 AS up, NULL::VARCHAR AS up_error,
  NULL::VARCHAR AS name, CASE WHEN event_id % 3 > 0 THEN 'type:boolean' END AS name_error
FROM events
""")
def coerce_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 5 == 0, "2024-13-45 10:00").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    df = table(spark, sf_dir, "events").withColumns({"text": text, "high": F.col("value") > 50, "flag": F.when(F.col("event_id") % 3 > 0, F.col("value") > 1)})
    out = _each(df, ["event_id"], {"at_us": ("text", "TimestampSecond"), "up": ("high", "Bool"), "name": ("flag", "String")})
    return out.withColumn("at_us", F.unix_micros("at_us"))


@query("""
SELECT l_orderkey, l_linenumber, big AS row_ms, NULL::VARCHAR AS row_ms_error,
  CASE WHEN big BETWEEN -2147483648 AND 2147483647 THEN big END AS bulk_ms, CASE WHEN NOT big BETWEEN -2147483648 AND 2147483647 THEN 'range' END AS bulk_ms_error,
  big AS bulk_us, NULL::VARCHAR AS bulk_us_error
FROM (SELECT *, l_partkey * 2000000 - 1000000000 AS big FROM lineitem)
""")
def coerce_time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey * 2000000 - 1000000000 as big")
    parts = [coerced(F.col("big"), df.schema["big"].dataType, kind, profile) for kind, profile in (("TimeMillisecond", "row"), ("TimeMillisecond", "bulk"), ("TimeMicrosecond", "bulk"))]
    names = ("row_ms", "bulk_ms", "bulk_us")
    return df.select("l_orderkey", "l_linenumber", *[c.alias(n) for name, (v, e) in zip(names, parts, strict=True) for c, n in ((v, name), (e, f"{name}_error"))])


@query("SELECT user_id, event_type, value, props, NULL::VARCHAR AS note, date_trunc('milliseconds', ts) AS ts FROM events")
def conform_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("props", "value", "ts", "event_type", "user_id")
    return conform.conformed(rows, EVENT)


@query("SELECT user_id, event_type, value, props, event_type AS note, date_trunc('milliseconds', ts) AS ts FROM events")
def conform_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("user_id as a", "event_type as b", "value as c", "props as d", "event_type as e", "ts as f")
    return conform.conformed(rows, EVENT, by="position")


LINE = TableSpec("line", (tag("order_key", "Uint32", "l_orderkey"), tag("line", "Int8", "l_linenumber"), field("quantity", "Int16", "l_quantity"), field("price", "Float64", "l_extendedprice"), field("part", "Uint32", "l_partkey"), timestamp("ts", "second", "l_shipdate")))
_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_shipdate"]


@query("SELECT l_orderkey AS order_key, l_linenumber::TINYINT AS line, l_quantity::SMALLINT AS quantity, l_extendedprice AS price, l_partkey::INTEGER AS part, date_trunc('second', l_shipdate) AS ts FROM lineitem")
def conform_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conformed(table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS), LINE)


@query("SELECT t AS table_name, bad > 0 AS refused, bad AS bad_rows, c AS first_column, r AS first_reason FROM (SELECT 'line' AS t, 0::BIGINT AS bad, NULL::VARCHAR AS c, NULL::VARCHAR AS r UNION ALL SELECT 'priced', count(*) FILTER (WHERE NOT l_partkey BETWEEN 0 AND 255 OR l_extendedprice <> trunc(l_extendedprice) OR l_linenumber = 7), CASE WHEN bool_or(l_linenumber = 7) THEN 'flag' WHEN bool_or(NOT l_partkey BETWEEN 0 AND 255) THEN 'part' ELSE 'price' END, CASE WHEN bool_or(l_linenumber = 7) THEN 'type:string' ELSE 'range' END FROM lineitem)")
def strict_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = conform.refusal(table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS), LINE)
    return fine.union(conform.refusal(_priced_rows(spark, sf_dir), PRICED))


PRICED = TableSpec("priced", (tag("part", "Uint8", "l_partkey"), tag("line", "Int8", "l_linenumber"), field("price", "Int32", "l_extendedprice"), field("flag", "Bool", "l_returnflag"), timestamp("ts", "second", "l_shipdate")))


def _priced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_partkey", "l_linenumber", "l_extendedprice", "if(l_linenumber = 7, l_returnflag, null) as l_returnflag", "l_shipdate")


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.judged(_priced_rows(spark, sf_dir), PRICED)


@query("""
SELECT bad, count(*) AS n, count(part) AS parts, coalesce(sum(price), 0)::BIGINT AS price, sum(errors)::BIGINT AS errors FROM (
  SELECT (errors > 0)::BOOLEAN AS bad, errors, CASE WHEN l_partkey BETWEEN 0 AND 255 THEN l_partkey END AS part, CASE WHEN l_extendedprice = trunc(l_extendedprice) THEN l_extendedprice::BIGINT END AS price
  FROM (SELECT *, (NOT l_partkey BETWEEN 0 AND 255)::INTEGER + (l_extendedprice <> trunc(l_extendedprice))::INTEGER + (l_linenumber = 7)::INTEGER AS errors FROM lineitem)
) GROUP BY bad
""")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _priced(spark, sf_dir).withColumn("bad", F.size("_errors") > 0)
    counts = [F.count("*").alias("n"), F.count("part").alias("parts"), F.coalesce(F.sum("price"), F.lit(0)).cast("long").alias("price")]
    return both.groupBy("bad").agg(*counts, F.sum(F.size("_errors")).cast("long").alias("errors"))


@query("""
SELECT 'priced' AS table_name, column_name, reason, count(*) AS rejected, min(raw) AS sample FROM (
  SELECT 'part' AS column_name, 'range' AS reason, l_partkey::VARCHAR AS raw FROM lineitem WHERE NOT l_partkey BETWEEN 0 AND 255
  UNION ALL SELECT 'price', 'range', l_extendedprice::VARCHAR FROM lineitem WHERE l_extendedprice <> trunc(l_extendedprice)
  UNION ALL SELECT 'flag', 'type:string', l_returnflag FROM lineitem WHERE l_linenumber = 7
) GROUP BY ALL
""")
def rejection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.rejections(_priced_rows(spark, sf_dir), PRICED)


@query("""
SELECT column_name, row_rejected, bulk_rejected, same_bytes FROM (
  SELECT 'ms' AS column_name, 0::BIGINT AS row_rejected, count(*) FILTER (WHERE NOT big BETWEEN -2147483648 AND 2147483647) AS bulk_rejected, NULL::BIGINT AS same_bytes FROM (SELECT l_partkey * 2000000 AS big FROM lineitem)
  UNION ALL SELECT 'small', count(*) FILTER (WHERE NOT l_partkey BETWEEN 0 AND 255), count(*) FILTER (WHERE NOT l_partkey BETWEEN 0 AND 255), NULL FROM lineitem
  UNION ALL SELECT 'doc', 0, 0, count(*) FROM lineitem)
""")
def profile_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both profiles over the same cells; JSON is text in one and the bytes of that text in the other."""
    spec = TableSpec("parity", (field("ms", "TimeMillisecond"), field("small", "Uint8"), field("doc", "Json"), timestamp("ts")))
    doc = F.struct(F.col("l_returnflag").alias("é"), (F.col("l_quantity") / 0.5).alias("q"), F.lit(float("nan")).alias("n"))
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2000000).alias("ms"), F.col("l_partkey").alias("small"), doc.alias("doc"), F.col("l_shipdate").alias("ts"))
    names, profiles = ("ms", "small", "doc"), ("row", "bulk")
    wrong = rows.select(*(F.transform(conform.errors(rows, spec, profile=p), lambda e: e["column"]).alias(p) for p in profiles), *(coerced(F.col("doc"), rows.schema["doc"].dataType, "Json", p)[0].alias(f"doc_{p}") for p in profiles))
    same = F.count_if(F.encode("doc_row", "UTF-8") == F.col("doc_bulk")).alias("same_bytes")
    counts = wrong.agg(same, *(F.count_if(F.array_contains(p, n)).alias(f"{p}_{n}") for p in profiles for n in names))
    each = F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(f"row_{n}").alias("row_rejected"), F.col(f"bulk_{n}").alias("bulk_rejected"), F.when(F.lit(n == "doc"), F.col("same_bytes")).alias("same_bytes")) for n in names))
    return counts.select(F.explode(each).alias("x")).select("x.*")
