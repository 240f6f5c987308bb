"""Series reads, changes to tables, nested values and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mutate, nested, timeseries
from ..operators.conform import conformed
from ..operators.spec import TableSpec, field, tag, timestamp
from .registry import query, table

HOUR = 3_600_000_000
#: 2024-01-05 to 2024-01-12, a step of 12 hours, a look back of one day.
BEGIN, END, STEP, BACK = 1_704_412_800_000_000, 1_705_017_600_000_000, 12 * HOUR, 24 * HOUR
TAGS = ["user_id", "event_type"]


@query("SELECT user_id, event_type, max(ts) AS ts, arg_max(value, (ts, value)) AS value FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND ts > TIMESTAMP '2024-01-17' GROUP BY ALL")
def instant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.instant(table(spark, sf_dir, "events"), TAGS, "ts", "value", F.lit("2024-01-20").cast("timestamp"), 72 * HOUR)


_GRID_SQL = f"WITH grid AS (SELECT unnest(range({BEGIN}, {END} + 1, {STEP})) AS step), placed AS (SELECT e.*, epoch_us(ts) AS us, step FROM events e JOIN grid ON epoch_us(ts) <= step AND epoch_us(ts) > step - {BACK})"


@query(_GRID_SQL + " SELECT user_id, event_type, step, arg_max(value, (us, value)) AS last, sum(value::DECIMAL(18,2))::DOUBLE AS sum, (sum(value::DECIMAL(18,2))::DOUBLE / count(*)) AS avg, max(value) AS max, count(*) AS samples FROM placed GROUP BY ALL")
def range_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = timeseries.evaluated(rows, TAGS, "ts", "value", BEGIN, END, STEP, BACK)
    return out.select(*TAGS, "step", *[F.col(c).cast("double").alias(c) for c in ("last", "sum")], (F.col("sum").cast("double") / F.col("samples")).alias("avg"), F.col("max").cast("double").alias("max"), "samples")


@query(_GRID_SQL + " SELECT user_id, event_type, step, (arg_max(value, (us, value)) - arg_min(value, (us, value))) / ((max(us) - min(us)) / 1e6::DOUBLE) AS rate FROM placed GROUP BY ALL HAVING max(us) > min(us)")
def range_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.rates(table(spark, sf_dir, "events"), TAGS, "ts", "value", BEGIN, END, STEP, BACK)


ALERTS_SQL = f"""
WITH placed AS (SELECT event_type, epoch_us(ts) AS us, bool_or(value > 40) AS up FROM events GROUP BY ALL),
marked AS (SELECT *, CASE WHEN up AND NOT coalesce(lag(up) OVER w, false) THEN 1 ELSE 0 END AS new, lead(us) OVER w AS next_us FROM placed WINDOW w AS (PARTITION BY event_type ORDER BY us)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY us) AS run FROM marked),
runs AS (SELECT event_type, min(us) AS started, max(us) AS last_true, arg_max(coalesce(next_us, -1), us) AS false_at FROM numbered WHERE up GROUP BY event_type, run),
linked AS (SELECT *, CASE WHEN started - lag(last_true) OVER w <= {2 * HOUR} THEN 0 ELSE 1 END AS apart FROM runs WINDOW w AS (PARTITION BY event_type ORDER BY started)),
chains AS (SELECT *, sum(apart) OVER (PARTITION BY event_type ORDER BY started) AS chain FROM linked),
states AS (SELECT *, bool_or(last_true - started >= {HOUR // 2}) OVER (PARTITION BY event_type, chain ORDER BY started) AS firing FROM chains)
SELECT event_type, min(started) AS started, max(last_true) AS last_true, CASE WHEN firing THEN min(started) + {HOUR // 2} END AS fired_at,
  CASE WHEN arg_max(false_at, last_true) = -1 THEN NULL WHEN firing THEN max(last_true) + {2 * HOUR} ELSE max(false_at) END AS ended_at, CASE WHEN firing THEN 'firing' ELSE 'pending' END AS state
FROM states GROUP BY event_type, chain, firing, CASE WHEN NOT firing THEN started END
"""


@query(ALERTS_SQL)
def alert_for_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.alerts(table(spark, sf_dir, "events"), ["event_type"], "ts", F.col("value") > 40, HOUR // 2, 2 * HOUR)


@query("SELECT event_id, user_id, event_type, value FROM events WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey % 3 = 0 AND c_custkey = user_id)")
def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"))
    return mutate.without_keys(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), keys)


@query("SELECT event_id, ts FROM events WHERE NOT (ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-05') AND NOT (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11')")
def truncate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = 86_400_000
    first = 1_704_067_200_000
    return mutate.truncated(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", [(first + 2 * day, first + 4 * day), (first + 9 * day, first + 10 * day)])


@query("""
WITH ranges AS (SELECT 1704067200000 + o_orderkey * 7919 % 2592000 * 1000 AS a, 1704067200000 + (o_orderkey * 7919 % 2592000 + CASE WHEN o_orderkey % 997 = 0 THEN 7200 ELSE o_custkey % 40 END) * 1000 AS b FROM orders)
SELECT event_id, ts FROM events WHERE NOT EXISTS (SELECT 1 FROM ranges WHERE epoch_us(ts) >= a * 1000 AND epoch_us(ts) < b * 1000)
""")
def truncate_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many ranges of seconds as there are orders, some of hours."""
    ranges = table(spark, sf_dir, "orders").selectExpr("1704067200000 + o_orderkey * 7919 % 2592000 * 1000 as start", "if(o_orderkey % 997 = 0, 7200, o_custkey % 40) * 1000 as long").selectExpr("start", "start + long as end")
    return mutate.truncated_by(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", ranges)


@query("WITH rows AS (SELECT event_id, user_id % 4 AS part, value FROM events), bounds AS (SELECT part, (min(event_id) + max(event_id)) // 2 AS upto FROM rows GROUP BY part) SELECT event_id, part, value FROM rows JOIN bounds USING (part) WHERE event_id <= upto")
def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "user_id % 4 as part", "value")
    bounds = rows.groupBy("part").agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("upto"))
    return mutate.snapshot(rows, "part", "event_id", bounds)


@query("SELECT 'eu' AS site, user_id, value::FLOAT AS value, 'none' AS grade, ts FROM events")
def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = TableSpec("reading", (tag("user_id", "Int64"), field("event_type", "String"), field("value", "Float64"), timestamp("ts", "microsecond")))
    change = mutate.Change
    new = mutate.evolved(old, [
        change("add", "site", tag("site")), change("drop", "event_type"), change("retype", "value", type="Float32"),
        change("add", "grade", field("grade", "String"), after="value"), change("default", "grade", default="none"), change("default", "site", default="eu"),
    ], "reading_2")
    rows = table(spark, sf_dir, "events").select("user_id", "value", "ts")
    return conformed(rows, new).select("site", "user_id", "value", "grade", "ts")


@query("SELECT event_id, CASE WHEN value >= 100 THEN 'high' WHEN event_type = 'error' THEN 'errors' ELSE 'rest' END AS part FROM events")
def repartition_exprs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return mutate.routed(rows, [("high", F.col("value") >= 100), ("errors", F.col("event_type") == "error")]).select("event_id", "part")


@query("""
SELECT l_orderkey, list(CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_quantity END ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)::VARCHAR AS quantities FROM lineitem GROUP BY l_orderkey
""")
def null_mask_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(order)).alias("r")).withColumn("size", F.size("r"))
    full = F.transform("r", lambda x: F.when(x["l_linenumber"] % 2 == 0, None).otherwise(x["l_quantity"]))
    sparse = rows.select("l_orderkey", "size", F.array_compact(full).alias("held"), full.alias("full"))
    octets = F.expr("array_join(transform(sequence(0, (size - 1) div 8), b -> lpad(hex(aggregate(sequence(0, 7), 0L, (s, k) -> s + if(b * 8 + k < size and full[b * 8 + k] is null, shiftleft(1L, k), 0L))), 2, '0')), '')")
    sparse = sparse.withColumn("mask", F.unhex(octets))
    back = sparse.select("l_orderkey", nested.dense("held", "mask", "size").alias("v"))
    return back.select("l_orderkey", F.concat(F.lit("["), F.array_join("v", ", ", "NULL"), F.lit("]")).alias("quantities"))


@query("""
SELECT o_orderkey, wide::VARCHAR AS wide, CASE WHEN wide < 0 THEN '-' ELSE '' END || substr(d, 1, 39 - 4) || '.' || substr(d, 36, 4) AS scaled, CASE WHEN o_orderkey % 7 = 0 THEN 'range' END AS too_wide,
  CASE WHEN o_orderkey % 5 > 0 THEN [o_orderkey % 5, NULL, 127] END::VARCHAR AS small, CASE WHEN o_orderkey % 5 = 0 THEN '[0]:range' END AS small_error,
  o_orderkey % 12 AS months, CASE WHEN o_custkey % 3 = 0 THEN '.days:range' END AS every_error, o_custkey * 1000 AS span_us
FROM (SELECT *, lpad(abs(wide)::VARCHAR, 39, '0') AS d FROM (
  SELECT *, (o_custkey - 700)::HUGEINT * 1000000000000000 * 18446744073709551616::HUGEINT + CASE WHEN low < 0 THEN low + 18446744073709551616::HUGEINT ELSE low END AS wide FROM (SELECT *, (o_orderkey - 1000)::HUGEINT AS low FROM orders)))
""")
def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of 128 bits, written in full; where the upper half leaves its 64 bits there is no such number, and the row has nulls for it."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "try_multiply(o_custkey - 700, 1000000000000000L) as high", "o_orderkey - 1000 as low", "array(if(o_orderkey % 5 = 0, 300, o_orderkey % 5), null, 127) as small",
        "named_struct('months', o_orderkey % 12, 'days', if(o_custkey % 3 = 0, 5000000000, 3L)) as every", "o_custkey * 1000 as span",
    )
    wide = F.regexp_replace(nested.decimal_text(F.col("high"), F.col("low"), 0), r"^(-?)0+(?=\d)", "$1")
    scaled = nested.decimal_text(F.col("high"), F.col("low"), 4)
    _, narrow = nested.decimal_of(F.when(F.col("o_orderkey") % 7 == 0, F.lit(5)).otherwise(F.lit(0)), F.lit(1), 0, 19)
    of = {n: rows.schema[n].dataType for n in ("small", "every", "span")}
    small, small_error = nested.coerced_nested(F.col("small"), of["small"], nested.ListOf("Int8"))
    every, every_error = nested.coerced_nested(F.col("every"), of["every"], nested.Interval("mixed"))
    span, _ = nested.coerced_nested(F.col("span"), of["span"], nested.Interval("micros"))
    return rows.select(
        "o_orderkey", wide.alias("wide"), scaled.alias("scaled"), narrow.alias("too_wide"),
        F.concat(F.lit("["), F.array_join(small, ", ", "NULL"), F.lit("]")).alias("small"), small_error.alias("small_error"),
        F.coalesce(every["months"], F.col("every.months").cast("int")).cast("long").alias("months"), every_error.alias("every_error"), F.expr("0L").alias("x"), span.alias("span"),
    ).withColumn("span_us", F.expr("cast(extract(DAY from span) as bigint) * 86400000000 + cast(extract(HOUR from span) as bigint) * 3600000000 + cast(extract(MINUTE from span) as bigint) * 60000000 + cast(extract(SECOND from span) * 1000000 as bigint)")).drop("x", "span")


@query("SELECT vec_id, len(embedding) = 64 AND vec_id % 10 <> 0 AS accepted, CASE WHEN vec_id % 10 = 0 THEN 'dimension' END AS reason FROM embeddings")
def vector_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.when(F.col("vec_id") % 10 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    value, reason = nested.vector_of(cut, 64)
    return table(spark, sf_dir, "embeddings").select("vec_id", value.isNotNull().alias("accepted"), reason.alias("reason"))


@query(r"SELECT doc_id FROM documents WHERE list_contains(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}_]+'), 'licensed') AND list_contains(string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}_]+'), 'apache')")
def text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(nested.has_terms(F.col("text"), ["Licensed", "Apache"])).select("doc_id")


@query("""SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, event_type AS "http.method", value AS "a b", NULL::VARCHAR AS missing FROM events""")
def promote_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.expr("""concat(substr(props, 1, length(props) - 1), ', "http.method": "', event_type, '", "a b": ', value, '}')""")
    rows = table(spark, sf_dir, "events").select("event_id", both.alias("attributes"))
    return nested.promoted(rows, "attributes", {"k": "bigint", "http.method": "string", "a b": "double", "missing": "string"}).drop("attributes")


@query("SELECT DISTINCT unnest(json_keys(props::JSON)) AS key FROM events")
def attribute_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.attribute_keys(table(spark, sf_dir, "events"), "props")
