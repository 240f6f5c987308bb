"""Writes and what is read back after them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conform
from ..operators.spec import TableSpec, field, tag, timestamp
from ..sources import generate
from ..sources.store import TableStore, WriteError, scratch_folder
from .registry import query, table

POINT = TableSpec("point", (tag("user_id", "Int64"), tag("event_type"), field("value", "Float64"), timestamp("ts", "microsecond")))
ORDER = TableSpec("purchase", (tag("customer", "Int64", "o_custkey"), field("total", "Float64", "o_totalprice"), timestamp("ts", "second", "o_orderdate")))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts")


@query("""
SELECT 'point' AS table_name, count(*) AS affected_rows, count(*) AS stored_rows, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events
UNION ALL SELECT 'purchase', count(*), count(*), sum(o_totalprice::DECIMAL(18,2))::DOUBLE FROM orders
""")
def write_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, scratch_folder(spark, "multi"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    counts = store.write([(POINT, _points(spark, sf_dir)), (ORDER, orders)])
    rows = [store.read(s.name).agg(F.lit(s.name).alias("table_name"), F.lit(counts[s.name]).cast("long").alias("affected_rows"), F.count("*").alias("stored_rows"), F.sum(F.col(v).cast("decimal(18,2)")).cast("double").alias("total")) for s, v in ((POINT, "value"), (ORDER, "total"))]
    return rows[0].union(rows[1])


@query("SELECT event_id // 1000 AS batch_id, count(*) AS affected_rows FROM events GROUP BY ALL UNION ALL SELECT max(event_id) // 1000 + 1, 0 FROM events")
def bulk_load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, scratch_folder(spark, "bulk"))
    store.create(POINT)
    rows = table(spark, sf_dir, "events").selectExpr("user_id", "event_type", "value", "ts", "event_id div 1000 as batch_id")
    announced = rows.select("batch_id").distinct().union(rows.agg(F.max("batch_id") + 1))  # the last one has no row
    ledger = store.bulk_load(rows, POINT, "batch_id", codec="lz4", announced=announced)
    if store.read("point").count() != (ledger.agg(F.sum("affected_rows")).first()[0] or 0):
        raise WriteError("rows stored differ from rows acknowledged")
    return ledger


@query("""
SELECT codec, count(*) AS stored_rows, sum(value::DECIMAL(18,2))::DOUBLE AS total, count(DISTINCT (user_id, event_type)) AS series
FROM events, (VALUES ('none'), ('lz4'), ('zstd')) AS c(codec) GROUP BY codec
""")
def compression_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for codec in ("none", "lz4", "zstd"):
        store = TableStore(spark, scratch_folder(spark, codec))
        store.write([(POINT, _points(spark, sf_dir))], codec=codec)
        one = store.read("point").agg(F.lit(codec).alias("codec"), F.count("*").alias("stored_rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"), F.count_distinct("user_id", "event_type").alias("series"))
        out = one if out is None else out.union(one)
    return out


@query("SELECT step, existed, n FROM (SELECT 'must_exist' AS step, false AS existed, 0::BIGINT AS n UNION ALL SELECT 'created', true, (SELECT count(*) FROM events) UNION ALL SELECT 'appended', true, (SELECT 2 * count(*) FROM events))")
def auto_create_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, rows = TableStore(spark, scratch_folder(spark, "auto")), _points(spark, sf_dir)
    try:
        store.write([(POINT, rows)], hints={"auto_create_table": "false"})
    except WriteError:
        pass
    first = spark.range(1).select(F.lit("must_exist").alias("step"), F.lit(store.exists("point")).alias("existed"), F.lit(0).cast("long").alias("n"))
    store.write([(POINT, rows)])
    n = store.read("point").count()
    store.write([(POINT, rows)], hints={"auto_create_table": "false"})
    then = store.read("point").agg(F.count("*").alias("n"))
    return first.union(spark.range(1).select(F.lit("created"), F.lit(store.exists("point")), F.lit(n).cast("long"))).union(then.select(F.lit("appended"), F.lit(True), "n"))


#: Records of these kinds go to tables of their own.
KINDS = {
    "click": TableSpec("clicks", (tag("user", "Int64", "user_id"), field("amount", "Float64", "value"), timestamp("ts"))),
    "purchase": TableSpec("purchases", (tag("user", "Int64", "user_id"), field("amount", "Float64", "value"), field("props", "Json"), timestamp("ts"))),
    "view": TableSpec("view", (tag("user", "Int64", "user_id"), timestamp("ts"), field("missing", "String"))),
    "error": TableSpec("errors", (field("props", "Json"), timestamp("ts"), tag("user", "Int64", "user_id"))),
    "signup": TableSpec("signups", (tag("user", "Int64", "user_id"), timestamp("ts"), field("amount", "Float32", "value"))),
}


@query("""
SELECT CASE event_type WHEN 'view' THEN 'view' ELSE event_type || 's' END AS table_name, user_id AS "user", CASE WHEN event_type IN ('click', 'purchase') THEN value WHEN event_type = 'signup' THEN value::FLOAT::DOUBLE END AS amount,
  CASE WHEN event_type IN ('purchase', 'error') THEN props END AS props, date_trunc('milliseconds', ts) AS ts
FROM events
""")
def route_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, scratch_folder(spark, "kinds"))
    store.write_kinds(table(spark, sf_dir, "events"), "event_type", KINDS)
    out = None
    for spec in KINDS.values():
        held = store.read(spec.name)
        pick = [F.col(c).cast(t).alias(c) if c in held.columns else F.lit(None).cast(t).alias(c) for c, t in (("user", "long"), ("amount", "double"), ("props", "string"), ("ts", "timestamp"))]
        one = held.select(F.lit(spec.name).alias("table_name"), *pick)
        out = one if out is None else out.union(one)
    return out


def _hex_sql(salt: int, place: int, width: int) -> str:
    return f"('0x' || substr(md5('{salt}:' || i), {place * width + 1}, {width}))::BIGINT"


_NUMBERS_SQL = "(SELECT l_orderkey * 8 + l_linenumber AS i FROM lineitem)"


@query(f"""
SELECT 'host-' || (s % 3) AS host, 'region-' || (s // 3 % 5) AS region, 'dc-' || (s // 15 % 10) AS datacenter, 'svc-' || lpad((s // 150 % 20)::VARCHAR, 2, '0') AS service,
  {", ".join(f"{_hex_sql(1, k, 6)} / 16777216.0::DOUBLE * {size} AS {n}" for k, (n, size) in enumerate((("cpu", 100), ("memory", 100), ("disk_util", 100), ("net_in", 1000000000), ("net_out", 1000000000))))},
  make_timestamp((1704067200000 + i) * 1000) AS ts
FROM (SELECT i, i % 3000 AS s FROM {_NUMBERS_SQL})
""")
def gen_cpu_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.cpu_rows(table(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 8 + l_linenumber as id"), hosts=3)


def _pick_sql(k: int, values: tuple[str, ...]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{_log_sql(k)} % {len(values)} + 1]"


def _log_sql(k: int) -> str:
    return _hex_sql(2 + k // 8, k % 8, 4)


@query(f"""
SELECT {_pick_sql(0, generate.LOG_SERVICES)} AS service, 'host-' || {_log_sql(1)} % 32 AS host, {_pick_sql(2, generate.LOG_REGIONS)} AS region, {_pick_sql(3, generate.LOG_ENVS)} AS env, 'pod-' || {_log_sql(4)} % 64 AS pod,
  {_pick_sql(5, generate.LOG_LEVELS)} AS log_level, 'request ' || i || ' handled' AS message, md5('2:' || i) AS trace_id, substr(md5('3:' || i), 1, 16) AS span_id, {_pick_sql(6, generate.METHODS)} AS http_method,
  '/api/v1/items/' || i % 1000 AS http_path, {_pick_sql(7, generate.CLASSES)} AS http_status_class, {_pick_sql(8, generate.AGENTS)} AS user_agent, '10.0.' || i % 256 || '.' || i // 256 % 256 AS client_ip,
  'caller-' || {_log_sql(9)} % 16 AS caller, {_log_sql(10)} / 65536.0::DOUBLE * 200 AS latency_ms, {_log_sql(11)} % 10000 AS bytes_in, {_log_sql(12)} AS bytes_out, {_log_sql(5)} % 4 = 3 AS error_flag, {_log_sql(13)} < 3277 AS retry_flag,
  make_timestamp((1704067200000 + i) * 1000) AS log_ts, 1704067200000 + i AS ingest_ts
FROM (SELECT event_id AS i FROM events)
""")
def gen_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conformed(generate.log_rows(table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))), generate.LOG)


@query("SELECT user_id, event_type, value, ts FROM events UNION ALL SELECT user_id, event_type, value, ts FROM events WHERE event_id % 3 = 0")
def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    pick = ["user_id", "event_type", "value", "ts"]
    return conform.merged(*(rows.where(x).select(*pick) for x in ("event_id % 2 = 0", "event_id % 2 <> 0", "event_id % 3 = 0")))
