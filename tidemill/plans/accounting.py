"""Acknowledgements, batches, failures and reports. Requests are line items (frames of their order, the batch); acks derive from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import failures, ledger
from .registry import query, table

_FRAMES_SQL = """
frames AS (SELECT l_orderkey AS batch_id, l_orderkey * 8 + l_linenumber AS request_id, min(l_partkey) AS p FROM lineitem GROUP BY ALL),
acks AS (
  SELECT request_id * 2 AS seq, request_id, p % 50 AS affected_rows, p % 97 <> 0 AS ok FROM frames WHERE request_id % 17 <> 0
  UNION ALL SELECT request_id * 2 + 1, request_id, 1000, true FROM frames WHERE request_id % 5 = 0
  UNION ALL SELECT request_id * 2, -request_id, 3, true FROM frames WHERE request_id % 31 = 0
),
firsts AS (SELECT request_id, min(seq) AS acked_at, arg_min(affected_rows, seq) AS affected_rows, arg_min(ok, seq) AS ok FROM acks GROUP BY request_id),
joined AS (SELECT f.request_id, batch_id, acked_at, affected_rows, ok FROM frames f LEFT JOIN firsts USING (request_id))
"""
_ROLLUP_SQL = """
rolled AS (
  SELECT batch_id, frames, acked, failed, affected_rows, CASE WHEN acked < frames THEN 'pending' WHEN failed > 0 THEN 'failed' ELSE 'ok' END AS status FROM (
    SELECT batch_id, count(*) AS frames, count(acked_at) AS acked, count(*) FILTER (WHERE NOT ok) AS failed, coalesce(sum(affected_rows) FILTER (WHERE ok), 0)::BIGINT AS affected_rows FROM joined GROUP BY batch_id)
)
"""


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as batch_id", "l_orderkey * 8 + l_linenumber as request_id", "l_partkey as p")
    return ledger.dealt(rows, "request_id").groupBy("batch_id", "request_id").agg(F.min("p").alias("p"))


def _acks(frames: DataFrame) -> DataFrame:
    """Up to three acks of a frame, from one pass over the frames."""
    return frames.selectExpr("""inline(array_compact(array(
      if(request_id % 17 <> 0, named_struct('seq', request_id * 2, 'request_id', request_id, 'affected_rows', p % 50, 'ok', p % 97 <> 0), null),
      if(request_id % 5 = 0, named_struct('seq', request_id * 2 + 1, 'request_id', request_id, 'affected_rows', 1000L, 'ok', true), null),
      if(request_id % 31 = 0, named_struct('seq', request_id * 2, 'request_id', -request_id, 'affected_rows', 3L, 'ok', true), null))))""")


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir)
    return ledger.reconciled(frames.select("request_id", "batch_id"), _acks(frames))


@query(f"WITH {_FRAMES_SQL} SELECT request_id, batch_id, acked_at, affected_rows, ok FROM joined")
def ack_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir)


@query(f"WITH {_FRAMES_SQL} SELECT request_id, batch_id FROM joined WHERE acked_at IS NULL")
def ack_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir)
    return ledger.pending(frames.select("request_id", "batch_id"), _acks(frames))


@query(f"WITH {_FRAMES_SQL}, {_ROLLUP_SQL} SELECT * FROM rolled")
def ack_group_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.batch_rollup(_reconciled(spark, sf_dir))


@query(f"""WITH {_FRAMES_SQL},
refused AS (SELECT o_orderkey // 4 AS load_id, o_orderkey AS batch_id, 'row ' || o_custkey AS error FROM orders WHERE o_orderkey % 13 = 0),
per AS (SELECT batch_id // 4 AS load_id, count(DISTINCT batch_id) AS batches, count(*) FILTER (WHERE acked_at IS NULL) AS pending, min(request_id) FILTER (WHERE acked_at IS NULL) AS p,
  count(DISTINCT batch_id) FILTER (WHERE NOT ok) AS failed, min(batch_id) FILTER (WHERE NOT ok) AS f FROM joined GROUP BY ALL),
bad AS (SELECT load_id, count(*) AS rejected, min(batch_id) AS r, arg_min(error, batch_id) AS e FROM refused GROUP BY load_id),
joined_up AS (SELECT load_id, coalesce(batches, 0) AS batches, coalesce(pending, 0) AS pending, coalesce(rejected, 0) AS rejected, coalesce(failed, 0) AS failed, p, r, f, e FROM per FULL JOIN bad USING (load_id))
SELECT load_id, batches, pending, rejected, failed,
  CASE WHEN pending > 0 THEN 'pending' WHEN rejected > 0 THEN 'rejected' WHEN failed > 0 THEN 'failed' ELSE 'complete' END AS verdict,
  CASE WHEN pending > 0 THEN p WHEN rejected > 0 THEN r ELSE f END AS first_id, CASE WHEN pending > 0 THEN 'no ack' WHEN rejected > 0 THEN e WHEN failed > 0 THEN 'frame failed' END AS first_error
FROM joined_up""")
def bulk_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _reconciled(spark, sf_dir).withColumn("load_id", F.expr("batch_id div 4"))
    refused = table(spark, sf_dir, "orders").where("o_orderkey % 13 = 0").selectExpr("o_orderkey div 4 as load_id", "o_orderkey as batch_id", "'row ' || o_custkey as error")
    return ledger.verdict(found, refused, ("load_id",))


@query(f"""WITH {_FRAMES_SQL}, stop AS (SELECT min(seq) AS seq FROM acks WHERE request_id % 20011 = 20010),
heard AS (SELECT a.* FROM acks a, stop WHERE stop.seq IS NULL OR a.seq < stop.seq),
once AS (SELECT request_id, arg_min(affected_rows, seq) AS affected_rows FROM heard GROUP BY request_id)
SELECT (SELECT count(DISTINCT batch_id) FROM frames) AS total_requests,
  (SELECT coalesce(sum(affected_rows), 0)::BIGINT FROM once SEMI JOIN frames USING (request_id)) AS distinct_affected_rows,
  (SELECT coalesce(sum(affected_rows), 0)::BIGINT FROM heard) AS total_affected_rows""")
def bulk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _frames(spark, sf_dir)
    acks = _acks(frames).withColumn("well_formed", F.col("request_id") % 20011 != 20010)
    return ledger.summary(frames.select("request_id", "batch_id"), acks)


@query("""
WITH bodies AS (SELECT o_orderkey AS seq, o_custkey, CASE o_orderkey % 12
  WHEN 0 THEN '{"request_id":' || o_orderkey || ',"affected_rows":' || o_custkey || '}'
  WHEN 1 THEN '{"request_id":' || o_orderkey || '.0,"affected_rows":1e2}'
  WHEN 2 THEN '{"request_id":"' || o_orderkey || '","affected_rows":1}' WHEN 3 THEN '{"request_id":' || o_orderkey || '}'
  WHEN 4 THEN '{"request_id":' || o_orderkey || ',"affected_rows":1.5}' WHEN 5 THEN '{"request_id":' || o_orderkey || ',"affected_rows":-1}'
  WHEN 6 THEN '[' || o_orderkey || ',1]' WHEN 7 THEN '' WHEN 8 THEN 'not json' WHEN 9 THEN '{"request_id":' || o_orderkey || ',"affected_rows":null}'
  WHEN 10 THEN '{"request_id":' || o_orderkey || ',"affected_rows":9007199254740992}' ELSE '{"request_id":"x","affected_rows":7,"request_id":' || o_orderkey || '}' END AS body FROM orders)
SELECT seq, seq % 12 IN (0, 1, 11) AS well_formed, CASE WHEN seq % 12 IN (0, 1, 11) THEN seq END AS request_id, CASE seq % 12 WHEN 0 THEN o_custkey WHEN 1 THEN 100 WHEN 11 THEN 7 END AS affected_rows FROM bodies
""")
def ack_wellformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.expr("""CASE o_orderkey % 12
      WHEN 0 THEN '{"request_id":' || o_orderkey || ',"affected_rows":' || o_custkey || '}'
      WHEN 1 THEN '{"request_id":' || o_orderkey || '.0,"affected_rows":1e2}'
      WHEN 2 THEN '{"request_id":"' || o_orderkey || '","affected_rows":1}' WHEN 3 THEN '{"request_id":' || o_orderkey || '}'
      WHEN 4 THEN '{"request_id":' || o_orderkey || ',"affected_rows":1.5}' WHEN 5 THEN '{"request_id":' || o_orderkey || ',"affected_rows":-1}'
      WHEN 6 THEN '[' || o_orderkey || ',1]' WHEN 7 THEN '' WHEN 8 THEN 'not json' WHEN 9 THEN '{"request_id":' || o_orderkey || ',"affected_rows":null}'
      WHEN 10 THEN '{"request_id":' || o_orderkey || ',"affected_rows":9007199254740992}' ELSE '{"request_id":"x","affected_rows":7,"request_id":' || o_orderkey || '}' END""")
    acks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), body.alias("body"))
    return ledger.read_acks(acks).select("seq", "well_formed", "request_id", "affected_rows")


@query("""
SELECT event_id, kind, code, kind IN ('transport', 'server', 'timeout', 'bulk') AS aggressive, coalesce(kind = 'timeout' OR (kind = 'transport' AND code IN (2, 4, 8, 10, 14)), false) AS conservative
FROM (SELECT event_id, ['config','schema','value','state','transport','server','timeout','aborted','bulk','foreign'][(event_id % 10 + 1)::INTEGER] AS kind, CASE WHEN event_id % 3 > 0 THEN (user_id % 17)::INTEGER END AS code FROM events)
""")
def failure_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = "array('config','schema','value','state','transport','server','timeout','aborted','bulk','foreign')"
    log = table(spark, sf_dir, "events").selectExpr("event_id", f"element_at({kinds}, cast(event_id % 10 + 1 as int)) as kind", "if(event_id % 3 > 0, cast(user_id % 17 as int), null) as code")
    k, c = F.col("kind"), F.col("code")
    return log.select("event_id", "kind", "code", failures.retriable(k, c).alias("aggressive"), failures.retriable(k, c, "conservative").alias("conservative"))


@query("SELECT l_orderkey, l_linenumber, least(10000.0, 100.0 * pow(2.0, l_linenumber + 1))::DOUBLE AS delay_ms, true AS jitter_below FROM lineitem")
def backoff_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = failures.backoff(F.col("l_linenumber") + 1)
    jitter = failures.jittered(delay, 5)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", delay.alias("delay_ms"), ((jitter >= 0) & (jitter < delay)).alias("jitter_below"))


_BUCKET_SQL = "CASE WHEN {0} < 2048 THEN {0} ELSE ({0} >> (length(bin({0})) - 11)) << (length(bin({0})) - 11) END"
_LATENCY_SQL = f"""
WITH timed AS (SELECT l_returnflag AS mode, l_quantity::BIGINT AS rows, epoch_us(l_shipdate::TIMESTAMP) % 86400000000 + l_orderkey % 3000 * 1000 AS begun, (((l_partkey * 7919 % 104729) * l_linenumber / 8.0 + 0.25) * 1000)::BIGINT AS took FROM lineitem),
placed AS (SELECT *, least(600000, took // 1000)::BIGINT AS ms FROM timed),
hist AS (SELECT mode, {_BUCKET_SQL.format('ms')} AS bucket_ms, count(*) AS batches, sum(rows)::BIGINT AS rows, min(begun) AS begun_us, max(begun + took) AS done_us FROM placed GROUP BY ALL)
"""


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as batches that overlap: thousands begin within three seconds and take up to ten minutes."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_returnflag as mode", "cast(l_quantity as bigint) as rows", "unix_micros(cast(l_shipdate as timestamp)) % 86400000000 + l_orderkey % 3000 * 1000 as begun", "cast(((l_partkey * 7919 % 104729) * l_linenumber / 8.0D + 0.25D) * 1000 as bigint) as took")
    return rows.selectExpr("mode", "rows", "timestamp_micros(begun) as started", "timestamp_micros(begun + took) as ended")


@query(_LATENCY_SQL + "SELECT mode, bucket_ms, batches, rows, begun_us, done_us FROM hist")
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histograms of two halves of the batches, merged."""
    rows = _timed(spark, sf_dir)
    halves = [rows.where(x) for x in ("rows % 2 = 0", "rows % 2 <> 0")]
    return ledger.merged_histograms(["mode"], *(ledger.latency_histogram(x, ["mode"], "rows", "started", "ended") for x in halves))


@query(_LATENCY_SQL + """, run AS (SELECT *, sum(batches) OVER (PARTITION BY mode ORDER BY bucket_ms) AS upto, sum(batches) OVER (PARTITION BY mode) AS total,
  least(600000, CASE WHEN bucket_ms < 2048 THEN bucket_ms ELSE bucket_ms + (1 << (length(bin(bucket_ms)) - 11)) - 1 END) AS top FROM hist)
SELECT mode, sum(rows)::BIGINT AS rows, (max(done_us) - min(begun_us)) / 1000 AS elapsed_ms, sum(rows)::BIGINT / ((max(done_us) - min(begun_us)) / 1000 / 1000) AS rows_per_s,
  (min(top) FILTER (WHERE upto >= ceil(0.5 * total)))::DOUBLE AS p50_ms, (min(top) FILTER (WHERE upto >= ceil(0.95 * total)))::DOUBLE AS p95_ms, (min(top) FILTER (WHERE upto >= ceil(0.99 * total)))::DOUBLE AS p99_ms
FROM run GROUP BY mode""")
def throughput_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.throughput(ledger.latency_histogram(_timed(spark, sf_dir), ["mode"], "rows", "started", "ended"), ["mode"])


@query("""
WITH writes AS (SELECT *, l_orderkey // 5000 AS write_id FROM lineitem), exact AS (SELECT l_returnflag AS load, count(*) AS rows, count(DISTINCT (l_partkey, l_suppkey)) AS series FROM writes GROUP BY ALL)
SELECT load, rows, series AS exact_series, true AS within_2_percent FROM exact
""")
def sketched_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of each load from its writes' sketches, held against the exact number."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_returnflag as load", "l_orderkey div 5000 as write_id", "l_partkey", "l_suppkey")
    about = ledger.sketched_cardinality(ledger.series_sketches(rows, ["load", "write_id"], ["l_partkey", "l_suppkey"]), ["load"])
    exact = rows.groupBy("load").agg(F.count_distinct(F.struct("l_partkey", "l_suppkey")).alias("exact_series"))
    close = F.abs(F.col("series") - F.col("exact_series")) <= 0.02 * F.col("exact_series")
    return about.join(exact, "load").select("load", "rows", "exact_series", close.alias("within_2_percent"))


@query("SELECT count(*) AS series FROM (SELECT DISTINCT user_id, event_type FROM events)")
def series_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.series_cardinality(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("SELECT user_id, event_type, hour, value, event_id FROM (SELECT user_id, event_type, date_trunc('hour', ts) AS hour, value, event_id, row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"), "value", "event_id")
    return ledger.last_write_wins(rows, ["user_id", "event_type", "hour"], ["event_id"])


@query("SELECT o_orderkey AS settled_seq, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 100")
def newest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.newest(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("settled_seq"), "o_custkey"), 100)
