"""Streaming jobs over the event files, run until all input is processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spec import TableSpec, field, tag, timestamp
from ..streaming import jobs, timers
from .landing import POINT
from .reads import ALERTS_SQL, HOUR
from .registry import query, table


def _stream(spark: SparkSession, sf_dir: str, name: str, time: str) -> DataFrame:
    return jobs.file_stream(spark, f"{sf_dir}/{name}.parquet").withColumn(time, F.col(time).cast("timestamp"))


@query("SELECT count(*) AS affected_rows, count(*) AS stored_rows, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events")
def stream_write_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ledger = jobs.append_stream(_stream(spark, sf_dir, "events", "ts").select(*POINT.names), POINT)
    total = rows.agg(F.count("*").alias("stored_rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    return ledger.agg(F.sum("affected_rows").alias("affected_rows")).join(F.broadcast(total), F.lit(True))


@query("SELECT event_type, count(*) FILTER (WHERE user_id <= 127) AS accepted, count(*) FILTER (WHERE user_id > 127) AS dead FROM events GROUP BY event_type")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = TableSpec("small", (tag("user_id", "Int8"), tag("event_type"), field("value", "Float64"), timestamp("ts")))
    good, bad = jobs.quarantine_stream(_stream(spark, sf_dir, "events", "ts").select(*small.names), small)
    n = good.groupBy("event_type").agg(F.count("*").alias("accepted")).join(bad.groupBy("event_type").agg(F.count("*").alias("dead")), "event_type", "full")
    return n.select("event_type", F.coalesce("accepted", F.lit(0)).cast("long").alias("accepted"), F.coalesce("dead", F.lit(0)).cast("long").alias("dead"))


@query("SELECT user_id, event_type, date_trunc('hour', ts) AS hour, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(spark, sf_dir, "events", "ts").withColumn("hour", F.date_trunc("hour", "ts")).select("user_id", "event_type", "hour", "ts", "event_id")
    return jobs.earliest_stream(rows, "ts", ["user_id", "event_type", "hour"], "31 days")


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS events, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL")
def flow_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stream(spark, sf_dir, "events", "ts")
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return jobs.flow(rows, "ts", ["event_type"], "31 days", "6 hours", None, {"events": F.count("*"), "total": total})


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 6 HOUR AS window_start, event_type, count(*) AS events FROM events, (VALUES (0), (1)) AS t(k) GROUP BY ALL")
def flow_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.flow(_stream(spark, sf_dir, "events", "ts"), "ts", ["event_type"], "31 days", "12 hours", "6 hours", {"events": F.count("*")})


@query("SELECT event_id AS request_id, ts AS sent_at, CASE WHEN event_id % 17 <> 0 THEN ts + INTERVAL 30 SECOND END AS acked_at, CASE WHEN event_id % 17 <> 0 THEN value END AS value FROM events")
def ack_reconcile_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events", "ts")
    sent = events.select(F.col("event_id").alias("request_id"), F.col("ts").alias("sent_at"))
    acks = events.where("event_id % 17 <> 0").select(F.col("event_id").alias("request_id"), (F.col("ts") + F.expr("interval 30 seconds")).alias("acked_at"), "value")
    found = jobs.reconciled_stream(sent, acks, "5 minutes")
    every = table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col("ts").alias("sent_at"))
    pending = every.join(found.select("request_id"), "request_id", "left_anti")
    return found.unionByName(pending, allowMissingColumns=True)


#: The clock of the streams below stops here: what is due later stays open.
UNTIL = "2024-01-25 00:00:00"


@query(f"""
SELECT event_id AS request_id, epoch_us(ts) AS sent_us, CASE WHEN answered THEN epoch_us(ts) + took END AS acked_us, CASE WHEN answered THEN 'answered' ELSE 'timed_out' END AS state
FROM (SELECT *, event_id % 17 <> 0 AND took <= 300000000 AS answered FROM (SELECT *, (event_id % 7 + 1) * 50000000 AS took FROM events))
WHERE answered OR epoch_us(ts) + 300000000 < epoch_us(TIMESTAMP '{UNTIL}')
""")
def ack_timeout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests answered within five minutes, and those whose time ran out before the clock stopped."""
    events = _stream(spark, sf_dir, "events", "ts")
    sent = events.select(F.col("event_id").alias("request_id"), F.col("ts").alias("sent_at"))
    acks = events.where("event_id % 17 <> 0").select(F.col("event_id").alias("request_id"), (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, (event_id % 7 + 1) * 50)")).alias("acked_at"))
    return timers.answered_stream(sent, acks, 300_000_000, "31 days", F.lit(UNTIL))


@query(f"SELECT * FROM ({ALERTS_SQL}) WHERE ended_at IS NOT NULL AND ended_at < epoch_us(TIMESTAMP '2024-03-01')")
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ended episodes, from the stream."""
    return timers.alert_stream(_stream(spark, sf_dir, "events", "ts"), ["event_type"], "ts", F.col("value") > 40, HOUR // 2, 2 * HOUR, "31 days", F.lit("2024-03-01"), 24 * HOUR)
