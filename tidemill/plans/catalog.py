"""SQL, views and catalog calls over tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mutate import Change
from ..operators.spec import TableSpec, field, tag, timestamp
from ..sources import catalog, parts, versions
from ..sources.series import SeriesTable
from ..sources.store import TableStore, scratch_folder
from .registry import query, table

DAILY = TableSpec("daily", (tag("event_type"), field("events", "Int64"), field("total", "Float64"), timestamp("ts", "second")))


def over(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """The rows of ``sql``, in which ``{name}`` stands for each of ``tables``."""
    return spark.sql(sql, **tables)


def insert_from(store: TableStore, spec: TableSpec, rows: DataFrame) -> int:
    """Conform the rows of a query to ``spec`` and append them; how many."""
    return store.write([(spec, rows)])[spec.name]


@query("SELECT c_mktsegment, n_name, count(*) AS orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def sql_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT c_mktsegment, n_name, count(*) AS orders, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS total FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY c_mktsegment, n_name"
    return over(spark, sql, **{n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")})


@query("SELECT event_type, count(*) AS events, sum(value::DECIMAL(18,2))::DOUBLE AS total, date_trunc('day', ts)::TIMESTAMP AS ts FROM events GROUP BY ALL")
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(spark, scratch_folder(spark, "daily"))
    sql = "SELECT event_type, count(*) AS events, cast(sum(cast(value AS decimal(18,2))) AS double) AS total, date_trunc('day', ts) AS ts FROM {events} GROUP BY event_type, date_trunc('day', ts)"
    insert_from(store, DAILY, over(spark, sql, events=table(spark, sf_dir, "events")))
    return store.read("daily")


def _database(spark: SparkSession) -> str:
    name = f"tidemill_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, location=scratch_folder(spark, "db"), options={"purpose": "query"})
    return name


READING = TableSpec("reading", (tag("user_id", "Int64"), field("event_type", "String"), field("value", "Float64"), timestamp("ts", "microsecond")))


def _stored(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(database, table) with the rows of ``events`` as readings."""
    base = _database(spark)
    catalog.create_table(spark, f"{base}.reading", READING, options={"ttl.days": "30"}, comment="what was read", comments={"value": "as measured"})
    catalog.insert(spark, f"{base}.reading", READING, table(spark, sf_dir, "events").select(*READING.names))
    return base, f"{base}.reading"


@query("SELECT event_type, count(*) AS events, max(value) AS most FROM events WHERE value > 50 GROUP BY event_type")
def view_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, name = _stored(spark, sf_dir)
    catalog.create_view(spark, f"{base}.high", f"SELECT * FROM {name} WHERE value > 50")
    return spark.sql(f"SELECT event_type, count(*) AS events, max(value) AS most FROM {base}.high GROUP BY event_type")


@query("""
SELECT column_name, spark_type, semantic, type, comment, '30' AS ttl, (SELECT count(*) FROM events) AS rows FROM (VALUES
  ('user_id', 'bigint', 'tag', 'Int64', NULL), ('event_type', 'string', 'field', 'String', NULL), ('value', 'double', 'field', 'Float64', 'in units'), ('ts', 'timestamp', 'timestamp', 'TimestampMicrosecond', NULL)
) AS t(column_name, spark_type, semantic, type, comment)
""")
def create_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, name = _stored(spark, sf_dir)
    catalog.comment_on(spark, name, "in units", "value")
    rows = spark.table(name).agg(F.count("*").alias("rows"))
    return catalog.described(spark, name).withColumn("ttl", F.lit(catalog.options_of(spark, name)["ttl.days"])).join(F.broadcast(rows), F.lit(True))


@query("SELECT 'eu' AS site, user_id, value::FLOAT AS value, 'none' AS grade, NULL::BIGINT AS more, ts, '30d' AS ttl, 'what was read' AS note, 'as measured' AS value_note FROM events UNION ALL SELECT 'us', 7, 1.5::FLOAT, 'late', 5, TIMESTAMP '2024-02-01', '30d', 'what was read', 'as measured'")
def evolve_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, name = _stored(spark, sf_dir)
    catalog.set_options(spark, name, {"ttl": "30d"})
    change = Change
    spec = catalog.evolve_table(spark, name, READING, [change("add", "more", field("more", "Int64"))])
    spec = catalog.evolve_table(spark, name, spec, [
        change("add", "site", tag("site"), first=True), change("drop", "event_type"), change("retype", "value", type="Float32"),
        change("add", "grade", field("grade", "String"), after="value"), change("default", "grade", default="none"), change("default", "site", default="eu"),
    ], rename=f"{base}.reading_2")
    name = f"{base}.reading_2"
    spec = catalog.evolve_table(spark, name, spec, [change("default", "site", default="us"), change("default", "grade", default="late")])
    catalog.insert(spark, name, spec, spark.range(1).selectExpr("7L as user_id", "1.5D as value", "5L as more", "timestamp'2024-02-01' as ts"))
    return spark.table(name).select("site", "user_id", "value", "grade", "more", "ts", *_notes(spark, name, catalog.options_of(spark, name)))


def _notes(spark: SparkSession, name: str, options: dict[str, str]) -> list[Column]:
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    return [F.lit(options.get("ttl")).alias("ttl"), F.lit(spark.catalog.getTable(name).description).alias("note"), F.lit(comments["value"]).alias("value_note")]


@query("""
SELECT user_id, value::FLOAT AS value, grade, more, ts, '30d' AS ttl, 'what was read' AS note, 'as measured' AS value_note, true AS files_kept FROM (
  SELECT user_id, value, 'none' AS grade, NULL::BIGINT AS more, ts FROM events
  UNION ALL SELECT user_id, value, CASE WHEN event_id % 2 = 0 THEN 'late' ELSE event_type END, event_id, ts FROM events WHERE event_id % 3 = 0)
""")
def evolve_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written under three declarations, read under the last one, with the files of the first as they were."""
    base, change, rows = _database(spark), Change, table(spark, sf_dir, "events")
    name = f"{base}.reading"
    versions.create(spark, name, READING, {"ttl": "30d"}, "what was read", {"value": "as measured", "event_type": "a kind"})
    versions.insert(spark, name, rows.where("event_id % 2 = 0").select(*READING.names))
    first = sorted(spark.table(name).inputFiles())
    versions.alter(spark, name, [change("add", "grade", field("grade", "String", default="none"), after="value"), change("drop", "event_type"), change("retype", "value", type="Float32")])
    versions.insert(spark, name, rows.where("event_id % 2 <> 0").select("user_id", "value", "ts"))
    versions.alter(spark, name, [change("default", "grade", default="late"), change("add", "more", field("more", "Int64"), first=True)], rename=f"{base}.renamed")
    name = f"{base}.renamed"
    versions.insert(spark, name, rows.where("event_id % 3 = 0").selectExpr("user_id", "value", "if(event_id % 2 = 0, null, event_type) as grade", "event_id as more", "ts"))
    kept = set(first) <= set(spark.table(name).inputFiles())
    return spark.table(name).select("user_id", "value", "grade", "more", "ts", *_notes(spark, name, versions.options_of(spark, name)), F.lit(kept).alias("files_kept"))


@query("""
SELECT part, count(*) AS rows, sum(value::DECIMAL(18,2))::DOUBLE AS total, part = 'low' AS files_kept FROM (
  SELECT value, CASE WHEN value < 20 THEN 'low' WHEN event_type IN ('view', 'click') THEN 'looks' ELSE 'acts' END AS part FROM events) GROUP BY part
""")
def repartition_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored parts by value; the upper two are merged, and split anew by kind."""
    name = f"{_database(spark)}.parted"
    parts.create(spark, name, READING, {"low": "value < 20", "middle": "value >= 20 and value < 60", "high": "value >= 60"})
    parts.insert(spark, name, READING, table(spark, sf_dir, "events").select(*READING.names))
    before = set(spark.table(name).inputFiles())
    parts.repartition(spark, name, ["middle", "high"], {"upper": "value >= 20"})
    parts.repartition(spark, name, ["upper"], {"looks": "value >= 20 and event_type in ('view', 'click')", "acts": "value >= 20 and event_type not in ('view', 'click')"})
    rows = spark.table(name)
    kept = sorted({f.rpartition("part=")[2].partition("/")[0] for f in before & set(rows.inputFiles())})
    return rows.groupBy("part").agg(F.count("*").alias("rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")).withColumn("files_kept", F.col("part").isin(kept) if kept else F.lit(False))


def _series(spark: SparkSession, sf_dir: str) -> SeriesTable:
    """Events as series, those of hours written twice with other values the second time."""
    spec = TableSpec("sampled", (tag("user_id", "Int64"), tag("event_type"), field("value", "Float64"), timestamp("ts", "microsecond")))
    made = SeriesTable(spark, f"{_database(spark)}.sampled", spec)
    made.create(buckets=8)
    rows = table(spark, sf_dir, "events")
    made.write(rows.select(*spec.names))
    made.write(rows.where("event_id % 3 = 0").withColumn("value", F.col("value") + 1000).select(*spec.names))
    return made


_TWICE_SQL = """
written AS (SELECT user_id, event_type, value, ts, 1 AS seq FROM events UNION ALL SELECT user_id, event_type, value + 1000, ts, 2 FROM events WHERE event_id % 3 = 0),
lasting AS (SELECT user_id, event_type, ts, arg_max(value, (seq, value)) AS value FROM written GROUP BY ALL)
"""


@query(f"WITH {_TWICE_SQL} SELECT user_id, event_type, ts, value FROM lasting")
def series_last_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir).last_writes().select("user_id", "event_type", "ts", "value")


@query(f"WITH {_TWICE_SQL} SELECT user_id, event_type, max(ts) AS ts, arg_max(value, (ts, value)) AS value FROM lasting WHERE ts <= TIMESTAMP '2024-01-20' AND ts > TIMESTAMP '2024-01-17' GROUP BY ALL")
def series_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _series(spark, sf_dir)
    made.compact()
    return made.instant("value", F.lit("2024-01-20").cast("timestamp"), 72 * 3_600_000_000)


@query("""
WITH gone AS (SELECT DISTINCT c_custkey AS user_id FROM customer WHERE c_custkey % 3 = 0),
first AS (SELECT user_id, event_type, value, ts FROM events WHERE user_id NOT IN (SELECT user_id FROM gone) AND NOT (event_type = 'view' AND event_id % 2 = 0)),
kept AS (SELECT * FROM first UNION ALL SELECT user_id, event_type, value + 1000, ts FROM events WHERE event_type = 'click')
SELECT stage, event_type, count(*) AS rows, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM (
  SELECT 'log' AS stage, * FROM kept UNION ALL SELECT 'compact', user_id, event_type, max(value), ts FROM kept GROUP BY user_id, event_type, ts) GROUP BY ALL
""")
def delete_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write, delete whole series and single samples, write some of them again, and read, from the log and after compaction."""
    spec = TableSpec("logged", (tag("user_id", "Int64"), tag("event_type"), field("value", "Float64"), timestamp("ts", "microsecond")))
    made, events = SeriesTable(spark, f"{_database(spark)}.logged", spec), table(spark, sf_dir, "events")
    made.create(buckets=8)
    made.write(events.select(*spec.names))
    users = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"))
    made.delete(events.join(users, "user_id", "left_semi").select("user_id", "event_type").distinct())
    made.delete(events.where("event_type = 'view' and event_id % 2 = 0").select("user_id", "event_type", "ts"))
    made.write(events.where("event_type = 'click'").withColumn("value", F.col("value") + 1000).select(*spec.names))
    total = lambda rows, stage: rows.groupBy(F.lit(stage).alias("stage"), "event_type").agg(F.count("*").alias("rows"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    at = scratch_folder(spark, "logged")
    total(made.rows(), "log").write.parquet(at)  # what the log says, before compaction takes its files
    made.compact()
    return spark.read.parquet(at).union(total(made.rows(), "compact"))
