import datetime
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemill.functions.coerce import coerced
from tidemill.functions.types import SchemaError
from tidemill.operators import ledger, mutate
from tidemill.operators.mutate import Change
from tidemill.operators.spec import TableSpec, field, tag, timestamp
from tidemill.plans import catalog as catalog_plans
from tidemill.sources import catalog, generate, parts, versions
from tidemill.sources.series import SeriesTable, live
from tidemill.sources.store import TableStore, scratch_folder
from tidemill.streaming import jobs, timers

SPEC = TableSpec("m", (tag("host"), field("usage", "Float64"), timestamp("ts", "microsecond")))


@pytest.fixture(scope="module")
def base(spark):
    name = f"tables_{os.getpid()}"
    catalog.create_database(spark, name, location=scratch_folder(spark, "db"))
    yield name
    catalog.drop(spark, "database", name, cascade=True)


def points(spark, n=10, **more):
    return spark.range(n).selectExpr("concat('h', id % 3) as host", "cast(id as double) as usage", "timestamp_seconds(id) as ts").withColumns(more)


# Reports


def test_latency_buckets_hold_three_digits(spark):
    r = random.Random(1)
    ms = [0.0, 0.9, 1.0, 2047.0, 2048.0, 2049.9, 4095.0, 4096.0, 599_999.0, 600_000.0, 1e9, -5.0] + [10 ** r.uniform(0, 5.7) for _ in range(500)]
    got = spark.createDataFrame([(x,) for x in ms], "ms double").select("ms", ledger.latency_bucket(F.col("ms")).alias("b")).collect()
    for x, b in got:
        want = min(max(math.floor(x), 0), 600_000)
        assert b <= want < b + max(1, 2 ** (b.bit_length() - 11)) and want - b <= want / 1000


def test_throughput_of_overlapping_batches(spark):
    rows = [("a", 1000, 0, 1000)] * 8 + [("a", 0, 500, 700), ("b", 5, 10, 10), ("b", 7, 20, None)]
    df = spark.createDataFrame(rows, "mode string, n long, s long, e long").selectExpr("mode", "n", "timestamp_millis(s) as s", "timestamp_millis(e) as e")
    got = {r["mode"]: r for r in ledger.throughput(ledger.latency_histogram(df, ["mode"], "n", "s", "e"), ["mode"]).collect()}
    assert (got["a"]["rows"], got["a"]["elapsed_ms"], got["a"]["rows_per_s"], got["a"]["p50_ms"]) == (8000, 1000.0, 8000.0, 1000.0)
    assert (got["b"]["rows"], got["b"]["elapsed_ms"], got["b"]["rows_per_s"], got["b"]["p99_ms"]) == (5, 0.0, None, 0.0)
    assert ledger.throughput(ledger.latency_histogram(df.limit(0), ["mode"], "n", "s", "e"), ["mode"]).count() == 0


def test_percentiles_are_within_a_thousandth_and_halves_merge(spark):
    r = random.Random(2)
    ms = sorted(10 ** r.uniform(0, 5.7) for _ in range(3000))
    df = spark.createDataFrame([(k, round(x * 1000)) for k, x in enumerate(ms)], "k long, us long").selectExpr("k", "1 as n", "timestamp_micros(0) as s", "timestamp_micros(us) as e")
    whole = ledger.latency_histogram(df, [], "n", "s", "e")
    halves = ledger.merged_histograms([], *(ledger.latency_histogram(df.where(x), [], "n", "s", "e") for x in ("k % 2 = 0", "k % 2 = 1")))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, halves.collect()))
    got = ledger.throughput(halves, []).first()
    for share, name in ((0.5, "p50_ms"), (0.95, "p95_ms"), (0.99, "p99_ms")):
        exact = math.floor(ms[math.ceil(share * len(ms)) - 1])
        assert exact <= got[name] <= exact * 1.001 + 1e-9


def test_sketches_of_any_writes(spark):
    rows = spark.range(30_000).selectExpr("id % 7 as w", "concat('h', id % 5000) as host", "if(id % 11 = 0, null, id % 3) as k")
    sketches = ledger.series_sketches(rows, ["w"], ["host", "k"])
    for writes in ([0], [1, 2], list(range(7))):
        some = rows.where(F.col("w").isin(writes))
        exact = ledger.series_cardinality(some, ["host", "k"]).first()[0]
        about = ledger.sketched_cardinality(sketches.where(F.col("w").isin(writes))).first()
        assert about["rows"] == some.count() and abs(about["series"] - exact) <= 0.02 * exact
    clash = spark.createDataFrame([("a", "b:c"), ("a:b", "c"), (None, "-"), ("-", None)], "x string, y string")
    assert ledger.sketched_cardinality(ledger.series_sketches(clash, [], ["x", "y"])).first()["series"] == 4


# Cells


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_dates_and_times_do_not_follow_the_session(spark, zone, name):
    zone(name)
    df = spark.sql("select timestamp_micros(1704067200000000) as a, timestamp_micros(-1500000) as b, timestamp_ntz'2024-03-10 02:30:00.25' as n, date'1969-12-31' as d")

    def one(column, target):
        value, reason = coerced(F.col(column), df.schema[column].dataType, target)
        number = F.unix_date(value) if target == "Date" else F.unix_micros(value) if target != "TimestampNanosecond" else value
        return tuple(df.select(number, reason).first())

    assert one("a", "Date") == (19723, None) and one("b", "Date") == (-1, None) and one("n", "Date") == (19792, None) and one("d", "Date") == (-1, None)
    assert one("b", "TimestampSecond") == (-1_000_000, None) and one("n", "TimestampMicrosecond") == (1_710_037_800_250_000, None) and one("d", "TimestampMillisecond") == (-86_400_000_000, None)
    assert one("n", "TimestampNanosecond") == (1_710_037_800_250_000_000, None)
    text, _ = coerced(F.col("a"), df.schema["a"].dataType, "Json")
    assert df.select(text).first()[0] == '"2024-01-01T00:00:00.000Z"'


def test_json_texts(spark):
    df = spark.sql("""select double('nan') as nan, array(double('inf'), 1.5D, null, 2D) as a, map('k', double('-inf'), 'é"', 0.1D) as m,
      named_struct('at', timestamp_micros(-1), 'd', date'2024-02-29', 'n', null, 's', 'x"y', 'b', true, 'deep', array(named_struct('f', float('nan'), 'g', float(0.1)))) as s,
      array(1e21D, 1e20D, 12345678.5D, 1e-6D, 1.5e-7D, -0.0D, 123456789012D, 0.00012D, 1e-7D, 3.0D) as numbers, 'as {is' as t, cast(null as double) as none, 7L as i, unhex('6162') as raw""")

    def one(name, profile="row"):
        return df.select(coerced(F.col(name), df.schema[name].dataType, "Json", profile)[0]).first()[0]

    assert one("nan") == "null" and one("a") == "[null,1.5,null,2]" and one("m") == '{"k":null,"é\\"":0.1}' and one("none") is None and one("i") == "7" and one("t") == "as {is"
    assert one("s") == '{"at":"1969-12-31T23:59:59.999Z","d":"2024-02-29T00:00:00.000Z","n":null,"s":"x\\"y","b":true,"deep":[{"f":null,"g":0.1}]}'
    assert one("numbers") == "[1e+21,100000000000000000000,12345678.5,0.000001,1.5e-7,0,123456789012,0.00012,1e-7,3]"
    assert bytes(one("m", "bulk")).decode() == one("m") and bytes(one("t", "bulk")) == b"as {is"
    assert df.select(coerced(F.col("raw"), df.schema["raw"].dataType, "Json")[1]).first()[0] == "type:binary"


def test_bulk_load_keeps_json_as_text_and_acknowledges_empty_batches(spark):
    spec = TableSpec("j", (tag("host"), field("doc", "Json", default="{}"), timestamp("ts")))
    store = TableStore(spark, scratch_folder(spark, "j"))
    store.create(spec)
    rows = points(spark).select("host", F.when(F.col("usage") > 4, F.struct("usage")).alias("doc"), "ts", (F.col("usage") % 2).cast("long").alias("b"))
    got = store.bulk_load(rows, spec, "b", announced=spark.range(4).withColumnRenamed("id", "batch_id"))
    assert {r["batch_id"]: r["affected_rows"] for r in got.collect()} == {0: 5, 1: 5, 2: 0, 3: 0}
    assert {r["doc"] for r in store.read("j").collect()} == {"{}", *('{"usage":%d}' % k for k in range(5, 10))}
    assert [c.name for c in generate.LOG.columns if c.semantic == "tag"] == ["service", "host", "region", "env"]


def test_hints_reach_the_writer(spark):
    store = TableStore(spark, scratch_folder(spark, "h"))
    with pytest.raises(Exception, match="nonesuch"):
        store.write([(SPEC, points(spark))], codec="nonesuch")
    assert store.write([(SPEC, points(spark))], hints={"maxRecordsPerFile": "1"}) == {"m": 10} and len(store.read("m").inputFiles()) == 10


def test_kinds_of_clashing_columns_are_written_once(spark):
    store = TableStore(spark, scratch_folder(spark, "k"))
    rows = points(spark, 30, kind=F.concat(F.lit("k "), (F.col("usage") % 4).cast("int").cast("string")))
    specs = {
        "k 0": SPEC, "k 1": TableSpec("one", (timestamp("ts", "microsecond"), field("usage", "Float32"), field("none", "Int8"))),
        "k 2": TableSpec("two", (timestamp("at", source="ts"), field("Usage", "Float64", source="usage"))), "k 3": TableSpec("m", SPEC.columns), "k 9": TableSpec("nine", SPEC.columns),
    }
    assert store.write_kinds(rows, "kind", specs) == {"m": 15, "one": 8, "two": 7, "nine": 0}
    assert store.read("m").count() == 15 and store.read("one").columns == ["ts", "usage", "none"] and store.read("two").where("Usage % 4 = 2").count() == 7 and store.read("nine").count() == 0
    with pytest.raises(SchemaError):
        store.write_kinds(rows, "kind", specs | {"k 1": TableSpec("one", SPEC.columns)})


# Stored tables


def test_rewrite_keeps_what_users_set(spark, base):
    name, spec = f"{base}.kept", TableSpec("kept", (tag("host"), field("usage", "Float64", default=1.5), timestamp("ts", "microsecond")))
    catalog.create_table(spark, name, spec, options={"ttl": "30d", "x.y": "1"}, comment="a table", comments={"usage": "in percent", "host": "a host"})
    catalog.insert(spark, name, spec, points(spark, 3))
    spec = catalog.evolve_table(spark, name, spec, [Change("add", "n", field("n", "Int32", default=7)), Change("retype", "usage", type="Float32")])
    assert {k: catalog.options_of(spark, name).get(k) for k in ("ttl", "x.y")} == {"ttl": "30d", "x.y": "1"} and spark.catalog.getTable(name).description == "a table"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)} == {"host": "a host", "usage": "in percent", "n": None, "ts": None} and not spark.catalog.tableExists(f"{name}__old")
    catalog.insert(spark, name, spec, points(spark, 2).drop("usage"))
    assert sorted((r["usage"], r["n"]) for r in spark.table(name).collect()) == [(0.0, 7), (1.0, 7), (1.5, 7), (1.5, 7), (2.0, 7)]
    files = set(spark.table(name).inputFiles())
    spec = catalog.evolve_table(spark, name, spec, [Change("default", "n", default=8), Change("add", "late", field("late", "String"))])
    catalog.insert(spark, name, spec, points(spark, 1))
    spark.sql(f"INSERT INTO {name} (host, ts) VALUES ('q', timestamp'2024-01-01')")
    assert files <= set(spark.table(name).inputFiles()) and sorted(r["n"] for r in spark.table(name).collect()) == [7] * 5 + [8] * 2
    assert spark.table(name).where("host = 'q' and usage = 1.5 and late is null").count() == 1


def test_versions_read_old_files_under_the_new_declaration(spark, base):
    name = f"{base}.versioned"
    versions.create(spark, name, SPEC, {"ttl": "1d"}, "noted", {"usage": "u", "host": "h"})
    versions.insert(spark, name, points(spark, 2).withColumn("usage", F.when(F.col("usage") > 0, F.col("usage"))))
    with pytest.raises(SchemaError):
        versions.create(spark, name, SPEC)
    files = set(spark.table(name).inputFiles())
    versions.alter(spark, name, [Change("add", "n", field("n", "Int32", default=7), first=True), Change("default", "usage", default=9.5)])
    versions.insert(spark, name, points(spark, 1).drop("usage"))
    assert sorted(((r["n"], r["usage"]) for r in spark.table(name).collect()), key=repr) == [(7, 1.0), (7, 9.5), (7, None)]
    with pytest.raises(SchemaError, match="usage"):
        versions.alter(spark, name, [Change("retype", "usage", type="Int8")])
    with pytest.raises(SchemaError, match="rewrite"):
        versions.alter(spark, name, [Change("retype", "ts", type="TimestampNanosecond")])
    versions.alter(spark, name, [Change("drop", "usage")])
    versions.alter(spark, name, [Change("add", "usage", field("usage", "String", default="new")), Change("retype", "n", type="Int64"), Change("default", "n", default=8)])
    versions.insert(spark, name, points(spark, 1).drop("usage"))
    assert spark.table(name).dtypes == [("n", "bigint"), ("host", "string"), ("ts", "timestamp"), ("usage", "string")]
    assert sorted((r["n"], r["usage"]) for r in spark.table(name).collect()) == [(7, "new")] * 3 + [(8, "new")]
    versions.set_options(spark, name, {"ttl": "2d", "more": "x"})
    versions.comment_on(spark, name, "time", "ts")
    versions.comment_on(spark, name, "noted again")
    versions.alter(spark, name, [Change("retype", "n", type="Float64")], rename=f"{base}.moved")
    name = f"{base}.moved"
    assert versions.options_of(spark, name) == {"ttl": "2d", "more": "x"} and spark.catalog.getTable(name).description == "noted again"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)} == {"n": None, "host": "h", "ts": "time", "usage": None}
    assert files <= set(spark.table(name).inputFiles()) and len(versions.versions(spark, name)) == 5 and versions.declared(spark, name).names == ["n", "host", "ts", "usage"]
    with pytest.raises(SchemaError):
        versions.comment_on(spark, name, "?", "zz")
    versions.drop(spark, name)
    assert not spark.catalog.tableExists(name) and not [t for t in spark.catalog.listTables(base) if t.name.startswith("versioned__")]


def test_parts_split_and_merge(spark, base):
    name = f"{base}.parted"
    parts.create(spark, name, SPEC, {"low": "usage < 3", "high": "usage >= 3", "none": "usage is null"})
    parts.insert(spark, name, SPEC, points(spark))
    low = {f for f in spark.table(name).inputFiles() if "part=low" in f}
    before = sorted(map(tuple, spark.table(name).collect()))
    for old, into in ((["high"], {"a": "usage < 6"}), (["high"], {"a": "usage < 6", "b": "usage >= 5"}), (["high"], {"low": "true"}), (["zz"], {"a": "true"}), ([], {"a": "true"}), (["high"], {})):
        with pytest.raises(SchemaError):
            parts.repartition(spark, name, old, into)
    assert sorted(map(tuple, spark.table(name).collect())) == before and set(parts.rules_of(spark, name)) == {"low", "high", "none"}
    parts.repartition(spark, name, ["high"], {"high": "usage >= 3 and usage < 6", "top": "usage >= 6"})
    assert {r["part"]: r["count"] for r in spark.table(name).groupBy("part").count().collect()} == {"low": 3, "high": 3, "top": 4}
    assert low == {f for f in spark.table(name).inputFiles() if "part=low" in f}
    parts.repartition(spark, name, ["top", "high", "none"], {"rest": "usage >= 3 or usage is null"})
    assert {r["part"]: r["count"] for r in spark.table(name).groupBy("part").count().collect()} == {"low": 3, "rest": 7} and parts.rules_of(spark, name)["rest"].startswith("usage >= 3")
    parts.insert(spark, name, SPEC, points(spark, 1).withColumn("usage", F.lit(None).cast("double")))
    assert spark.table(name).where("part = 'rest'").count() == 8 and low <= set(spark.table(name).inputFiles())


def test_series_reads_shuffle_nothing(spark, base):
    made = SeriesTable(spark, f"{base}.series", SPEC)
    made.create(buckets=4)
    for more in (0, 100):
        made.write(points(spark, 40).withColumn("usage", F.col("usage") + more))
    reads = made.last_writes(), made.instant("usage", F.timestamp_seconds(F.lit(20)), 10**9)
    for df in reads:
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r["usage"] for r in reads[0].collect()} == {float(k + 100) for k in range(40)} and {r["host"]: r["usage"] for r in reads[1].collect()} == {"h0": 118.0, "h1": 119.0, "h2": 120.0}
    made.compact()
    after = made.last_writes()
    assert "Exchange" not in after._jdf.queryExecution().executedPlan().toString() and made.rows().count() == 40 == after.count()


def test_deleted_keys_live_when_written_again(spark, base):
    made = SeriesTable(spark, f"{base}.deletes", SPEC)
    made.create(buckets=2)
    rows = points(spark, 6).union(spark.sql("select cast(null as string), 50D, timestamp_seconds(1)"))
    made.write(rows)
    made.delete(spark.createDataFrame([("h0",), (None,)], "host string"))
    made.delete(spark.sql("select 'h1' as host, timestamp_seconds(4) as ts"))
    assert sorted(r["usage"] for r in made.rows().collect()) == [1.0, 2.0, 5.0]
    made.write(spark.sql("select cast(null as string) as host, 51D as usage, timestamp_seconds(1) as ts"))
    made.delete(spark.sql("select 'h2' as host, timestamp_seconds(2) as ts union all select 'zz', timestamp_seconds(2)"))
    for _ in range(2):
        assert sorted((r["usage"], r["host"]) for r in made.rows().collect()) == [(1.0, "h1"), (5.0, "h2"), (51.0, None)]
        made.compact()
    made.write(points(spark, 1))
    assert made.rows().count() == 4
    with pytest.raises(ValueError):
        made.delete(rows.select("usage"))
    with pytest.raises(ValueError):
        SeriesTable(spark, f"{base}.tagless", TableSpec("t", (timestamp("ts"),))).create()
    none = live(rows.withColumn("s", F.lit(1)), rows.select("host").withColumn("s", F.lit(1)).limit(0), ["host"], "s")
    assert none.count() == 7


def test_many_ranges_equal_one_by_one(spark, monkeypatch):
    r = random.Random(9)
    for buckets in (4, 64, 1 << 18):
        monkeypatch.setattr(mutate, "BUCKETS", buckets)
        ranges = [(a, a + r.choice([0, 1, 5, 300, -4])) for a in (r.randrange(-500, 3000) for _ in range(60))] + [(None, 5), (10, 12), (10, 12)]
        times = [*range(-600, 3400), None]
        df = spark.createDataFrame([(k, t) for k, t in enumerate(times)], "k long, s long").selectExpr("k", "timestamp_millis(s) as ts", "1 as bucket")
        got = {x["k"] for x in mutate.truncated_by(df, "ts", spark.createDataFrame(ranges, "start long, end long")).collect()}
        assert got == {k for k, t in enumerate(times) if t is None or not any(a is not None and a <= t < b for a, b in ranges)}
    empty = spark.createDataFrame([], "start long, end long")
    assert mutate.truncated_by(df, "ts", empty).count() == 0 and mutate.truncated_by(df, "ts", spark.createDataFrame([(5, 5)], "start long, end long")).count() == len(times)


def test_a_hundred_thousand_ranges_are_one_join(spark):
    ranges = spark.range(100_000).selectExpr("1704067200000 + id * 25000 as start", "1704067200000 + id * 25000 + 9000 as end")
    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", "cast(ts as timestamp) as ts")
    left = mutate.truncated_by(events, "ts", ranges)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = events.where("(unix_millis(ts) - 1704067200000) % 25000 >= 9000 or unix_millis(ts) >= 1704067200000 + 100000 * 25000L")
    assert left.count() == want.count()


# Streams


def mixed_files(spark, path, frames):
    """Each frame as a file, to be read in this order."""
    for k, df in enumerate(frames):
        df.coalesce(1).write.parquet(f"{path}/w{k}")
        for f in (path / f"w{k}").glob("part-*.parquet"):
            (path / "in").mkdir(exist_ok=True)
            f.rename(path / "in" / f"{k}.parquet")
            os.utime(path / "in" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return f"{path}/in"


def test_requests_time_out_on_the_stream(spark, tmp_path):
    second = 10**6
    sent = [(k, 100 * k) for k in range(1, 41)]
    acks = [(k, 100 * k + (20 if k % 3 else 90)) for k in range(1, 41) if k % 5] + [(k, 100 * k + 25) for k in range(7, 41, 7) if k % 5] + [(900, 50), (None, 60)]
    rows = [(k, s, False) for k, s in sent] + [(k, s, True) for k, s in acks]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "request_id long, s long, ack boolean").withColumn("at", F.timestamp_seconds("s"))
    files = mixed_files(spark, tmp_path, [df.where(F.pmod(F.hash("request_id", "ack", "s"), F.lit(4)) == k) for k in range(4)])
    stream = lambda: jobs.file_stream(spark, files, files_per_batch=1)
    requests = stream().where("not ack").select("request_id", F.col("at").alias("sent_at"))
    heard = stream().where("ack").select("request_id", F.col("at").alias("acked_at"))
    got = timers.answered_stream(requests, heard, 60 * second, "2 hours", F.lit("1970-01-01 00:50:00")).collect()
    first = {}
    for k, s in acks:
        if k in dict(sent) and s <= 100 * k + 60:
            first.setdefault(k, set()).add(s)
    state = {r["request_id"]: r for r in got}
    assert len(state) == len(got)
    assert {k for k, r in state.items() if r["state"] == "answered"} == set(first) and all(state[k]["acked_us"] // second in v for k, v in first.items())
    late = {k for k, s in sent if k not in first and s + 60 < 3000}
    assert {k for k, r in state.items() if r["state"] == "timed_out"} == late and late
    batch = ledger.pending(spark.createDataFrame(sent, "request_id long, s long"), spark.createDataFrame([(k,) for k in first], "request_id long")).where("s + 60 < 3000")
    assert late == {r["request_id"] for r in batch.collect()}


def test_requests_are_settled_without_a_call_by_request(spark, tmp_path, monkeypatch):
    def refuse(*_):
        raise AssertionError("a stateful processor for each request")

    monkeypatch.setattr("pyspark.sql.GroupedData.transformWithState", refuse)
    big = 2**53
    rows = [(big + 1, 10, False), (big + 2, 10, False), (big + 3, 40, False), (big + 1, 70, True), (big + 2, 71, True), (big + 9, 20, True)]
    df = spark.createDataFrame(rows, "request_id long, s long, ack boolean").withColumn("at", F.timestamp_seconds("s"))
    files = mixed_files(spark, tmp_path, [df.where("ack"), df.where("not ack")])  # answers come first
    stream = lambda: jobs.file_stream(spark, files, files_per_batch=1)
    got = timers.answered_stream(stream().where("not ack").select("request_id", F.col("at").alias("sent_at")), stream().where("ack").select("request_id", F.col("at").alias("acked_at")), 60 * 10**6, "1 hour", F.lit("1970-01-01 00:01:40"))
    found = {r["request_id"] - big: (r["sent_us"], r["acked_us"], r["state"]) for r in got.collect()}
    assert found == {1: (10 * 10**6, 70 * 10**6, "answered"), 2: (10 * 10**6, None, "timed_out")}  # 3 is due at 100 s, which is not past


def test_the_earliest_row_survives(spark, tmp_path):
    r = random.Random(8)
    batches = [[(r.choice("abcd") if r.random() < 0.9 else None, 1000 * k + r.randrange(-300, 900), n) for n in range(60)] for k in range(4)]
    frames = [spark.createDataFrame(b, "k string, s long, n long").withColumn("ts", F.timestamp_seconds("s")) for b in batches]
    files = mixed_files(spark, tmp_path, frames)
    got = jobs.earliest_stream(jobs.file_stream(spark, files, files_per_batch=1), "ts", ["k"], "700 seconds").collect()
    want = []
    for batch in batches:
        first = {}
        for k, s, n in sorted(batch, key=lambda x: (x[1], x[2])):
            first.setdefault(k, (k, s, n))
        want += [x for x in first.values() if not any(x[0] == k and x[1] <= s + 700 for k, s, _ in list(want))]
    assert sorted(((x["k"], x["s"], x["n"]) for x in got), key=repr) == sorted(want, key=repr)
    once = jobs.dedup_stream(jobs.file_stream(spark, files), "ts", ["k"], "2 hours")
    assert sorted((x["k"] for x in once.collect()), key=repr) == sorted({k for b in batches for k, _, _ in b}, key=repr)


def test_bytes_bound_a_micro_batch(spark, tmp_path):
    files = mixed_files(spark, tmp_path, [points(spark, 50)] * 3)
    rows, counted = jobs.append_stream(jobs.file_stream(spark, files, bytes_per_batch=1000), SPEC)
    assert rows.count() == 150 and counted.count() == 3


def test_stored_tables_answer_their_queries(spark):
    kept = catalog_plans.evolve_versions(spark, SF)
    assert kept.where("files_kept").count() == kept.count() and isinstance(kept.first()["ts"], datetime.datetime)
