import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemill.functions.types import SchemaError
from tidemill.operators import failures, ledger, mutate, nested, timeseries
from tidemill.operators.spec import TableSpec, field, tag, timestamp
from tidemill.plans import coercions, reads, streams
from tidemill.sources import catalog, generate
from tidemill.sources.store import StateError, StreamWriter, TableStore, WriteError, scratch_folder
from tidemill.streaming import jobs, timers

SPEC = TableSpec("metrics", (tag("host"), field("usage", "Float64"), timestamp("ts")))


def points(spark, n=10, **more):
    return spark.range(n).selectExpr("concat('h', id % 3) as host", "cast(id as double) as usage", "id * 1000 as ts").withColumns(more)


def test_acks(spark):
    good = ['{"request_id":1,"affected_rows":5}', '{"request_id":1.0,"affected_rows":1e2}', '{"request_id":0,"affected_rows":9007199254740991,"x":[]}', '{"request_id":null,"affected_rows":3,"request_id":8}']
    bad = ["", "x", "[1]", "{}", '{"request_id":1}', '{"request_id":"1","affected_rows":5}', '{"request_id":1,"affected_rows":null}', '{"request_id":1,"affected_rows":1.5}', '{"request_id":-1,"affected_rows":5}', '{"request_id":1,"affected_rows":9007199254740992}', '{"request_id":true,"affected_rows":1}', None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(good + bad)], "seq long, body string")
    assert ledger.read_acks(df).where("seq = 3").first()["request_id"] == 8
    assert [r["well_formed"] for r in ledger.read_acks(df).orderBy("seq").collect()] == [True] * 4 + [False] * len(bad)


def test_ledger_counts_and_verdicts(spark):
    requests = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12)], "request_id long, batch_id long")
    acks = spark.createDataFrame([(1, 2, 5, True, True), (2, 2, 7, True, True), (3, 1, 4, True, True), (4, 3, 1, False, True), (5, 99, 8, True, True), (6, 4, 3, True, False)], "seq long, request_id long, affected_rows long, ok boolean, well_formed boolean")
    heard = acks.where("well_formed")
    batches = ledger.batch_rollup(ledger.reconciled(requests, heard))
    assert {r["batch_id"]: (r["status"], r["affected_rows"]) for r in batches.collect()} == {10: ("ok", 9), 11: ("failed", 0), 12: ("pending", 0)}
    assert [r["request_id"] for r in ledger.pending(requests, heard).collect()] == [4]
    found, refused = ledger.reconciled(requests, heard), spark.createDataFrame([(20, "bad cell"), (14, "worse")], "batch_id long, error string")
    assert tuple(ledger.verdict(found).first()) == (3, 1, 0, 1, "pending", 4, "no ack")
    answered = found.where("request_id <> 4")
    assert tuple(ledger.verdict(answered, refused).first()) == (2, 0, 2, 1, "rejected", 14, "worse")
    assert tuple(ledger.verdict(answered).first()) == (2, 0, 0, 1, "failed", 11, "frame failed")
    assert tuple(ledger.verdict(found.where("batch_id = 10"), refused.limit(0)).first()) == (1, 0, 0, 0, "complete", None, None)
    mixed = ledger.reconciled(spark.createDataFrame([(1, 1), (2, 1)], "request_id long, batch_id long"), spark.createDataFrame([(1, 1, 0, False)], "seq long, request_id long, affected_rows long, ok boolean"))
    assert tuple(ledger.verdict(mixed).first()) == (1, 1, 0, 1, "pending", 2, "no ack") and ledger.batch_rollup(mixed).first()["status"] == "pending"
    assert ledger.summary(requests, acks).first().asDict() == {"total_requests": 3, "distinct_affected_rows": 10, "total_affected_rows": 25}


def test_newest_and_last_write(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, None)], "k string, seq long, v double")
    assert {r["k"]: r["v"] for r in ledger.last_write_wins(df, ["k"], ["seq"]).collect()} == {"a": 6.0, "b": None}
    assert [r["seq"] for r in ledger.newest(df, 1, "seq").collect()] == [2]
    for n in (0, 1.5, True):
        with pytest.raises(ValueError):
            ledger.newest(df, n, "seq")


def test_failures(spark):
    df = spark.createDataFrame([("transport", 14), ("transport", 5), ("timeout", None), ("server", None), ("config", 14), ("foreign", 14), (None, None)], "k string, c int")
    got = df.select(failures.retriable(F.col("k"), F.col("c")), failures.retriable(F.col("k"), F.col("c"), "conservative")).collect()
    assert [tuple(r) for r in got] == [(True, True), (True, False), (True, True), (True, False), (False, False), (False, False), (False, False)]
    delays = [r[0] for r in spark.range(12).select(failures.backoff(F.col("id"), 100, 10_000, 2)).collect()]
    assert delays[:3] == [100, 200, 400] and delays[-1] == 10_000
    with pytest.raises(ValueError):
        failures.retriable(F.col("k"), F.col("c"), "x")


def test_store_writes_and_refuses(spark):
    store = TableStore(spark, scratch_folder(spark, "t"))
    with pytest.raises(WriteError):
        store.write([(SPEC, points(spark))], hints={"auto_create_table": "false"})
    assert not store.exists("metrics")
    assert store.write([(SPEC, points(spark))]) == {"metrics": 10} and store.read("metrics").count() == 10
    other = TableSpec("other", SPEC.columns)
    with pytest.raises(Exception, match="not a Float64"):
        store.write([(other, points(spark)), (SPEC, points(spark, usage=F.lit("x")))])
    assert not store.exists("other") and store.read("metrics").count() == 10
    with pytest.raises(ValueError):
        store.write([(SPEC, points(spark))], hints={"a=b": "c"})
    with pytest.raises(SchemaError):
        store.write([(TableSpec("metrics", (tag("host"), timestamp("ts"))), points(spark).drop("usage"))])
    assert store.schema("metrics")["host"].metadata["semantic"] == "tag"
    narrow = TableSpec("fresh", (tag("host"), timestamp("ts")))
    with pytest.raises(SchemaError):
        store.write([(TableSpec("fresh", SPEC.columns), points(spark)), (narrow, points(spark).drop("usage"))])
    assert not store.exists("fresh")
    store.drop("metrics")
    assert not store.exists("metrics")


def test_writer_states(spark):
    store = TableStore(spark, scratch_folder(spark, "w"))
    writer = StreamWriter(store)
    writer.write([(SPEC, points(spark))])
    writer.write([(SPEC, points(spark, 5)), (TableSpec("other", SPEC.columns), points(spark, 2))])
    assert writer.finish() == 17 and store.read("metrics").count() == 15
    for call in (writer.finish, lambda: writer.write([(SPEC, points(spark))])):
        with pytest.raises(StateError):
            call()
    writer = StreamWriter(store)
    writer.cancel()
    with pytest.raises(StateError):
        writer.write([(SPEC, points(spark))])
    writer = StreamWriter(store)
    with pytest.raises(Exception, match="not a Float64"):
        writer.write([(SPEC, points(spark, usage=F.lit("x")))])
    with pytest.raises(StateError):
        writer.finish()


def test_kinds_need_a_declaration(spark):
    store = TableStore(spark, scratch_folder(spark, "k"))
    rows = points(spark, kind=F.when(F.col("usage") < 5, "a").otherwise("b"))
    specs = {"a": SPEC, "b": TableSpec("few", (timestamp("at", source="ts"), field("none", "Int8")))}
    with pytest.raises(SchemaError, match="'b'"):
        store.write_kinds(rows, "kind", {"a": SPEC})
    with pytest.raises(SchemaError, match="null"):
        store.write_kinds(rows.withColumn("kind", F.lit(None).cast("string")), "kind", specs)
    assert not store.exists("metrics")
    assert store.write_kinds(rows, "kind", specs) == {"metrics": 5, "few": 5}
    assert store.read("few").columns == ["at", "none"] and store.read("few").where("none is null").count() == 5


def test_flow_ignores_what_is_expired(spark, tmp_path):
    for k, hours in enumerate(([100, 101], [99], [2])):
        rows = spark.createDataFrame([(h, 1) for h in hours], "h long, v long").selectExpr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, h, 0, 0) as ts", "v")
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for f in (tmp_path / "in").glob("part-*.parquet"):
            if f.name[5] not in "x":
                f.rename(f.with_name(f"part-x{k}{f.name[5:]}"))
                os.utime(f.with_name(f"part-x{k}{f.name[5:]}"), (1_700_000_000 + k, 1_700_000_000 + k))
    for every in (None, "1 seconds"):
        stream = jobs.file_stream(spark, f"{tmp_path}/in", files_per_batch=1)
        got = jobs.flow(stream, "ts", [], "24 hours", "1 hours", None, {"n": F.count("*")}, every).collect()
        assert sorted((r["window_start"].day, r["window_start"].hour) for r in got) == [(5, 3), (5, 4), (5, 5)]


def test_bulk_load(spark):
    store = TableStore(spark, scratch_folder(spark, "b"))
    rows = points(spark, 100, batch=F.floor(F.col("ts") / 25_000))
    with pytest.raises(WriteError):
        store.bulk_load(rows, SPEC, "batch")
    store.create(SPEC)
    with pytest.raises(ValueError):
        store.bulk_load(rows, SPEC, "batch", codec="gzip")
    got = store.bulk_load(rows, SPEC, "batch", codec="lz4", rows_per_file=7)
    assert {r["batch_id"]: r["affected_rows"] for r in got.collect()} == {0: 25, 1: 25, 2: 25, 3: 25}
    assert store.read("metrics").columns == SPEC.names and store.read("metrics").count() == 100


def test_reconciling_keeps_its_parts(spark):
    requests = spark.range(100).selectExpr("id as request_id", "id div 7 as batch_id")
    acks = spark.range(150).selectExpr("id as seq", "if(id % 10 = 0, null, id % 100) as request_id", "if(id % 3 = 0, null, id) as affected_rows", "id % 4 > 0 as ok")
    found = ledger.reconciled(requests, acks)
    got = {r["request_id"]: (r["acked_at"], r["affected_rows"], r["ok"]) for r in found.collect()}
    assert got == {i: (i, None if i % 3 == 0 else i, i % 4 > 0) if i % 10 else (None, None, None) for i in range(100)}
    big = ledger.reconciled(requests.hint("merge"), acks)
    assert big.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))  # adaptive merging would leave one
    assert "SortAggregate" not in big._jdf.queryExecution().toString()


def test_rollup_and_verdict_plans(spark):
    found = spark.createDataFrame([(1, 10, None, None, None, 0), (2, None, 5, 1, False, 0), (3, 11, 6, 1, False, 1), (4, 11, 7, 2, False, 1), (5, 12, 8, 2, True, 1)], "request_id long, batch_id long, acked_at long, affected_rows long, ok boolean, load_id long")
    per = ledger.verdict(found, by=("load_id",))
    assert sorted(tuple(r) for r in per.collect()) == [(0, 1, 1, 0, 0, "pending", 1, "no ack"), (1, 2, 0, 0, 1, "failed", 11, "frame failed")]
    assert "Expand" not in per._jdf.queryExecution().toString()
    assert tuple(ledger.verdict(found.where("false")).first())[:5] == (0, 0, 0, 0, "complete")


def test_mutations(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "a", 6), (3, "b", 7)], "seq long, k string, v long").withColumn("ts", F.timestamp_seconds("seq"))
    assert [r["seq"] for r in mutate.without_keys(df, spark.createDataFrame([(None,), ("b",)], "k string")).collect()] == [2]
    assert [r["seq"] for r in mutate.truncated(df, "ts", [(2000, 3000)]).orderBy("seq").collect()] == [1, 3]
    assert mutate.truncated(df, "ts", []).count() == 0
    bounds = spark.createDataFrame([(1, 1)], "part int, upto long")
    assert [r["seq"] for r in mutate.snapshot(df.withColumn("part", (F.col("v") % 2).cast("int")), "part", "seq", bounds).collect()] == [1]
    with pytest.raises(SchemaError):
        mutate.evolved(SPEC, [mutate.Change("drop", "host")])
    assert mutate.evolved(SPEC, [mutate.Change("add", "z", field("z", "Int8"), first=True)]).names == ["z", "host", "usage", "ts"]


def test_nested(spark):
    row = spark.sql("select unhex('2002') as m, array(1D,2D,3D,4D,5D,6D,7D,8D,9D,10D,11D,12D,13D,14D) as v, 16 as n")
    got = row.select(nested.dense("v", "m", "n").alias("d")).first()["d"]
    assert [i for i, x in enumerate(got) if x is None] == [5, 9] and [x for x in got if x is not None] == [float(i) for i in range(1, 15)]
    none = spark.sql("select cast(array() as array<string>) as v, unhex('03') as m, 2 as n, 0 as z")
    assert none.select(nested.dense("v", "m", "n"), nested.dense("v", "m", "z")).first() == ([None, None], [])
    pairs = [(0, -1), (1, 0), (-1, 5), (2**62, 7), (-(2**62), 0), (2**63 - 1, -1)]
    wide = spark.createDataFrame(pairs, "h long, l long")
    got = wide.select(*nested.decimal_of(F.col("h"), F.col("l"), 0), *nested.decimal_of(F.col("h"), F.col("l"), 10)).collect()
    for (h, low), (a, why, b, _) in zip(pairs, got, strict=True):
        n = h * 2**64 + low % 2**64
        assert (a, b, why) == (None, None, "range") if abs(n) >= 10**38 else (int(a), int(f"{b:f}".replace(".", ""))) == (n, n) and why is None
    assert [r[0] for r in wide.select(nested.decimal_of(F.col("h"), F.col("l"), 0, 20)[1]).collect()][:4] == [None, None, None, "range"]
    texts = spark.createDataFrame([("The quick, fox",), ("quickly",), (None,)], "t string")
    assert [r[0] for r in texts.select(nested.has_terms(F.col("t"), ["Quick", "fox"])).collect()] == [True, False, False]
    other = spark.createDataFrame([("Żółw, Émile",), ("我喜歡漢字。",), ("Zolw",)], "t string")
    assert [r[0] for r in other.select(nested.has_terms(F.col("t"), ["émile", "żółw"])).collect()] == [True, False, False]
    assert [r[0] for r in other.select(nested.has_terms(F.col("t"), ["漢字"], analyzer="chinese")).collect()] == [False, True, False]
    assert not other.where(nested.has_terms(F.col("t"), ["Émile"], fold=False)).isEmpty() and other.where(nested.has_terms(F.col("t"), ["émile"], fold=False)).isEmpty()
    keys = spark.createDataFrame([('{"http.method":"GET","a b":1,"it\'s":2,"http":{"method":"x"}}',)], "j string")
    assert tuple(nested.promoted(keys, "j", {"http.method": "string", "a b": "int", "it's": "int"}).drop("j").first()) == ("GET", 1, 2)


def test_conform_nested_on_wide_numbers(spark, tmp_path):
    keys = [0, 1, 699, 700, 6121, 6122, 9922, 9923, 9924, 14999]
    spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    for r in reads.conform_nested(spark, str(tmp_path)).collect():
        k, n = keys[r["o_orderkey"]], (keys[r["o_orderkey"]] - 700) * 10**15 * 2**64 + (r["o_orderkey"] - 1000) % 2**64
        digits = f"{abs(n):039d}"
        fits = k <= 9923  # what is beyond has no 128 bits
        assert (r["wide"], r["scaled"]) == ((str(n), f"{'-' if n < 0 else ''}{digits[:35]}.{digits[35:]}") if fits else (None, None))
    edges = [(-(2**63), 0), (-(2**63), -1), (2**63 - 1, -1), (-1, -1), (0, 0), (None, 1)]
    rows = spark.createDataFrame(edges, "h long, l long").select(nested.decimal_text(F.col("h"), F.col("l"), 0)).collect()
    assert [r[0] and int(r[0]) for r in rows] == [None if h is None else h * 2**64 + low % 2**64 for h, low in edges]


def test_nested_conforming(spark):
    df = spark.sql("select array(1, 2) as good, array(1, 300) as bad, named_struct('a', 1.5D, 'b', array('x')) as s, '[1, {}]' as j, 'x' as nj, 12 as m, 5.25BD as d, array(1.0F, 2.0F) as v")

    def one(name, target):
        return tuple(df.select(*nested.coerced_nested(F.col(name), df.schema[name].dataType, target)).first())

    assert one("good", nested.ListOf("Uint8")) == ([1, 2], None) and one("bad", nested.ListOf("Uint8")) == (None, "[1]:range") and one("m", nested.ListOf("Int8"))[1] == "type:list"
    shape = nested.StructOf({"a": "Float64", "b": nested.ListOf("String"), "c": "Int8"})
    assert one("s", shape) == ((1.5, ["x"], None), None)
    assert one("s", nested.StructOf({"a": "Int8", "b": nested.ListOf("String")}))[1] == ".a:range" and one("s", nested.StructOf({"a": "Int8"}))[1] == "type:struct"
    assert one("s", nested.StructOf({"a": "Float64", "b": nested.ListOf("Int8")}))[1] == ".b:[0]:type:string"
    assert str(one("d", nested.Decimal(4, 2))[0]) == "5.25" and one("d", nested.Decimal(4, 1))[1] == "range" and one("v", nested.Vector(3))[1] == "dimension"
    assert one("nj", nested.JsonNative())[1] == "json" and one("m", nested.Interval("micros"))[0].microseconds == 12
    value, _ = nested.coerced_nested(F.col("m"), df.schema["m"].dataType, nested.Interval("months"))
    assert df.select(value.cast("string")).first()[0] == "INTERVAL '1-0' YEAR TO MONTH"
    value, _ = nested.coerced_nested(F.col("j"), df.schema["j"].dataType, nested.JsonNative())
    assert df.select(F.to_json(value)).first()[0] == "[1,{}]"


def test_deep_nesting_plans_in_linear_time(spark):
    kind, value, fine, target = "int", "300", "5", "Uint8"
    for depth in range(8):
        if depth % 2:
            kind, value, fine, target = f"struct<a:{kind},b:string>", f"named_struct('a', {value}, 'b', 'x')", f"named_struct('a', {fine}, 'b', 'x')", nested.StructOf({"a": target, "b": "String", "c": "Int8"})
        else:
            kind, value, fine, target = f"array<{kind}>", f"array({fine}, {value})", f"array({fine}, {fine})", nested.ListOf(target)
    df = spark.sql(f"select {value} as bad, {fine} as good, cast(null as {kind}) as none")
    began = time.time()
    got = {n: df.select(*nested.coerced_nested(F.col(n), df.schema[n].dataType, target)) for n in df.columns}
    for x in got.values():
        x._jdf.queryExecution().executedPlan()
    assert time.time() - began < 6
    assert got["bad"].first()[1] == ".a:[1]:.a:[1]:.a:[1]:.a:[1]:range" and got["bad"].first()[0] is None
    assert got["good"].first()[1] is None and got["good"].first()[0]["a"][0]["a"][0]["a"][0]["a"] == [5, 5] and tuple(got["none"].first()) == (None, None)


def test_series_reads(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 10, 2.0), ("a", 25, 9.0), ("b", 5, 7.0)], "k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))
    at = F.timestamp_seconds(F.lit(20))
    assert {r["k"]: r["v"] for r in timeseries.instant(df, ["k"], "ts", "v", at, 15_000_000).collect()} == {"a": 2.0}
    got = {(r["k"], r["step"] // 10**6): (r["last"], r["samples"]) for r in timeseries.evaluated(df, ["k"], "ts", "v", 0, 30_000_000, 10_000_000, 15_000_000).collect()}
    assert got == {("a", 0): (1.0, 1), ("a", 10): (2.0, 2), ("a", 20): (2.0, 1), ("a", 30): (9.0, 1), ("b", 10): (7.0, 1)}
    up = spark.createDataFrame([(0, True), (10, True), (20, False), (30, True)], "s long, up boolean").withColumn("ts", F.timestamp_seconds("s")).withColumn("k", F.lit(1))
    alerts = timeseries.alerts(up, ["k"], "ts", F.col("up"), 5_000_000, 15_000_000).orderBy("started").collect()
    assert [tuple(r)[1:] for r in alerts] == [(0, 10_000_000, 5_000_000, 25_000_000, "firing"), (30_000_000, 30_000_000, None, None, "pending")]
    still = timeseries.alerts(up.where("s < 20"), ["k"], "ts", F.col("up"), 5_000_000, 15_000_000).collect()
    assert [tuple(r)[1:] for r in still] == [(0, 10_000_000, 5_000_000, None, "firing")]


def episodes(samples, for_us, keep_us):
    """Alert states, one sample after another."""
    out, now = [], None
    for us, on in sorted(samples):
        if now and now["broken"] and us > now["last_true"] + keep_us:
            out.append(now | {"ended_at": now["last_true"] + keep_us})
            now = None
        if on and not now:
            now = {"started": us, "last_true": us, "fired_at": None, "ended_at": None, "broken": False}
        elif on:
            now |= {"last_true": us, "broken": False}
        elif now and now["fired_at"] is None:
            out.append(now | {"ended_at": us})
            now = None
        elif now:
            now["broken"] = True
        if now and on and now["last_true"] - now["started"] >= for_us and now["fired_at"] is None:
            now["fired_at"] = now["started"] + for_us
    if now:
        out.append(now | ({"ended_at": now["last_true"] + keep_us} if now["broken"] else {}))
    return out


def test_alerts_equal_a_state_machine(spark):
    r = random.Random(4)
    rows = [(k, us, r.random() < 0.7) for k in ("a", "b", None) for us in r.sample(range(3000), 400)]
    df = spark.createDataFrame(rows, "k string, us long, up boolean").withColumn("ts", F.timestamp_micros("us"))
    for for_us, keep_us in ((30, 12), (0, 0), (15, 100), (60, 3)):
        got = timeseries.alerts(df, ["k"], "ts", F.col("up"), for_us, keep_us, slice_us=70).collect()
        assert all((x["state"] == "firing") == (x["fired_at"] is not None) for x in got)
        mine = {k: sorted(((x["started"], x["last_true"], x["fired_at"], x["ended_at"]) for x in got if x["k"] == k)) for k in ("a", "b", None)}
        for k in mine:
            want = [tuple(e[c] for c in ("started", "last_true", "fired_at", "ended_at")) for e in episodes([(us, up) for key, us, up in rows if key == k], for_us, keep_us)]
            assert mine[k] == want
    pending = spark.createDataFrame([(0, True), (10, False), (12, True)], "s long, up boolean").selectExpr("timestamp_seconds(s) as ts", "up", "1 as k")
    assert [tuple(x)[1:] for x in timeseries.alerts(pending, ["k"], "ts", F.col("up"), 30_000_000, 50_000_000).orderBy("started").collect()] == [(0, 0, None, 10_000_000, "pending"), (12_000_000, 12_000_000, None, None, "pending")]


def test_generators(spark):
    rows = generate.cpu_rows(spark.range(2000, 2010), hosts=2)
    assert rows.schema.names == generate.CPU.names and rows.first()["host"] == "host-0" and rows.where("cpu between 0 and 100").count() == 10
    logs = generate.log_rows(spark.range(500))
    assert len(logs.columns) == 22 and logs.where("error_flag != (log_level = 'ERROR')").count() == 0
    with pytest.raises(ValueError):
        generate.cpu_rows(spark.range(1), hosts=0)


def test_stream_replay_leaves_counts(spark):
    root = scratch_folder(spark, "replay")
    stream = lambda: jobs.file_stream(spark, f"{SF}/events.parquet").select("user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    spec = TableSpec("e", (tag("user_id", "Int64"), tag("event_type"), field("value", "Float64"), timestamp("ts")))
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    for _ in range(2):
        rows, counted = jobs.append_stream(stream(), spec, root)
        assert rows.count() == n == counted.agg(F.sum("affected_rows")).first()[0]


def test_conform_strict_keeps_large_part_keys(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.limit(3).withColumn("l_partkey", F.lit(200_000).cast(lines.schema["l_partkey"].dataType)).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [r["part"] for r in coercions.conform_strict(spark, str(tmp_path)).collect()] == [200_000] * 3


def test_reconciled_stream_of_files_in_mixed_order(spark, tmp_path):
    for day in (29, 3, 17, 0):
        rows = spark.range(10).selectExpr(f"id + {day * 10} as request_id", f"timestamp'2024-01-01' + make_interval(0, 0, 0, {day}, 0, 0, id) as sent_at")
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/sent")
    sent = jobs.file_stream(spark, f"{tmp_path}/sent", files_per_batch=1)
    acks = jobs.file_stream(spark, f"{tmp_path}/sent", files_per_batch=1).where("request_id % 5 <> 0").selectExpr("request_id", "sent_at + interval 30 seconds as acked_at")
    got = jobs.reconciled_stream(sent, acks, "5 minutes").where("acked_at is not null").select("request_id").collect()
    requests = spark.read.parquet(f"{tmp_path}/sent")
    batch = ledger.pending(requests, requests.where("request_id % 5 <> 0"))
    assert sorted(r[0] for r in got) == sorted({r[0] for r in requests.select("request_id").collect()} - {r[0] for r in batch.select("request_id").collect()})


def test_ack_reconcile_stream_has_every_request(spark):
    got = {r["request_id"]: r["acked_at"] for r in streams.ack_reconcile_stream(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/events.parquet").count() and all((at is None) == (i % 17 == 0) for i, at in got.items())


def test_catalog_calls(spark):
    base = f"t_{os.getpid()}"
    catalog.create_database(spark, base, location=scratch_folder(spark, "db"), options={"a": "it's"})
    catalog.create_database(spark, base)
    spec = TableSpec("m", (tag("host"), field("usage", "Float64", default=1.5), timestamp("ts")))
    catalog.create_table(spark, f"{base}.m", spec, options={"x.y": "1"}, comment="first")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        catalog.create_table(spark, f"{base}.m", spec, if_not_exists=False)
    with pytest.raises(SchemaError):
        catalog.create_table(spark, f"{base}.n", spec, comments={"zz": "?"})
    catalog.insert(spark, f"{base}.m", spec, points(spark).drop("usage"))
    assert spark.table(f"{base}.m").where("usage = 1.5").count() == 10 == catalog.total_rows(spark, f"{base}.m")
    catalog.comment_on(spark, f"{base}.m", "second")
    catalog.comment_on(spark, f"{base}.m", "a host", "host")
    catalog.set_options(spark, f"{base}.m", {"x.y": None, "z.z": "2"})
    assert catalog.options_of(spark, f"{base}.m").get("z.z") == "2" and "x.y" not in catalog.options_of(spark, f"{base}.m")
    assert [tuple(r) for r in catalog.described(spark, f"{base}.m").collect()][0] == ("host", "string", "tag", "String", "a host")
    catalog.create_view(spark, f"{base}.v", f"SELECT host FROM {base}.m")
    catalog.create_view(spark, f"{base}.v", f"SELECT host, usage FROM {base}.m", replace=True)
    assert spark.table(f"{base}.v").columns == ["host", "usage"]
    with pytest.raises(Exception, match="Int8"):
        catalog.evolve_table(spark, f"{base}.m", spec, [mutate.Change("retype", "usage", type="Int8")])
    assert catalog.total_rows(spark, f"{base}.m") == 10 and not spark.catalog.tableExists(f"{base}.m__new")
    catalog.drop(spark, "view", f"{base}.v")
    catalog.drop(spark, "table", f"{base}.m")
    catalog.drop(spark, "table", f"{base}.m", if_exists=True)
    catalog.drop(spark, "database", base, cascade=True)
    with pytest.raises(ValueError):
        catalog.drop(spark, "index", "x")


def test_alert_stream_equals_batch(spark, tmp_path):
    r = random.Random(12)
    rows = [(k, s, r.random() < 0.75) for k in ("a", "b") for s in r.sample(range(2000), 300)] + [(k, 4000, False) for k in ("a", "b")]
    df = spark.createDataFrame(rows, "k string, s long, up boolean").withColumn("ts", F.timestamp_seconds("s"))
    for k, (low, high) in enumerate(((0, 900), (700, 1500), (1500, 5000))):
        part = df.where((F.col("s") >= low) & (F.col("s") < high) & (F.col("s") % 2 == k % 2) | (F.col("s") >= low) & (F.col("s") < high) & (F.lit(k) == 2))
        part.coalesce(1).write.parquet(f"{tmp_path}/in{k}")
        for f in (tmp_path / f"in{k}").glob("part-*.parquet"):
            (tmp_path / "in").mkdir(exist_ok=True)
            f.rename(tmp_path / "in" / f"{k}.parquet")
            os.utime(tmp_path / "in" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = jobs.file_stream(spark, f"{tmp_path}/in", files_per_batch=1)
    every = spark.read.parquet(f"{tmp_path}/in")
    second = 10**6
    got = timers.alert_stream(stream, ["k"], "ts", F.col("up"), 40 * second, 25 * second, "1000 seconds", F.lit("1970-01-01 02:00:00"), slice_us=150 * second)
    batch = timeseries.alerts(every, ["k"], "ts", F.col("up"), 40 * second, 25 * second)
    mine, all_ = ({tuple(x) for x in y.select("k", "started", "last_true", "fired_at", "ended_at", "state").collect()} for y in (got, batch))
    assert mine == {x for x in all_ if x[4] is not None} and any(x[5] == "firing" for x in mine) and len(mine) > 10
