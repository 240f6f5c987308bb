"""Jobs whose state waits for a time: requests that may go unanswered, and alerts.

A job reads all its files first, whatever their order, as far as ``late``
allows. Then the clock moves on to ``until``, and what is due by then comes
out; what is due later stays. Requests are settled by an aggregation a
micro-batch. Alerts run on ``transformWithState`` with timers of event time;
ticks move their clock, and a run that goes on from the same checkpoint finds
what is open in the state store.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.ledger import dealt
from ..sources.store import scratch_folder
from .jobs import Alert, run

#: The state store that timers and maps need.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _ticked(rows: DataFrame, ts: str, late: str, folder: str) -> DataFrame:
    """``rows`` with the ticks at ``folder``, which have a time only, under one watermark; ``__tick`` tells them apart."""
    spark = rows.sparkSession
    ticks = spark.readStream.schema(f"`{ts}` timestamp").parquet(folder).withColumn("__tick", F.lit(True))
    return rows.withColumn("__tick", F.lit(False)).unionByName(ticks, allowMissingColumns=True).withWatermark(ts, late)


def _run_until(out: DataFrame, root: str, ts: str, late: str, until: Column) -> DataFrame:
    """All output of ``out`` once its input is read and the watermark stands at ``until``.

    The watermark moves between micro-batches, so a second tick gives timers
    a batch in which they see it.
    """
    spark = out.sparkSession
    before = {k: spark.conf.get(k, None) for k in STORE}
    try:
        for k, v in STORE.items():
            spark.conf.set(k, v)
        for number in range(3):
            if number:
                moment = (until.cast("timestamp") + F.expr(f"interval {late}")).alias(ts)
                spark.range(1).select(moment).coalesce(1).write.mode("append").parquet(f"{root}/ticks")
            run(out, lambda found, n: found.write.mode("overwrite").parquet(f"{root}/data/batch={n}"), f"{root}/checkpoint")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(out.schema).parquet(f"{root}/data").select(*out.columns)


def answered_stream(requests: DataFrame, acks: DataFrame, timeout_us: int, late: str, until: Column) -> DataFrame:
    """``request_id, sent_us, acked_us, state`` of every request: ``answered`` by the first acknowledgement within ``timeout_us``, or ``timed_out``.

    ``requests`` has ``request_id, sent_at`` and ``acks`` has ``request_id,
    acked_at``; ids are not used twice. Files may come in any order as far as
    ``late`` covers it. A request times out once the clock, which is ``late``
    behind the newest time of earlier micro-batches and goes to ``until`` in the
    end, has passed its deadline; those with a later deadline than ``until``
    stay open, and acknowledgements of unknown ids go when their time has
    passed. A micro-batch is one aggregation with what its predecessor left
    open: a timer and a call into a state store by request cost far more.
    """
    spark = requests.sparkSession
    root = scratch_folder(spark, "answers")
    kind = requests.schema["request_id"].dataType
    stored = StructType([StructField("request_id", kind), StructField("sent_us", LongType()), StructField("acked_us", LongType()), StructField("state", StringType()), StructField("batch", LongType())])
    spark.range(1).select(F.lit(None).cast("long").alias("us")).write.parquet(f"{root}/clock/batch=-1")
    both = requests.select("request_id", F.unix_micros("sent_at").alias("sent_us"), F.lit(None).cast("long").alias("acked_us")).union(acks.select("request_id", F.lit(None), F.unix_micros("acked_at")))
    at, last = F.coalesce("sent_us", "acked_us"), [-1]

    def settle(rows: DataFrame, number: int, clock: Column) -> None:
        before = spark.read.schema(stored).option("basePath", f"{root}/data").parquet(f"{root}/data/batch={number - 1}") if number else spark.createDataFrame([], stored)
        every = dealt(rows.unionByName(before.where("state = 'open'").select(*rows.columns)), "request_id")
        each = every.groupBy("request_id").agg(F.min("sent_us").alias("sent_us"), F.min("acked_us").alias("acked_us"))
        answered = F.col("acked_us").between(F.col("sent_us"), F.col("sent_us") + timeout_us)
        passed = F.coalesce(F.col("sent_us") + timeout_us, "acked_us") < clock
        state = F.when(answered, "answered").when(passed & F.col("sent_us").isNotNull(), "timed_out").when(passed, "unknown").otherwise("open")
        acked = F.when((F.col("state") != "timed_out"), F.col("acked_us"))
        each.withColumn("state", state).withColumn("acked_us", acked).write.mode("overwrite").partitionBy("state").parquet(f"{root}/data/batch={number}")

    def one(rows: DataFrame, number: int) -> None:
        clock = spark.read.schema("us long, batch long").parquet(f"{root}/clock").where(F.col("batch") < number).agg(F.max("us")).first()[0]
        behind = F.lit(clock).cast("long") - F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {late}"))
        seen = Observation()
        fine = rows.where(F.col("request_id").isNotNull() & at.isNotNull()).observe(seen, F.max(at).alias("us"))
        settle(fine.where(F.coalesce(at >= behind, F.lit(True))), number, behind)
        spark.range(1).select(F.lit(seen.get["us"]).cast("long").alias("us")).write.mode("overwrite").parquet(f"{root}/clock/batch={number}")
        last[0] = number

    run(both, one, f"{root}/checkpoint")
    settle(spark.createDataFrame([], both.schema), last[0] + 1, F.unix_micros(until.cast("timestamp")))
    done = spark.read.schema(stored).parquet(f"{root}/data").where(F.col("state").isin("answered", "timed_out"))
    return done.select("request_id", "sent_us", "acked_us", "state")


class Episodes(StatefulProcessor):
    """A series' samples, kept by slices of time until the watermark has passed them, and its episode."""

    def __init__(self, for_us: int, keep_us: int, slice_us: int, tags: list[str]):
        self.for_us, self.keep_us, self.slice_us, self.tags = for_us, keep_us, slice_us, tags

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slice long", "us array<long>, up array<boolean>")
        self.alert = handle.getValueState("alert", "started long, last_true long, fired_at long, broken boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        came: dict[int, dict[int, bool]] = {}
        for row in rows:
            if row["__us"] is not None:
                here = came.setdefault(row["__us"] // self.slice_us, {})
                here[row["__us"]] = here.get(row["__us"], False) or row["__on"]
        for number, samples in came.items():
            if self.waiting.containsKey((number,)):
                for us, up in zip(*self.waiting.getValue((number,)), strict=True):
                    samples[us] = samples.get(us, False) or up
            self._keep(number, samples)
        return iter(())

    def _keep(self, number: int, samples: dict[int, bool]) -> None:
        order = sorted(samples)
        self.waiting.updateValue((number,), (order, [samples[us] for us in order]))
        self.handle.registerTimer(((number + 1) * self.slice_us) // 1000 + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        alert, ended = Alert(self.for_us, self.keep_us, tuple(self.alert.get()) if self.alert.exists() else None), []
        for number in sorted(k[0] for k in self.waiting.keys()):
            if number * self.slice_us > now:
                break
            us, up = self.waiting.getValue((number,))
            self.waiting.removeKey((number,))
            later = {}
            for at, on in zip(us, up, strict=True):
                if at <= now:
                    ended += alert.seen(at, on)
                else:
                    later[at] = on
            if later:
                self._keep(number, later)
        ended += alert.passed(now)
        if alert.started is None:
            self.alert.clear()
        else:
            self.alert.update(alert.held())
            if alert.broken:
                self.handle.registerTimer((alert.last_true + self.keep_us) // 1000 + 1)
        for started, last_true, fired_at, ended_at, state in ended:
            yield Row(**dict(zip(self.tags, key, strict=True)), started=started, last_true=last_true, fired_at=fired_at, ended_at=ended_at, state=state)

    def close(self) -> None:
        pass


def alert_stream(stream: DataFrame, tags: list[str], ts: str, holds: Column, for_us: int, keep_us: int, late: str, until: Column, slice_us: int = 3_600_000_000) -> DataFrame:
    """``timeseries.alerts`` on a stream: each episode that has ended by ``until``.

    A sample waits in the slice of time that it falls in; a timer at the
    slice's end, or where a firing episode would end, judges what the
    watermark has passed and drops it. So a micro-batch writes only the slices
    it adds to, and a series holds what is later than the watermark and one
    episode. Samples later than ``late`` are ignored, as are those without a
    time; a series of null tags is one like others.
    """
    spark = stream.sparkSession
    root = scratch_folder(spark, "episodes")
    spark.createDataFrame([], f"`{ts}` timestamp").write.parquet(f"{root}/ticks")
    rows = stream.select(*tags, F.col(ts), F.coalesce(holds, F.lit(False)).alias("__on"))
    rows = _ticked(rows, ts, late, f"{root}/ticks").withColumn("__us", F.when(~F.col("__tick"), F.unix_micros(F.col(ts))))
    kinds = ", ".join(f"`{t}` {rows.schema[t].dataType.simpleString()}" for t in tags)
    out = rows.groupBy(*tags).transformWithState(Episodes(for_us, keep_us, slice_us, tags), f"{kinds}, started long, last_true long, fired_at long, ended_at long, state string", "Append", "EventTime")
    return _run_until(out, root, ts, late, until)
