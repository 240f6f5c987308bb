"""Finite streams over files: appended writes with a ledger, quarantine, dedup, reconciliation and windowed flows.

Every job runs with ``availableNow``, keeps its checkpoint in the shared folder
and waits until all input is processed; a micro-batch that is replayed after a
failure replaces its own earlier output, which is filed under its number.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ..operators.conform import conformed, judged
from ..operators.spec import TableSpec
from ..sources.store import scratch_folder


def file_stream(spark: SparkSession, path: str, schema: StructType | None = None, files_per_batch: int = 1000, bytes_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files at ``path``; ``files_per_batch``, or ``bytes_per_batch`` in its place, bounds the work in flight. A file is never split."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option(*(("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else ("maxFilesPerTrigger", files_per_batch)))
    if not _is_file(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def _is_file(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()


def run(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", every: str | None = None) -> None:
    """Process all input there is and stop; with ``every``, in micro-batches that begin so far apart."""
    writer = stream.writeStream.foreachBatch(batch).outputMode(mode).option("checkpointLocation", checkpoint)
    if every is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    running = writer.trigger(processingTime=every).start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()


def append_stream(stream: DataFrame, spec: TableSpec, root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, ledger) after all of ``stream`` is conformed and appended; the ledger has rows per micro-batch."""
    spark = stream.sparkSession
    root = root or scratch_folder(spark, "stream")

    def one(rows: DataFrame, number: int) -> None:
        seen = Observation()
        conformed(rows, spec).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/data/batch={number}")
        spark.range(1).select(F.lit(int(seen.get["rows"])).alias("affected_rows")).write.mode("overwrite").parquet(f"{root}/ledger/batch={number}")

    run(stream, one, f"{root}/checkpoint")
    ledger = spark.read.schema("affected_rows long, batch long").parquet(f"{root}/ledger").select(F.col("batch").alias("batch_id"), "affected_rows")
    return spark.read.schema(spec.schema()).parquet(f"{root}/data"), ledger


def quarantine_stream(stream: DataFrame, spec: TableSpec, root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, dead letters) of ``stream``; each micro-batch is judged once, stored, and read as both."""
    spark = stream.sparkSession
    root = root or scratch_folder(spark, "letters")
    schema: list[StructType] = []

    def one(rows: DataFrame, number: int) -> None:
        both = judged(rows, spec)
        schema[:] = [both.schema]
        both.withColumn("bad", (F.size("_errors") > 0).cast("int")).write.mode("overwrite").partitionBy("bad").parquet(f"{root}/data/batch={number}")

    run(stream, one, f"{root}/checkpoint")
    whole = StructType([*(schema[0] if schema else judged(spark.createDataFrame([], stream.schema), spec).schema)]).add("batch", LongType()).add("bad", IntegerType())
    out = spark.read.schema(whole).parquet(f"{root}/data").drop("batch")
    return out.where("bad = 0").drop("bad", "_errors"), out.where("bad = 1").drop("bad")


def dedup_stream(stream: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """The first row of each of ``keys`` within ``late`` of it, appended as it comes."""
    spark = stream.sparkSession
    root = scratch_folder(spark, "dedup")
    once = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
    run(once, lambda rows, n: rows.write.mode("overwrite").parquet(f"{root}/data/batch={n}"), f"{root}/checkpoint")
    return spark.read.schema(once.schema).parquet(f"{root}/data").select(*once.columns)


def earliest_stream(stream: DataFrame, ts: str, keys: list[str], late: str) -> DataFrame:
    """``dedup_stream`` with a defined survivor: of the rows of a key that a micro-batch has, the least by ``ts`` and then by the other columns.

    A key is dropped if a micro-batch before has written it with a time not
    more than ``late`` before. What is known of keys is the output itself, of
    which a micro-batch reads the keys that are recent enough; null keys are
    keys like others. Rows without a time are left out.
    """
    spark = stream.sparkSession
    root = scratch_folder(spark, "earliest")
    rest = [c for c in stream.columns if c not in (ts, *keys)]
    spark.createDataFrame([], stream.schema).write.parquet(f"{root}/data/batch=-1")
    stored = StructType([*stream.schema]).add("batch", LongType())

    def one(rows: DataFrame, number: int) -> None:
        low = rows.agg(F.min(ts)).first()[0]
        first = rows.where(F.col(ts).isNotNull()).groupBy(*keys).agg(F.min(F.struct(ts, *rest)).alias("__row")).select(*keys, "__row.*").select(*stream.columns)
        since = F.lit(low) - F.expr(f"interval {late}")
        known = spark.read.schema(stored).parquet(f"{root}/data").where((F.col("batch") < number) & (F.col(ts) >= since))
        known = known.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(ts).alias("__at"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        fresh = first.join(known, same & (F.col(ts) <= F.col("__at") + F.expr(f"interval {late}")), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{root}/data/batch={number}")

    run(stream, one, f"{root}/checkpoint")
    return spark.read.schema(stored).parquet(f"{root}/data").drop("batch")


def flow(stream: DataFrame, ts: str, by: list[str], expire_after: str, window: str, slide: str | None, measures: dict[str, Column], every: str | None = None) -> DataFrame:
    """A continuous aggregate: ``measures`` per window and ``by``; the last version of each window, from updates filed by micro-batch.

    Rows of windows that ended more than ``expire_after`` before the newest
    time seen two micro-batches ago or earlier are ignored, as Spark drops late
    rows; ``every`` is the interval at
    which the flow is evaluated.
    """
    spark = stream.sparkSession
    root = scratch_folder(spark, "flow")
    at = F.window(ts, window, slide) if slide else F.window(ts, window)
    totals = stream.withWatermark(ts, expire_after).groupBy(at.alias("w"), *by).agg(*[c.alias(n) for n, c in measures.items()])
    flat = totals.select(F.col("w.start").alias("window_start"), *by, *measures)
    run(flat, lambda rows, n: rows.write.mode("overwrite").parquet(f"{root}/data/batch={n}"), f"{root}/checkpoint", "update", every)
    rows = spark.read.schema(StructType([*flat.schema]).add("batch", LongType())).parquet(f"{root}/data")
    keys = ["window_start", *by]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*measures), "batch").alias("m")).select(*keys, "m.*")


class Alert:
    """One series' episode, sample after sample; ``seen`` gives the episodes that a sample shows to have ended."""

    def __init__(self, for_us: int, keep_us: int, held: tuple | None):
        self.for_us, self.keep_us = for_us, keep_us
        self.started, self.last_true, self.fired_at, self.broken = held or (None, None, None, False)

    def _closed(self, ended_at: int) -> tuple:
        out = (self.started, self.last_true, self.fired_at, ended_at, "pending" if self.fired_at is None else "firing")
        self.started = self.last_true = self.fired_at = None
        self.broken = False
        return out

    def passed(self, us: int) -> list[tuple]:
        """The episode, if time ``us`` is beyond what keeps it firing."""
        return [self._closed(self.last_true + self.keep_us)] if self.broken and us > self.last_true + self.keep_us else []

    def seen(self, us: int, on: bool) -> list[tuple]:
        out = self.passed(us)
        if on:
            self.started = us if self.started is None else self.started
            self.last_true, self.broken = us, False
            if self.fired_at is None and us - self.started >= self.for_us:
                self.fired_at = self.started + self.for_us
        elif self.fired_at is not None:
            self.broken = True
        elif self.started is not None:
            out.append(self._closed(us))
        return out

    def held(self) -> tuple:
        return self.started, self.last_true, self.fired_at, self.broken


def reconciled_stream(requests: DataFrame, acks: DataFrame, timeout: str, late: str = "31 days") -> DataFrame:
    """Requests with the acks that came within ``timeout``; unanswered ones once the watermark has passed them.

    Both sides have ``request_id``; ``sent_at`` and ``acked_at`` are their event times. ``late`` has to
    cover the span of the input, as files need not come in the order of their
    times. Unanswered requests sent less than ``late`` and ``timeout`` before
    the newest event stay in state when the stream ends, so a batch ``pending``
    is the authority.
    """
    spark = requests.sparkSession
    root = scratch_folder(spark, "acks")
    left = requests.withWatermark("sent_at", late)
    right = acks.withColumnRenamed("request_id", "ack_id").withWatermark("acked_at", late)
    on = (F.col("request_id") == F.col("ack_id")) & F.expr(f"acked_at >= sent_at and acked_at <= sent_at + interval {timeout}")
    joined = left.join(right, on, "leftOuter").drop("ack_id")
    run(joined, lambda rows, n: rows.write.mode("overwrite").parquet(f"{root}/data/batch={n}"), f"{root}/checkpoint")
    return spark.read.schema(joined.schema).parquet(f"{root}/data").select(*joined.columns)
