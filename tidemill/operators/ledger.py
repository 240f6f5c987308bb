"""Accounting for bulk loads: requests, acknowledgements, batches and the verdict over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAFE = 2**53 - 1


def _whole(body: Column, key: str) -> Column:
    """A JSON member as a long if it is a whole number from 0 to 2^53 - 1, else null."""
    v = F.try_parse_json(body)
    member = F.try_variant_get(v, f"$.{key}", "variant")
    number = F.try_variant_get(v, f"$.{key}", "double")
    kind = F.schema_of_variant(member)
    fine = ~kind.isin("STRING", "VOID", "BOOLEAN") & (number == F.floor(number)) & number.between(0.0, float(SAFE))
    return F.when(F.coalesce(fine, F.lit(False)), number.cast("long"))


def read_acks(acks: DataFrame, body: str = "body") -> DataFrame:
    """``acks`` with ``request_id``, ``affected_rows`` and ``well_formed``; the two are null unless both are well formed.

    Of a key that a body repeats the last value counts, as JSON parsers have it.
    """
    spark, repeats = acks.sparkSession, "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(repeats, None)
    try:
        spark.conf.set(repeats, "true")  # read when the expression is analysed, which is here
        out = acks.withColumns({"__id": _whole(F.col(body), "request_id"), "__rows": _whole(F.col(body), "affected_rows")})
    finally:
        spark.conf.unset(repeats) if before is None else spark.conf.set(repeats, before)
    fine = F.col("__id").isNotNull() & F.col("__rows").isNotNull()
    return out.withColumns({"request_id": F.when(fine, F.col("__id")), "affected_rows": F.when(fine, F.col("__rows")), "well_formed": fine}).drop("__id", "__rows")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` by ``key`` in ``spark.sql.shuffle.partitions`` parts, which are not merged again.

    For keys that hardly repeat: combining before the shuffle would hold all
    keys of a file split, and adaptive merging those of a core's whole share.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def first_acks(acks: DataFrame) -> DataFrame:
    """Per request id the ack that arrived first (``seq``): later ones find nothing to resolve."""
    # By column, not by a struct, for which Spark would sort the rows on either side of the shuffle.
    rows = dealt(acks.where("request_id is not null").select("request_id", "seq", "affected_rows", "ok"), "request_id")
    return rows.groupBy("request_id").agg(F.min("seq").alias("acked_at"), *(F.min_by(c, "seq").alias(c) for c in ("affected_rows", "ok")))


def reconciled(requests: DataFrame, acks: DataFrame) -> DataFrame:
    """Every request with its first ack, nulls where none came; acks of unknown ids resolve nothing."""
    return requests.join(first_acks(acks), "request_id", "left")


def pending(requests: DataFrame, acks: DataFrame) -> DataFrame:
    """Requests without any ack."""
    return requests.join(acks.select("request_id").where("request_id is not null"), "request_id", "left_anti")


def batch_rollup(reconciled_rows: DataFrame) -> DataFrame:
    """Per batch: frames, acked and failed frames, rows, and status: pending until all frames are acked, then failed if any is."""
    per = reconciled_rows.groupBy("batch_id").agg(
        F.count("*").alias("frames"), F.count("acked_at").alias("acked"), F.count_if(F.col("acked_at").isNotNull() & ~F.col("ok")).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("affected_rows"))), F.lit(0)).cast("long").alias("affected_rows"),
    )
    return per.withColumn("status", F.when(F.col("acked") < F.col("frames"), "pending").when(F.col("failed") > 0, "failed").otherwise("ok"))


def summary(requests: DataFrame, acks: DataFrame) -> DataFrame:
    """One row: batches with a frame; the rows of every well-formed ack before the first malformed one, whatever it answers; and those of first acks of known requests only."""
    broken = acks.where("not well_formed").agg(F.min("seq").alias("stop"))
    heard = acks.join(F.broadcast(broken), F.col("stop").isNull() | (F.col("seq") < F.col("stop")), "inner").where("well_formed")
    raw = heard.agg(F.coalesce(F.sum("affected_rows"), F.lit(0)).cast("long").alias("total_affected_rows"))
    once = reconciled(requests, heard).agg(F.countDistinct("batch_id").alias("total_requests"), F.coalesce(F.sum("affected_rows"), F.lit(0)).cast("long").alias("distinct_affected_rows"))
    return once.join(F.broadcast(raw), F.lit(True))


def verdict(reconciled_rows: DataFrame, rejected: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Whether a load is whole, a row for each load (``by``; without it, all rows are one).

    ``rejected`` has ``batch_id, error`` (and ``by``) of batches that were
    refused before they were sent. A load with unanswered requests is
    ``pending``, else with refused batches ``rejected``, else with a batch of
    which any frame failed ``failed``, else ``complete``. ``first_id`` is the
    least request or batch of that kind and ``first_error`` what is known of
    it; ``pending`` lists all unanswered requests.
    """
    unanswered = F.when(F.col("acked_at").isNull(), F.col("request_id"))
    bad = F.when(F.col("acked_at").isNotNull() & ~F.coalesce(F.col("ok"), F.lit(True)), F.col("batch_id"))
    # Batch by batch first: two distinct counts at once would write each row three times.
    batches = reconciled_rows.groupBy(*by, "batch_id").agg(F.count(unanswered).alias("__n"), F.min(unanswered).alias("__p"), F.min(bad).alias("__f"))
    per = batches.groupBy(*by).agg(F.count("batch_id").alias("batches"), F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("pending"), F.min("__p").alias("__p"), F.count("__f").alias("failed"), F.min("__f").alias("__f"))
    if rejected is None:
        per = per.withColumns({"rejected": F.lit(0).cast("long"), "__r": F.lit(None).cast("struct<batch_id:bigint,error:string>")})
    else:
        refused = rejected.groupBy(*by).agg(F.count_distinct("batch_id").alias("rejected"), F.min(F.struct(F.col("batch_id").cast("long").alias("batch_id"), "error")).alias("__r"))
        per = per.join(refused, list(by), "full") if by else per.crossJoin(F.broadcast(refused))
        per = per.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("batches", "pending", "failed", "rejected")})
    kind = F.when(F.col("pending") > 0, "pending").when(F.col("rejected") > 0, "rejected").when(F.col("failed") > 0, "failed").otherwise("complete")
    first = F.when(F.col("pending") > 0, F.col("__p")).when(F.col("rejected") > 0, F.col("__r.batch_id")).otherwise(F.col("__f"))
    error = F.when(kind == "pending", "no ack").when(kind == "rejected", F.col("__r.error")).when(kind == "failed", "frame failed")
    return per.select(*by, "batches", "pending", "rejected", "failed", kind.alias("verdict"), first.alias("first_id"), error.alias("first_error"))


def newest(ledger: DataFrame, n: int, order: str = "settled_seq") -> DataFrame:
    """The ``n`` latest entries, oldest dropped first."""
    if not isinstance(n, int) or isinstance(n, bool) or n < 1:
        raise ValueError("n must be a whole number of at least 1")
    return ledger.orderBy(F.desc(order)).limit(n)


def last_write_wins(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """One row per ``keys``: the one with the greatest ``sequence``, which should be a total order.

    An aggregation with partial results, so a hot series is combined before
    the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*sequence)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


#: Latencies are kept to three significant digits, as whole milliseconds up to ten minutes.
DIGITS_BITS, LONGEST_MS = 11, 600_000


def latency_bucket(latency_ms: Column) -> Column:
    """The least whole number of milliseconds that counts as the same latency: up to 2,047 each by itself, then 1,024 steps for each doubling.

    Latencies below 0 count as 0, and those above ten minutes as ten minutes,
    so there are at most 11,264 buckets.
    """
    ms = F.greatest(F.lit(0), F.least(F.lit(LONGEST_MS), F.floor(latency_ms))).cast("long")
    shift = F.greatest(F.length(F.bin(ms)) - DIGITS_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", ms, shift), shift)


def _bucket_top(bucket: Column) -> Column:
    """The greatest latency that counts as ``bucket``."""
    shift = F.greatest(F.length(F.bin(bucket)) - DIGITS_BITS, F.lit(0))
    return bucket + F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1


def latency_histogram(batches: DataFrame, by: list[str], rows: str, started: str, ended: str) -> DataFrame:
    """Per ``by`` and latency bucket: ``batches``, their ``rows``, when the first began (``begun_us``) and the last ended (``done_us``).

    Of fixed size for each ``by``, whatever the number of batches; tasks add
    up their own part before anything is sent. A batch without an end has no
    latency yet: its rows and bucket are left out.
    """
    begun, done = (F.unix_micros(F.col(c).cast("timestamp")) for c in (started, ended))
    ended_ones = batches.select(*by, F.col(rows).alias("__rows"), begun.alias("__begun"), done.alias("__done")).where("__begun is not null and __done is not null")
    bucket = latency_bucket((F.col("__done") - F.col("__begun")) / 1000)
    return ended_ones.groupBy(*by, bucket.alias("bucket_ms")).agg(
        F.count("*").alias("batches"), F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"), F.min("__begun").alias("begun_us"), F.max("__done").alias("done_us")
    )


def merged_histograms(by: list[str], *parts: DataFrame) -> DataFrame:
    """Histograms of parts of a load as that of the whole."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*by, "bucket_ms").agg(F.sum("batches").alias("batches"), F.sum("rows").alias("rows"), F.min("begun_us").alias("begun_us"), F.max("done_us").alias("done_us"))


def throughput(histogram: DataFrame, by: list[str], shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Per ``by`` of a latency histogram: ``rows``, ``elapsed_ms``, ``rows_per_s`` and percentiles.

    Elapsed time goes from the first begin to the last end, so batches may
    overlap. A percentile is the top of the first bucket with which so large a
    share of the batches is reached: at most 0.1 % above the exact one.
    """
    order = Window.partitionBy(*by).orderBy("bucket_ms")  # 11,264 rows at most
    reached = histogram.withColumns({"__upto": F.sum("batches").over(order), "__all": F.sum("batches").over(Window.partitionBy(*by))})
    top = F.least(F.lit(LONGEST_MS).cast("long"), _bucket_top(F.col("bucket_ms")))
    at = [F.min(F.when(F.col("__upto") >= F.greatest(F.lit(1), F.ceil(F.lit(s) * F.col("__all"))), top)).cast("double").alias(f"p{s * 100:g}_ms") for s in shares]
    per = reached.groupBy(*by).agg(F.sum("rows").alias("rows"), ((F.max("done_us") - F.min("begun_us")) / 1000).alias("elapsed_ms"), *at)
    rate = F.when(F.col("elapsed_ms") > 0, F.col("rows") / (F.col("elapsed_ms") / 1000))
    return per.select(*by, "rows", "elapsed_ms", rate.alias("rows_per_s"), *(f"p{s * 100:g}_ms" for s in shares))


def series_cardinality(df: DataFrame, tags: list[str], exact: bool = True) -> DataFrame:
    """Distinct tag tuples, nulls counted as values."""
    whole = F.struct(*tags)
    return df.agg((F.count_distinct(whole) if exact else F.approx_count_distinct(whole)).alias("series"))


def series_sketches(df: DataFrame, by: list[str], tags: list[str], precision: int = 13) -> DataFrame:
    """Per ``by``, such as a write: how many ``rows``, and a sketch of its distinct tag tuples, 2^``precision`` registers at most, to be kept beside the ledger."""
    whole = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.length(F.col(t).cast("string")).cast("string"), F.lit(":"), F.col(t).cast("string")), F.lit("-")) for t in tags))
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.hll_sketch_agg(whole, F.lit(precision)).alias("series"))


def sketched_cardinality(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """About how many series any set of writes has together, by ``by`` or overall, from their sketches alone; within 2 % of the exact number for two writes in a row of standard errors (0.81 % at precision 13)."""
    return sketches.groupBy(*(by or [])).agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("series")).alias("series"))
