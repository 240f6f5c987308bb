"""Reads over series: instant and stepped lookups, aggregates over windows, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def instant(df: DataFrame, tags: list[str], ts: str, value: str, at: Column, lookback_us: int) -> DataFrame:
    """Per series its last sample in (at - lookback, at]; of samples at one instant the greatest value."""
    us, now = micros(F.col(ts)), micros(at)
    near = df.where((us <= now) & (us > now - lookback_us))
    return near.groupBy(*tags).agg(F.max(F.struct(F.col(ts).alias("t"), F.col(value).alias("v"))).alias("s")).select(*tags, F.col("s.t").alias(ts), F.col("s.v").alias(value))


def stepped(df: DataFrame, ts: str, start_us: int, end_us: int, step_us: int, lookback_us: int) -> DataFrame:
    """Each sample once per step whose window (t - lookback, t] holds it, as ``step`` in microseconds.

    The steps follow from the sample's own time by arithmetic, so nothing is
    joined with the grid; rows grow by lookback / step.
    """
    us = micros(F.col(ts))
    last = (end_us - start_us) // step_us
    first_k = F.greatest(F.lit(0), F.ceil((us - start_us) / step_us)).cast("long")
    last_k = F.least(F.lit(last), F.ceil((us - start_us + lookback_us) / step_us) - 1).cast("long")
    near = df.where((us > start_us - lookback_us) & (us <= end_us)).withColumns({"__a": first_k, "__b": last_k}).where("__a <= __b")
    return near.withColumn("__k", F.explode(F.sequence("__a", "__b"))).withColumn("step", F.col("__k") * step_us + start_us).drop("__a", "__b", "__k")


def evaluated(df: DataFrame, tags: list[str], ts: str, value: str, start_us: int, end_us: int, step_us: int, lookback_us: int) -> DataFrame:
    """Per series and step: the last sample, and sum, average, maximum and count over the window."""
    at = stepped(df, ts, start_us, end_us, step_us, lookback_us)
    v = F.col(value)
    return at.groupBy(*tags, "step").agg(F.max(F.struct(F.col(ts).alias("t"), v.alias("v")))["v"].alias("last"), F.sum(v).alias("sum"), F.avg(v).alias("avg"), F.max(v).alias("max"), F.count(v).alias("samples"))


def rates(df: DataFrame, tags: list[str], ts: str, value: str, start_us: int, end_us: int, step_us: int, lookback_us: int) -> DataFrame:
    """Per series and step: change from the window's first to its last sample, per second between them; windows of one instant are left out."""
    at = stepped(df, ts, start_us, end_us, step_us, lookback_us)
    sample = F.struct(micros(F.col(ts)).alias("t"), F.col(value).alias("v"))
    ends = at.groupBy(*tags, "step").agg(F.min(sample).alias("a"), F.max(sample).alias("b")).where("b.t > a.t")
    return ends.select(*tags, "step", ((F.col("b.v") - F.col("a.v")) / ((F.col("b.t") - F.col("a.t")) / 1e6)).alias("rate"))


#: A series: its tags as one value, in which null equals null.
SERIES = "__series"


def _samples(df: DataFrame, tags: list[str], ts: str, holds: Column) -> DataFrame:
    at = df.select(F.struct(*tags).alias(SERIES), micros(F.col(ts)).alias("us"), F.coalesce(holds, F.lit(False)).alias("on"))
    return at.where("us is not null").groupBy(SERIES, "us").agg(F.bool_or("on").alias("on"))


def condition_runs(samples: DataFrame, slice_us: int) -> DataFrame:
    """Runs of true samples (``us, on``) of a series with no false one between: ``started, last_true``, and ``false_at``, the sample that ended it.

    A series is cut into slices of time. Windows over all of a series hold a
    row per slice; they say for each slice where the run began that is open at
    its edge, and the parts of a run meet by aggregation. So no task has all
    samples, or all runs, of a long series.
    """
    cut = samples.withColumn("slice", F.floor(F.col("us") / slice_us))
    inside, along = Window.partitionBy(SERIES, "slice").orderBy("us"), Window.partitionBy(SERIES).orderBy("slice")
    new = F.col("on") & ~F.coalesce(F.lag("on").over(inside), F.lit(False))
    marked = cut.withColumns({"new": new, "next_us": F.lead("us").over(inside), "first": F.row_number().over(inside) == 1}).withColumn("run", F.sum(F.col("new").cast("int")).over(inside))
    edges = marked.groupBy(SERIES, "slice").agg(F.min(F.struct("us", "on")).alias("a"), F.max(F.struct("us", "on")).alias("z"), F.max(F.when(F.col("new"), F.col("us"))).alias("began"))
    edges = edges.withColumns({"on_before": F.coalesce(F.lag("z.on").over(along), F.lit(False)), "false_next": F.lead(F.when(~F.col("a.on"), F.col("a.us"))).over(along)})
    own = F.when(F.col("z.on") & ~((F.col("began") == F.col("a.us")) & F.col("on_before")), F.col("began"))
    edges = edges.select(SERIES, "slice", "on_before", "false_next", F.last(own, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("open_since"))
    runs = marked.where("on").groupBy(SERIES, "slice", "run").agg(F.min("us").alias("started"), F.max("us").alias("last_true"), F.max_by("next_us", "us").alias("false_in"), F.bool_or("first").alias("first"))
    parts = runs.join(edges, [SERIES, "slice"]).withColumn("begin", F.when(F.col("first") & F.col("on_before"), F.col("open_since")).otherwise(F.col("started")))
    return parts.groupBy(SERIES, "begin").agg(F.max("last_true").alias("last_true"), F.max_by(F.coalesce("false_in", "false_next"), "started").alias("false_at")).withColumnRenamed("begin", "started")


def alerts(df: DataFrame, tags: list[str], ts: str, holds: Column, for_us: int, keep_us: int, slice_us: int = 86_400_000_000) -> DataFrame:
    """Alert episodes per series: ``started, last_true, fired_at, ended_at, state``.

    The condition holds from a true sample until the next false one. An episode
    is pending from its first true sample and fires once the condition has held
    for ``for_us``. A pending one ends at the first false sample. A firing one
    goes on for ``keep_us`` after its last true sample; true samples within
    that time belong to it, false ones between them or not. Either is open,
    with a null ``ended_at``, while the last sample of its series is true.
    Samples without a time are left out.

    Runs no further apart than ``keep_us`` are a chain, in which every run from
    the first that fires on is one episode. Chains are followed from slice to
    slice as runs are: where the last chain began, and whether it has fired.
    """
    runs = condition_runs(_samples(df, tags, ts, holds), slice_us).withColumn("slice", F.floor(F.col("started") / slice_us))
    inside, along = Window.partitionBy(SERIES, "slice").orderBy("started"), Window.partitionBy(SERIES).orderBy("slice")
    last = runs.groupBy(SERIES, "slice").agg(F.max("last_true").alias("last")).select(SERIES, "slice", F.lag("last").over(along).alias("last_before"))
    placed = runs.withColumn("prev", F.lag("last_true").over(inside)).join(last, [SERIES, "slice"])
    apart = F.coalesce(F.col("started") - F.coalesce("prev", "last_before") > keep_us, F.lit(True))
    placed = placed.withColumns({"apart": apart, "fires": F.col("last_true") - F.col("started") >= for_us})
    placed = placed.withColumn("chain", F.last(F.when(F.col("apart"), F.col("started")), ignorenulls=True).over(inside))
    none = -(1 << 63)
    ends = placed.groupBy(SERIES, "slice").agg(F.max(F.struct(F.coalesce("chain", F.lit(none)).alias("chain"), F.col("fires"))).alias("end"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("end.chain") > none, F.col("end.chain"))
    ends = ends.select(SERIES, "slice", F.col("end.fires").alias("fires"), begun.alias("begun"), F.last(begun, ignorenulls=True).over(before).alias("open_chain"))
    so_far = F.max("fires").over(Window.partitionBy(SERIES, F.coalesce("begun", "open_chain")).orderBy("slice"))
    ends = ends.withColumn("so_far", so_far).select(SERIES, "slice", "open_chain", F.lag("so_far").over(along).alias("fired_before"))
    chained = placed.join(ends, [SERIES, "slice"])
    fired = F.max("fires").over(Window.partitionBy(SERIES, "slice", "chain").orderBy("started")) | (F.col("chain").isNull() & F.coalesce("fired_before", F.lit(False)))
    chained = chained.withColumn("firing", fired).withColumn("chain", F.coalesce("chain", "open_chain"))
    own = F.when(F.col("firing"), F.lit(None)).otherwise(F.col("started"))
    per = chained.groupBy(SERIES, "chain", own.alias("own"), "firing").agg(F.min("started").alias("started"), F.max("last_true").alias("last_true"), F.max_by("false_at", "last_true").alias("false_at"))
    fired_at = F.when(F.col("firing"), F.col("started") + for_us)
    ended = F.when(F.col("firing") & F.col("false_at").isNotNull(), F.col("last_true") + keep_us).when(~F.col("firing"), F.col("false_at"))
    return per.select(*(F.col(f"{SERIES}.`{t}`").alias(t) for t in tags), "started", "last_true", fired_at.alias("fired_at"), ended.alias("ended_at"), F.when(F.col("firing"), "firing").otherwise("pending").alias("state"))
