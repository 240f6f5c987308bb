"""Series tables: rows in buckets of series, a sequence number for each write, and a log of deletes that reads apply."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger, timeseries
from ..operators.conform import conformed
from ..operators.spec import TableSpec
from . import catalog
from .store import scratch_folder

SEQUENCE, WHOLE, GONE = "_seq", "_whole", "__gone"


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys])


def live(rows: DataFrame, deletes: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Rows later than the last delete of their ``keys``, by ``sequence``; null keys match null ones.

    Deletes are reduced to one row a key first, so a hot series has one row to
    meet.
    """
    last = deletes.groupBy(*keys).agg(F.max(sequence).alias("__upto")).select(*(F.col(k).alias(f"__{k}") for k in keys), "__upto")
    return rows.join(last, _same(rows, last, keys), "left").where(F.col("__upto").isNull() | (F.col(sequence) > F.col("__upto"))).select(*rows.columns)


class SeriesTable:
    """A catalog table bucketed and sorted by series, and its log of deletes; one writer at a time.

    Rows of a series are in one bucket, so reads by series, such as last
    writes and instant lookups, shuffle nothing. Each ``write`` and ``delete``
    takes the next sequence number. A key deleted and written again lives.
    """

    def __init__(self, spark: SparkSession, name: str, spec: TableSpec):
        self.spark, self.name, self.spec = spark, name, spec

    def create(self, buckets: int = 200) -> None:
        if not self.spec.tags:
            raise ValueError(f"{self.name}: a series table needs a tag")
        columns = ", ".join(f"{catalog.quoted(c.name)} {c.field().dataType.simpleString()}" for c in self.spec.columns)
        tags = ", ".join(map(catalog.quoted, self.spec.tags))
        held = {f"column.{c.name}": f"{c.semantic}:{c.type}" for c in self.spec.columns} | {"sequence": "0", "deletes": "0", "buckets": str(buckets)}
        self.spark.sql(f"CREATE TABLE {catalog.quoted(self.name)} ({columns}, {SEQUENCE} BIGINT) USING parquet CLUSTERED BY ({tags}) SORTED BY ({tags}, {catalog.quoted(self.spec.time)}) INTO {buckets} BUCKETS TBLPROPERTIES ({catalog._properties(held)})")
        keys = ", ".join(f"{catalog.quoted(c.name)} {c.field().dataType.simpleString()}" for c in self.spec.columns if c.semantic != "field")
        self.spark.sql(f"CREATE TABLE {catalog.quoted(self.name + GONE)} ({keys}, {WHOLE} BOOLEAN, {SEQUENCE} BIGINT) USING parquet")

    def _next(self) -> int:
        number = int(catalog.options_of(self.spark, self.name)["sequence"]) + 1
        catalog.set_options(self.spark, self.name, {"sequence": str(number)})
        return number

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        buckets = int(catalog.options_of(self.spark, self.name)["buckets"])
        return rows.repartition(buckets, *self.spec.tags)

    def write(self, rows: DataFrame) -> int:
        """Append ``rows``, conformed; their sequence number."""
        number = self._next()
        self._bucketed(conformed(rows, self.spec).withColumn(SEQUENCE, F.lit(number).cast("long"))).write.insertInto(catalog.quoted(self.name))
        return number

    def delete(self, keys: DataFrame) -> int:
        """Delete what was written so far of whole series (``keys`` has the tags), or at single times (tags and time)."""
        wanted = [*self.spec.tags, self.spec.time]
        if set(keys.columns) not in (set(self.spec.tags), set(wanted)):
            raise ValueError(f"{self.name}: keys are {self.spec.tags}, with or without {self.spec.time}")
        whole, number = self.spec.time not in keys.columns, self._next()
        kinds = {c.name: c.field().dataType for c in self.spec.columns}
        cells = [(F.lit(None) if whole and c == self.spec.time else F.col(c)).cast(kinds[c]).alias(c) for c in (x.name for x in self.spec.columns if x.semantic != "field")]
        catalog.set_options(self.spark, self.name, {"deletes": str(number)})
        keys.select(*cells, F.lit(whole), F.lit(number).cast("long")).write.insertInto(catalog.quoted(self.name + GONE))
        return number

    def _stored(self) -> DataFrame:
        rows, gone = self.spark.table(catalog.quoted(self.name)), self.spark.table(catalog.quoted(self.name + GONE))
        if catalog.options_of(self.spark, self.name)["deletes"] == "0":
            return rows
        rows = live(rows, gone.where(WHOLE), self.spec.tags, SEQUENCE)
        return live(rows, gone.where(~F.col(WHOLE)), [*self.spec.tags, self.spec.time], SEQUENCE)

    def rows(self) -> DataFrame:
        """All live rows."""
        return self._stored().drop(SEQUENCE)

    def last_writes(self) -> DataFrame:
        """One live row for each series and time: that of the last write, the greatest one among those of one write."""
        rows = self._stored()
        fields = [c.name for c in self.spec.columns if c.semantic == "field"]
        kept = ledger.last_write_wins(rows, [*self.spec.tags, self.spec.time], [SEQUENCE, *fields])
        return kept.drop(SEQUENCE)

    def instant(self, value: str, at: Column, lookback_us: int) -> DataFrame:
        """Per series its last live sample in (at - lookback, at]."""
        return timeseries.instant(self._stored(), self.spec.tags, self.spec.time, value, at, lookback_us)

    def compact(self) -> None:
        """Keep live last writes only, and forget the deletes that they have survived.

        What is kept stands in a scratch table before the old files go; a
        failure after that leaves deletes that find nothing.
        """
        at = scratch_folder(self.spark, "compact")
        rows, fields = self._stored(), [c.name for c in self.spec.columns if c.semantic == "field"]
        kept = ledger.last_write_wins(rows, [*self.spec.tags, self.spec.time], [SEQUENCE, *fields])
        kept.write.parquet(at)
        held = self.spark.read.schema(kept.schema).parquet(at)
        self._bucketed(held).write.mode("overwrite").insertInto(catalog.quoted(self.name))
        self.spark.sql(f"TRUNCATE TABLE {catalog.quoted(self.name + GONE)}")
        catalog.set_options(self.spark, self.name, {"deletes": "0"})
