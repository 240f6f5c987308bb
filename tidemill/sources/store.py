"""Tables that take writes as wholes: batch writes of many tables, bulk loads, mixed kinds, create-or-fail."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.types import SchemaError
from ..operators.conform import conformed, conformed_columns
from ..operators.spec import TableSpec
from . import catalog

#: The column that a table's writes are partitions of.
WRITE = "_write"
#: Codecs that a bulk load takes.
CODECS = ("none", "lz4", "zstd")
_LOCAL: dict[str, str] = {}


class WriteError(RuntimeError):
    """A write that was refused or did not account for all its rows."""


class StateError(RuntimeError):
    """A call that the state of a writer does not allow."""


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; a temporary one where that is unset in local mode."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
        base = _LOCAL[app]
    return f"{base.rstrip('/')}/tidemill-{name}-{uuid.uuid4().hex}"


def checked_hints(hints: dict[str, str] | None) -> dict[str, str]:
    """``hints`` if no key is empty and none holds ``,`` or ``=``, in keys or values."""
    for k, v in (hints or {}).items():
        if not k or any(c in k + v for c in ",="):
            raise ValueError(f"bad hint {k!r}")
    return dict(hints or {})


def _agreeing(specs: dict[str, TableSpec]) -> list[dict[str, TableSpec]]:
    """``specs`` in as few groups as come up, each without two columns of one name that differ in case or type."""
    groups: list[tuple[dict[str, TableSpec], dict[str, tuple]]] = []
    for name, spec in specs.items():
        own = {c.name.lower(): (c.name, c.field().dataType) for c in spec.columns}
        home = next((g for g in groups if all(g[1].get(k, v) == v for k, v in own.items())), None)
        if home is None:
            groups.append(home := ({}, {}))
        home[0][name] = spec
        home[1].update(own)
    return [found for found, _ in groups]


def _of_kinds(df: DataFrame, kind: str, group: dict[str, TableSpec]) -> DataFrame:
    """Rows of all kinds in ``group``, each conformed to its own columns, those of others null, with the kind's place in ``__kind``."""
    cells: dict[str, list[Column]] = {}
    for name, spec in group.items():
        known = {c.source or c.name for c in spec.columns}
        values = conformed_columns(df.select(*(c for c in df.columns if c in known)), spec)
        for c, value in zip(spec.columns, values, strict=True):
            cells.setdefault(c.name, []).append(F.when(F.col(kind) == name, value))
    place = reduce(lambda rest, x: F.when(F.col(kind) == x[1], x[0]).otherwise(rest), enumerate(group), F.lit(None).cast("int"))
    return df.select(*(F.coalesce(*each).alias(name) for name, each in cells.items()), place.alias("__kind"))


class TableStore:
    """Tables of one database of Spark's catalog, with their files below one folder of any file system that Spark reaches.

    Each write is a folder of Parquet files, and a partition of its table once
    the catalog says so. Writes go where they will stay and are published by a
    call to the catalog, so nothing is moved or copied, on object stores
    neither. A write of several tables first writes them all and only then
    publishes any, so a bad cell in one table leaves all as they were.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.database = f"tidemill_{hashlib.md5(self.root.encode()).hexdigest()}"
        catalog.create_database(spark, self.database, location=self.root)

    def name(self, table: str) -> str:
        """The table's name for SQL."""
        return catalog.quoted(f"{self.database}.{table}")

    def _deleted(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def create(self, spec: TableSpec, if_not_exists: bool = True) -> None:
        if self.exists(spec.name):
            if not if_not_exists:
                raise WriteError(f"{spec.name} exists")
            return
        if WRITE in spec.names:
            raise SchemaError(f"{spec.name}: {WRITE!r} is the store's own column")
        columns = ", ".join(f"{catalog.quoted(c.name)} {c.field().dataType.simpleString()}" for c in spec.columns)
        held = {f"column.{c.name}": f"{c.semantic}:{c.type}" for c in spec.columns}
        self.spark.sql(f"CREATE TABLE {self.name(spec.name)} ({columns}, {WRITE} STRING) USING parquet PARTITIONED BY ({WRITE}) LOCATION {catalog._text(f'{self.root}/{spec.name}')} TBLPROPERTIES ({catalog._properties(held)})")

    def schema(self, table: str) -> StructType:
        """The declared columns, with their semantics and types as metadata."""
        if not self.exists(table):
            raise WriteError(f"no table {table}")
        held = catalog.options_of(self.spark, f"{self.database}.{table}")
        told = {f.name: dict(zip(("semantic", "type"), held[f"column.{f.name}"].split(":"), strict=True)) for f in self.spark.table(self.name(table)).schema if f.name != WRITE}
        return StructType([StructField(f.name, f.dataType, True, told[f.name]) for f in self.spark.table(self.name(table)).schema if f.name != WRITE])

    def read(self, table: str) -> DataFrame:
        schema = self.schema(table)
        return self.spark.table(self.name(table)).select(*(F.col(catalog.quoted(f.name)).alias(f.name, metadata=f.metadata) for f in schema))

    def drop(self, table: str) -> None:
        """Drop the table and delete its files."""
        elsewhere = [v for k, v in catalog.options_of(self.spark, f"{self.database}.{table}").items() if k.startswith("folder.")] if self.exists(table) else []
        catalog.drop(self.spark, "table", f"{self.database}.{table}", if_exists=True)
        for path in (f"{self.root}/{table}", *elsewhere):
            self._deleted(path)

    def _staged(self, df: DataFrame, at: str, codec: str, options: dict[str, str]) -> int:
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.options(**options).option("compression", codec).parquet(at)
        return int(seen.get["rows"])

    def _publish(self, table: str, write: str, folder: str | None = None) -> None:
        """Make a write a part of its table; ``folder`` is where its files are, if not in the table's own."""
        where = f" LOCATION {catalog._text(folder)}" if folder else ""
        if folder:
            catalog.set_options(self.spark, f"{self.database}.{table}", {f"folder.{write}": folder})
        self.spark.sql(f"ALTER TABLE {self.name(table)} ADD PARTITION ({WRITE} = {catalog._text(write)}){where}")

    def write(self, tables: list[tuple[TableSpec, DataFrame]], by: str = "name", hints: dict[str, str] | None = None, codec: str = "zstd") -> dict[str, int]:
        """Append to one or many tables; rows written per table.

        Counts come from the writes themselves. With the hint
        ``auto_create_table=false`` a missing table is an error and is not
        created; otherwise the first write creates it. Other hints are options
        of the Parquet writer.
        """
        options = checked_hints(hints)
        create = options.pop("auto_create_table", "true") != "false"
        declared = {}
        for spec, _ in tables:
            if declared.setdefault(spec.name, spec.schema()) != spec.schema():
                raise SchemaError(f"{spec.name}: two schemas in one call")
            if not self.exists(spec.name) and not create:
                raise WriteError(f"no table {spec.name}")
            if self.exists(spec.name) and self.schema(spec.name) != spec.schema():
                raise SchemaError(f"{spec.name}: schema differs from the table's")
        writes, counts = [uuid.uuid4().hex for _ in tables], {}
        try:
            for (spec, df), write in zip(tables, writes, strict=True):
                counts[spec.name] = counts.get(spec.name, 0) + self._staged(conformed(df, spec, by), f"{self.root}/{spec.name}/{WRITE}={write}", codec, options)
        except Exception:
            for (spec, _), write in zip(tables, writes, strict=True):
                self._deleted(f"{self.root}/{spec.name}" + (f"/{WRITE}={write}" if self.exists(spec.name) else ""))
            raise
        for (spec, _), write in zip(tables, writes, strict=True):
            self.create(spec)
            self._publish(spec.name, write)
        return counts

    def write_kinds(self, df: DataFrame, kind: str, specs: dict[str, TableSpec], codec: str = "zstd") -> dict[str, int]:
        """Append each row to the table that ``specs`` declares for its ``kind``; rows written per table.

        Columns come in declared order, renamed by their source, missing ones
        null. A row of a kind without a declaration, null among them, is a
        SchemaError, and nothing is written; a pass over the kinds alone finds
        it first. Kinds whose columns agree in type where they share a name
        are written by one job, each row once, as folders of one table;
        each folder then becomes a part of its kind's table.
        """
        for spec in specs.values():
            if self.exists(spec.name) and self.schema(spec.name) != spec.schema():
                raise SchemaError(f"{spec.name}: schema differs from the table's")
        stray = ~F.coalesce(F.col(kind).isin(*specs) if specs else F.lit(False), F.lit(False))
        odd = df.where(stray).agg(F.count("*").alias("n"), F.min(F.coalesce(F.col(kind), F.lit("null"))).alias("first")).first()
        if odd["n"]:
            raise SchemaError(f"{odd['n']} rows of kinds without columns, such as {odd['first']!r}")
        at, counts, staged = f"{self.root}/_kinds/{uuid.uuid4().hex}", {spec.name: 0 for spec in specs.values()}, []
        try:
            for k, group in enumerate(_agreeing(specs)):
                seen = Observation()
                rows = _of_kinds(df.where(F.col(kind).isin(*group)), kind, group)
                tally = [F.count_if(F.col("__kind") == n).alias(f"n{n}") for n in range(len(group))]
                rows.observe(seen, *tally).write.option("compression", codec).partitionBy("__kind").parquet(f"{at}/{k}")
                for n, spec in enumerate(group.values()):
                    counts[spec.name] += seen.get[f"n{n}"]
                    staged.append((f"{at}/{k}/__kind={n}", spec, seen.get[f"n{n}"]))
        except Exception:
            self._deleted(at)
            raise
        for folder, spec, rows in staged:
            self.create(spec)
            if rows:
                self._publish(spec.name, uuid.uuid4().hex, folder)
        return counts

    def bulk_load(self, df: DataFrame, spec: TableSpec, batch: str, parallelism: int | None = None, codec: str = "none", rows_per_file: int = 0, announced: DataFrame | None = None) -> DataFrame:
        """Load ``df`` into an existing table of exactly this schema; the ledger: rows per value of its column ``batch``.

        Batches in ``announced`` (``batch_id``) that have no row are in the
        ledger with 0.

        Files follow the partitions of ``df``, so a load has as many tasks as
        its input has; ``parallelism`` deals rows over so many tasks instead.

        The batch number goes into the files beside the declared columns, which
        is all that reads of the table see, so the ledger counts what was
        committed. ``batch`` need not be a declared column.
        """
        if codec not in CODECS:
            raise ValueError(f"codec must be one of {CODECS}")
        if not self.exists(spec.name):
            raise WriteError(f"no table {spec.name}")
        if self.schema(spec.name) != spec.schema():
            raise SchemaError(f"{spec.name}: schema differs from the table's")
        write = uuid.uuid4().hex
        at = f"{self.root}/{spec.name}/{WRITE}={write}"
        rest = df.columns if batch in spec.names else [c for c in df.columns if c != batch]
        whole = conformed(df.select(*rest, F.col(batch).alias("_batch")), spec, profile="bulk", keep=("_batch",))
        whole = whole.withColumns({c.name: F.col(c.name).cast("string").alias(c.name, metadata=c.field().metadata) for c in spec.columns if c.type == "Json"})  # stored as text
        whole = whole.repartition(parallelism) if parallelism else whole
        try:
            whole.write.option("compression", codec).option("maxRecordsPerFile", rows_per_file).parquet(at)
        except Exception:
            self._deleted(at)
            raise
        staged = self.spark.read.schema(whole.schema).parquet(at)
        ledger = staged.groupBy(F.col("_batch").alias("batch_id")).agg(F.count("*").alias("affected_rows"))
        if announced is not None:
            none = announced.select("batch_id").distinct().join(ledger, "batch_id", "left_anti")
            ledger = ledger.union(none.select(F.col("batch_id").cast(ledger.schema["batch_id"].dataType), F.lit(0).cast("long")))
        held = f"{self.root}/_ledger/{uuid.uuid4().hex}"
        ledger.write.parquet(held)
        self._publish(spec.name, write)
        return self.spark.read.schema(ledger.schema).parquet(held)


class StreamWriter:
    """Many writes and one total: ``open`` until ``finish`` or ``cancel``, or ``errored`` once a write fails.

    Each write appends to one or many tables at once; tables may differ from
    write to write. Nothing is retried. What was written before ``cancel`` or
    an error stays.
    """

    def __init__(self, store: TableStore, hints: dict[str, str] | None = None):
        self.store, self.hints, self.state, self.total = store, checked_hints(hints), "open", 0

    def write(self, tables: list[tuple[TableSpec, DataFrame]]) -> None:
        self._must_be_open("write")
        try:
            self.total += sum(self.store.write(tables, hints=self.hints).values())
        except Exception:
            self.state = "errored"
            raise

    def finish(self) -> int:
        """Rows of all writes."""
        self._must_be_open("finish")
        self.state = "closed"
        return self.total

    def cancel(self) -> None:
        if self.state == "open":
            self.state = "cancelled"

    def _must_be_open(self, call: str) -> None:
        if self.state != "open":
            raise StateError(f"{call}: the writer is {self.state}")
