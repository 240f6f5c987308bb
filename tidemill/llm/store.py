"""Tables written once in the cluster's shared folder, to cut lineage and to be read several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of an Arrow batch, where rows are long.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset in local mode, as in tests, a new temporary one."""
    set_to = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        return set_to.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, conf: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which survives lost executors; settings in ``conf`` hold for its job.

    Once the table stands, nothing reads its shuffle files again; they are
    deleted then, not when the driver next collects its garbage.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    conf = {CLEANUP: "true"} | (conf or {})
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``written`` that no later step reads."""
    for df in tables:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


#: Tables of at most so many rows of a key and little else are broadcast; larger ones are joined by shuffle, with the same result.
SMALL_ROWS = 200_000


def small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """``df``, a table that is cheap to read, marked for broadcast if its size, counted here, allows; ``weight`` says for how many rows one counts."""
    rows = df.count() if weight is None else df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    return F.broadcast(df) if rows <= SMALL_ROWS else df
