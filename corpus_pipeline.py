"""The corpus pipeline: five stages, each over all that its predecessor kept.

Stages drop rows (quality, near copies, contamination), redact (secrets) or
repeat rows (mixing). A stage's decisions are keyed by ``row_key``, so rows
with null or equal ids are told apart by their texts; only rows that are equal
in both share a decision. An empty table passes through every stage; columns
beyond those of ``documents`` do not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontam, mixing, ngram_join, quality, secrets
from tidemill.llm.store import small, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key() -> Column:
    """Sorts by doc_id, negative ones first and null last, and differs where texts do."""
    above = F.col("doc_id").cast("decimal(20,0)") + F.expr("9223372036854775808BD")
    number = F.coalesce(F.lpad(above.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit("null"))
    return F.concat(number, F.lit(":"), F.coalesce(F.md5("text"), F.lit("null")))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``keys``."""
    return docs.withColumn("__key", row_key()).join(small(written(keys.toDF("__key"), "dropped")), "__key", "left_anti").drop("__key")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the perplexity quantile of their language accepts; models and quantiles come from trusted rows among ``docs``."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return quality.classified(docs, trusted).where("accepted").select(*COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, that with the least ``row_key``; of rows equal in id and text, the one whose other columns are least. Links are of five-word shingles, at a similarity of 0.8."""
    keyed = docs.select(row_key().alias("key"), "text")
    found = written(ngram_join.components(keyed, "key", "text", k=5, percent=80), "components")
    kept = _without(docs, found.where("key != component_id").select("key").distinct())
    repeated = written(found.groupBy("key").count().where("count > 1").select("key"), "repeated")
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    once = kept.withColumn("__key", row_key()).join(small(repeated.toDF("__key")), "__key", "left_semi")
    once = once.groupBy("__key").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return _without(kept, repeated).select(*COLUMNS).union(once.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.contamination(docs.select(row_key().alias("key"), "text"), items, key="key")
    return _without(docs, found.where("contaminated").select("key").distinct()).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with what the scan found replaced by a mark; ``n_chars`` follows the text where it changed."""
    found = secrets.secret_spans(docs.select(row_key().alias("key"), "text")).where(F.size("spans") > 0)
    found = written(found.select(F.col("key").alias("__key"), "spans").dropDuplicates(["__key"]), "spans")
    joined = docs.withColumn("__key", row_key()).join(small(found, F.size("spans")), "__key", "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(secrets.redacted(F.col("text"), F.col("spans")))
    chars = F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return joined.withColumn("n_chars", chars).withColumn("text", text).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, numbered in ``copy``."""
    return mixing.emitted(mixing.mixed_copies(docs)).select(*COLUMNS, "copy")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scan),
    ("mixing sources", source_mix),
]

#: Perplexities, components and redaction have no SQL; tests hold the stages and their operators against brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
