"""Readers for the shared parquet tables (one parquet file or folder each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


# Tables whose rows carry heavy per-row work (regex over text, arrays).
_WIDE = {"documents", "pages", "conversations", "embeddings", "benchmark"}


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer splits than task slots.

    A file written as one row group is one input split, so every regex
    would run in a single task.  On a cluster reading many files this is a
    no-op; locally it costs one round-robin shuffle and buys all cores.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if name in _WIDE else df


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def labels(spark, sf_dir):
    return table(spark, sf_dir, "labels")


def conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def benchmark(spark, sf_dir):
    return table(spark, sf_dir, "benchmark")
