"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import reliable_checkpoint


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder, read by Spark alone (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a table of few input splits one partition per task slot.

    Tables of many splits pass through unshuffled; only an input smaller
    than the cluster is dealt out, so the shuffle stays small.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def settled(df: DataFrame) -> DataFrame:
    """Cut lineage with a checkpoint in the folder of ``spark.checkpoint.dir``."""
    return reliable_checkpoint(df)


def blocks_for(rows: int, per_block: int) -> int:
    """Number of blocks that keeps the mean block at ``per_block`` rows."""
    return max(1, math.ceil(rows / per_block))


def crc32_mod(col: Column, n: int) -> Column:
    """crc32 of a value's text modulo n (null stays null)."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n))


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that no column of ``df`` has, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
