"""Vectors that can be compared, and classes of equal vectors."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vectors: DataFrame, kind: str = "double") -> DataFrame:
    """(vec_id, v) without vectors that are null, empty, zero or hold null or non-finite components; elements of ``kind``."""
    v = F.col("v")
    every = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()) \
                  .select("vec_id", F.transform("embedding", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("v"))
    return rows.filter((F.size(v) > 0) & every & F.exists(v, lambda x: x != 0))


def usable(vectors: DataFrame) -> DataFrame:
    """The rows of ``finite``, repeated rows once."""
    return finite(vectors).dropDuplicates(["vec_id", "v"])


def digests(v: str) -> Column:
    """SHA-256 of a vector's components."""

    def run(vectors: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(np.ascontiguousarray(x).tobytes()).digest() for x in vectors], dtype=object)

    return F.pandas_udf(run, "binary")(F.col(v))


def classes(rows: DataFrame, least_ids: int, salts: int = 64) -> DataFrame:
    """One row per distinct vector: gid (smallest vec_id), n, ids (the ``least_ids`` smallest, sorted), v.

    A vector that a third of all rows share is cut down per salt first.
    """
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(salts))
    part = Window.partitionBy("v", "salt").orderBy("vec_id")
    counted = rows.withColumn("salt", salt).groupBy("v", "salt").agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy("v").agg(F.sum("n").alias("n"))
    least = rows.withColumn("salt", salt).withColumn("r", F.row_number().over(part)).filter(F.col("r") <= least_ids)
    whole = Window.partitionBy("v").orderBy("vec_id")
    least = least.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= least_ids)
    ids = least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return ids.join(sizes, "v").select(F.element_at("ids", 1).alias("gid"), "n", "ids", "v")


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of a double-array column as a matrix."""
    return np.stack(column.to_list()).astype(np.float64)
