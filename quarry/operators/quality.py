"""F5/F6 Gopher quality filter and F2-F4 article filters as DataFrame ops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.plan import materialized


def gopher_metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the F5 metrics struct's fields as columns."""
    return df.withColumn("_g", T.gopher_metrics(text_col)).select("*", "_g.*").drop("_g")


def gopher_filter(df: DataFrame, text_col: str = "text") -> DataFrame:
    """F6 ``filter_texts``: keep rows whose text passes F5 (order-free).

    The predicate is evaluated in a projection behind a generator barrier:
    a plain ``filter`` would be pushed below a round-robin repartition into
    the scan task, serialising the regex work of a single-split input.
    """
    cols = df.columns
    m = materialized(df.withColumn("_pass", T.gopher_passes(text_col)))
    return m.filter(F.col("_pass")).select(*cols)


def gopher_reject_reasons(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Count of documents per first failing rule (null = passed)."""
    return (df.select(T.gopher_metrics(text_col)["reason"].alias("reason"))
              .groupBy("reason").agg(F.count(F.lit(1)).alias("n_docs")))
