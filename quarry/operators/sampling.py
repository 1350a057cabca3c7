"""Ordered caps, reproducible samples, shuffles, balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.plan import materialized
from quarry.session import reliable_checkpoint


def md5_key(seed, col) -> Column:
    """Reproducible uniform order key (same value in Spark and SQL)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(col).cast("string") if isinstance(col, str) else col))


def url_sample(urls: DataFrame, n: int = 1000, seed: int = 42, url: str = "url") -> DataFrame:
    """O5 after F9: without-replacement sample of min(n, N) valid URLs (a top-n)."""
    valid = urls.select(F.trim(F.col(url)).alias(url)).filter(T.valid_url(url))
    return valid.orderBy(md5_key(seed, url), url).limit(n)


def shuffle_keys(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Uniform permutation key; ``orderBy('shuffle_key')`` is a range-partitioned sort."""
    return df.withColumn("shuffle_key", md5_key(seed, key))


def global_rank(df: DataFrame, order_col: str, partitions: int | None = None) -> DataFrame:
    """0-based rank by ``order_col`` (unique) via a two-level prefix count.

    Range partitions are counted (one row each) and ranks are running counts
    inside each partition: no single-task window over the rows.
    """
    spark = df.sparkSession
    p = partitions or max(1, spark.sparkContext.defaultParallelism)
    ranged = reliable_checkpoint(df.repartitionByRange(p, order_col).sortWithinPartitions(order_col)
                                   .withColumn("_pid", F.spark_partition_id()))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    base = sizes.select("_pid", (F.sum("_c").over(Window.orderBy("_pid")) - F.col("_c")).alias("_base"))
    inside = Window.partitionBy("_pid").orderBy(order_col)
    ranked = ranged.withColumn("_row", F.row_number().over(inside)).join(F.broadcast(base), "_pid")
    return ranked.withColumn("_rank", F.col("_base") + F.col("_row") - 1).drop("_pid", "_row", "_base")


def first_n(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """O2 first n rows in scan order (``order_col``, unique), exact at any n.

    Only the keys are ranked; the n-th key then bounds a plain filter on the
    source, which reaches its scan, so no row is moved for a cap.
    """
    if n <= 0:
        return df.limit(0)
    bound = global_rank(df.select(order_col), order_col).filter(F.col("_rank") < n).agg(F.max(order_col)).first()[0]
    return df.limit(0) if bound is None else df.filter(F.col(order_col) <= F.lit(bound))


def balance_classes(df: DataFrame, label: str, order_col: str, pos=1, neg=0) -> DataFrame:
    """Truncate both classes to the smaller class, keeping the first rows."""
    counts = {r[label]: r["c"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("c")).collect()}
    n = min(counts.get(pos, 0), counts.get(neg, 0))
    parts = [first_n(df.filter(F.col(label) == v), order_col, n) for v in (pos, neg)]
    return parts[0].unionByName(parts[1])


def fasttext_lines(texts: DataFrame, label_col: str, text: str = "text",
                   min_words: int = 30, max_words: int = 300) -> DataFrame:
    """M4: P11 + P12, keep > min_words words, ``__label__X text`` lines (K3)."""
    # behind a generator, so that the filter does not make the words a second time
    df = materialized(texts.withColumn("_words", F.slice(T.split_whitespace(text), 1, max_words)))
    line = F.concat(F.lit("__label__"), F.col(label_col), F.lit(" "), F.array_join("_words", " "))
    return df.filter(F.size("_words") > min_words).withColumn("line", line).drop("_words")
