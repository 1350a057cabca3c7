"""K1-K8 sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import patterns as pt


def sentinel_records(df: DataFrame, text: str = "text") -> DataFrame:
    """K1 record: text followed by a newline and the end-of-text line."""
    return df.withColumn("_rec", F.concat(F.col(text), F.lit("\n" + pt.ENDOFTEXT)))


def write_sentinel_text(df: DataFrame, path: str, order_col: str = "doc_id", text: str = "text",
                        mode: str = "overwrite", partitions: int | None = None) -> None:
    """K1: ordered text corpus; range partitions keep global order across files."""
    p = partitions or df.sparkSession.sparkContext.defaultParallelism
    rec = sentinel_records(df, text)
    (rec.repartitionByRange(p, order_col).sortWithinPartitions(order_col)
        .select("_rec").write.mode(mode).option("lineSep", "\n").text(path))


def write_per_source(df: DataFrame, path: str, source_col: str = "source", mode: str = "overwrite") -> None:
    """K2: one output folder per input source (full key, so names never clobber)."""
    df.write.mode(mode).partitionBy(source_col).parquet(path)


def write_labelled(lines: DataFrame, path: str, shuffle_seed: int = 0, line: str = "line",
                   mode: str = "overwrite") -> None:
    """K3: ``__label__X text`` lines in a reproducible shuffled order."""
    key = F.md5(F.concat(F.lit(f"{shuffle_seed}:"), F.col(line)))
    lines.select(line, key.alias("_k")).orderBy("_k").select(line).write.mode(mode).text(path)


def save_model(spark, model, vocab_path: str, merges_path: str, mode: str = "overwrite") -> None:
    """K4: vocab as one JSON object (id -> hex), merges as ``hex hex`` lines.

    Both are bounded by the vocabulary size."""
    spark.createDataFrame([(model.vocab_json(),)], "value string").coalesce(1) \
         .write.mode(mode).text(vocab_path)
    rows = [(i, f"{a.hex()} {b.hex()}") for i, (a, b) in enumerate(model.merges)]
    spark.createDataFrame(rows, "rank int, value string").orderBy("rank").coalesce(1) \
         .select("value").write.mode(mode).text(merges_path)


def write_tokens(tokens: DataFrame, path: str, uint16: bool = False, ids: str = "ids",
                 mode: str = "overwrite") -> None:
    """K5: token table as parquet; ``uint16`` asserts ids fit 16 bits."""
    if uint16:
        wide = F.exists(ids, lambda x: (x < 0) | (x > 65535))
        tokens = tokens.withColumn(ids, F.when(wide, F.raise_error(F.lit("token id outside the uint16 range"))
                                               .cast(tokens.schema[ids].dataType)).otherwise(F.col(ids)))
    tokens.write.mode(mode).parquet(path)


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K6: cached stage - skip when a finished output exists; a half-written one is written anew."""
    if not finished(df.sparkSession, path):
        df.write.mode("overwrite").format(fmt).save(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a job has completed its output folder (its success marker is there)."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return bool(marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker))


def concat_corpora(*dfs: DataFrame) -> DataFrame:
    """Ordered bag union; ``src_ord`` keeps the corpus order."""
    out = None
    for i, d in enumerate(dfs):
        d = d.withColumn("src_ord", F.lit(i))
        out = d if out is None else out.unionByName(d)
    return out


def preview(df: DataFrame, order_col: str, n: int = 3) -> DataFrame:
    """K8: first n records."""
    return df.orderBy(order_col).limit(n)
