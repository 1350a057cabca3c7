"""Composed corpus-curation flows (DataFrame in, DataFrame out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import pii


def curation_summary(docs: DataFrame) -> DataFrame:
    """Flagship: F5 quality -> P10 masks -> drop exact copies -> per-language report.

    Exact copies are keyed by md5 of the masked text; the lowest ``doc_id``
    of each passing copy group is kept.  One scan and one regex pass feed a
    hash aggregation on (hash, lang) - partial aggregation folds a hot hash
    map-side, and every buffer is a fixed-width long (min / min_by), so no
    sort-based aggregation.  The copy group's winner is then picked by a
    window over the hash on that aggregate, whose groups hold at most one
    row per language, and a last aggregation reports per language.
    """
    d = docs.select("doc_id", "lang", "text", T.gopher_metrics("text").alias("_g"))
    d = d.select("doc_id", "lang", "text", "_g.n_words", "_g.passed")
    d = pii.mask_pii(d).withColumn("h", F.md5("text")).drop("text")
    pid = F.when(F.col("passed"), F.col("doc_id"))
    l1 = d.groupBy("h", "lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if("passed").alias("n_passed"),
        F.min(pid).alias("first_id"),
        *[F.min_by(F.col(c), pid).alias(c) for c in ("n_words", "n_email", "n_phone", "n_ip")])
    kept = F.col("first_id").isNotNull() & (F.col("first_id") == F.min("first_id").over(Window.partitionBy("h")))
    l2 = l1.withColumn("kept", kept)
    out = l2.groupBy("lang").agg(
        F.sum("n_docs").cast("bigint").alias("n_docs"),
        F.sum("n_passed").cast("bigint").alias("n_passed"),
        F.count_if("kept").cast("bigint").alias("n_kept"),
        *[F.coalesce(F.sum(F.when(F.col("kept"), F.col(c))), F.lit(0)).cast("bigint").alias(o)
          for c, o in (("n_words", "n_words_kept"), ("n_email", "n_email"),
                       ("n_phone", "n_phone"), ("n_ip", "n_ip"))])
    return out
