"""E3 Wikipedia article extraction: F3 -> P4 -> P5 -> F4 -> F2 -> K1 row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import patterns as pt
from quarry.functions import text as T


def process_articles(articles: DataFrame, min_length: int = pt.ARTICLE_MIN_LENGTH,
                     use_article_filter: bool = True, legacy_concat: bool = True,
                     title: str = "title", text: str = "text") -> DataFrame:
    """Adds ``cleaned``, ``status`` (namespace / too_short / filtered / kept)
    and ``out`` (title + cleaned + sentinel line, the K1 record; N10 legacy
    concatenation has no separator between title and body)."""
    t = F.coalesce(F.col(title), F.lit(""))
    body = F.coalesce(F.col(text), F.lit(""))
    df = articles.withColumn("_ns", T.is_namespace_title(t))
    # Cheapest predicate first: namespace pages never reach the regex chain.
    cleaned = F.when(~F.col("_ns"), T.clean_article(T.clean_wikitext(body)))
    df = df.withColumn("cleaned", cleaned)
    status = (F.when(F.col("_ns"), "namespace")
               .when(~T.min_length("cleaned", min_length), "too_short"))
    if use_article_filter:
        status = status.when(~T.filter_article("cleaned"), "filtered")
    df = df.withColumn("status", status.otherwise("kept"))
    sep = F.lit("") if legacy_concat else F.lit("\n")
    out = F.when(F.col("status") == "kept",
                 F.concat(t, sep, F.col("cleaned"), F.lit("\n" + pt.ENDOFTEXT + "\n")))
    return df.withColumn("out", out).drop("_ns")


def extraction_counters(processed: DataFrame) -> DataFrame:
    """Processed (every page), kept, skipped (namespace pages are not skipped)."""
    return processed.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_processed"),
        F.count_if(F.col("status") == "kept").cast("bigint").alias("n_kept"),
        F.count_if(F.col("status").isin("too_short", "filtered")).cast("bigint").alias("n_skipped"))
