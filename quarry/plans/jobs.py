"""Composed jobs: T7 tokenize, M7 quality-classifier recipe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import patterns as pt
from quarry.functions import text as T
from quarry.operators import tokenizer as tok
from quarry.operators.classify import evaluate, predict_labels, quality_pipeline
from quarry.operators.sampling import balance_classes, fasttext_lines
from quarry.sources import sinks


def tokenize_job(spark: SparkSession, docs: DataFrame, out_dir: str, vocab_size: int = 10_000,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train (unless the tokenizer files exist: K6), save (K4), reload (S11),
    encode (T5) and write the token table (K5).  Returns the token table."""
    vocab_path, merges_path = f"{out_dir}/vocab", f"{out_dir}/merges"
    if not (sinks.finished(spark, vocab_path) and sinks.finished(spark, merges_path)):
        model = tok.train_bpe(tok.pretoken_counts(docs, text), vocab_size, pt.SPECIAL_TOKENS)
        sinks.save_model(spark, model, vocab_path, merges_path)
    model = tok.load_model(spark, vocab_path, merges_path, pt.SPECIAL_TOKENS)
    if not sinks.finished(spark, f"{out_dir}/tokens"):
        tokens = tok.encode(docs.select(key, text), model, key, text)
        sinks.write_tokens(tokens, f"{out_dir}/tokens", uint16=len(model.vocab) <= 65536)
    return spark.read.parquet(f"{out_dir}/tokens")


def quality_recipe(positives: DataFrame, negatives: DataFrame, key: str = "doc_id",
                   text: str = "text", min_words: int = 100):
    """M7: keep texts with > min_words words (S3), balance classes (A15),
    build labelled rows (M4), train (M5), evaluate on the training rows (A12).
    Returns (model, metrics DataFrame)."""
    def prep(df, label):
        d = df.select(key, text).filter(F.size(T.split_whitespace(text)) > min_words)
        return d.withColumn("quality", F.lit(label))
    both = prep(positives, 1).unionByName(prep(negatives, 0))
    bal = balance_classes(both, "quality", key)
    rows = fasttext_lines(bal.withColumn("label", F.when(F.col("quality") == 1, "high_quality")
                                         .otherwise("low_quality")), "label", text)
    lines = rows.select("label", F.expr("substring(line, instr(line, ' ') + 1)").alias("text"))
    model = quality_pipeline(text="text", label="label").fit(lines)
    metrics = evaluate(predict_labels(model, lines), "label")
    return model, metrics
