"""A training corpus from ``documents``: five stages, each written as Parquet and read again.

Toxic documents go, repeated lines go, near copies go, personal data is masked
and the rest is packed into windows.  ``n_chars`` follows the text wherever a
stage changes it.
"""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read_table, spread
from quarry.llm.line_dedup import dedup_lines
from quarry.llm.packing import pack_documents
from quarry.llm.pii import mask_pii
from quarry.llm.simhash import drop_near_copies
from quarry.llm.toxicity import drop_toxic
from quarry.session import checkpoint_dir


#: Documents that cross to a Python worker together: with texts of some KB each, a few MB a batch.
BATCH_ROWS = 2_500


def _in_small_batches(stage):
    """The stage, with Arrow batches of at most BATCH_ROWS rows (a session setting), so workers stay small."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)
    return run


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with only the earliest of equal and nearly equal lines."""
    return _counted(dedup_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 2 fingerprint bits (3-word shingles)."""
    return drop_near_copies(docs, shingle=3, max_bits=2)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return _counted(mask_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 2048 ids."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [(name, _in_small_batches(stage)) for name, stage in (
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_dedup", near_copies), ("pii", pii), ("packing", packing))]
#: Iterative fits and tokenization: not expressible in SQL, tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage's result lies in the shared checkpoint folder."""
    docs = spread(read_table(spark, sf_dir, "documents"))
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
