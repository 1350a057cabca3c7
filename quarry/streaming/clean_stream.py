"""Structured Streaming form of the stateless operators.

All of the text projections and filters are per-row, so they run unchanged
on ``readStream``.  Corpus-wide operators (exact line dedup retracts earlier
lines; MinHash needs all documents) stay batch jobs.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.plan import materialized
from quarry.operators import pii


def clean_documents(stream: DataFrame, text: str = "text") -> DataFrame:
    """Quality metrics + filter, then PII masking, on a stream of documents."""
    g = T.gopher_metrics(text)
    s = materialized(stream.withColumn("_g", g))
    s = s.filter(F.col("_g.passed")).withColumn("n_words", F.col("_g.n_words")).drop("_g")
    return pii.mask_pii(s, text)


def start_clean_stream(spark: SparkSession, src: str, out: str, schema,
                       checkpoint: str | None = None, once: bool = True):
    """Read parquet files arriving in ``src``; write cleaned rows to ``out``.

    The checkpoint lies beside ``out`` unless given: a fixed place, so that a
    restarted stream goes on where it stopped."""
    ckpt = checkpoint or f"{out.rstrip('/')}_checkpoint"
    stream = spark.readStream.schema(schema).parquet(src)
    q = (clean_documents(stream).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ckpt))
    q = q.trigger(availableNow=True) if once else q.trigger(processingTime="30 seconds")
    return q.start()
