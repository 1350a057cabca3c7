"""P7-P10 PII masking as a DataFrame op (chained email -> phone -> IP)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import patterns as pt
from quarry.functions import text as T


def mask_pii(df: DataFrame, text_col: str = "text",
             email_pattern: str = pt.EMAIL_HEADS,
             phone_pattern: str = pt.PHONE_PATTERN,
             ip_pattern: str = pt.IP_PATTERN) -> DataFrame:
    """P10: each count is taken on the text masked by the previous step."""
    e = T.mask_email(text_col, email_pattern)
    out = df.withColumn("_e", e)
    p = T.mask_phone(F.col("_e.text"), phone_pattern)
    out = out.withColumn("_p", p)
    i = T.mask_ip(F.col("_p.text"), ip_pattern)
    out = out.withColumn("_i", i)
    return (out.withColumn("n_email", F.col("_e.n"))
               .withColumn("n_phone", F.col("_p.n"))
               .withColumn("n_ip", F.col("_i.n"))
               .withColumn(text_col, F.col("_i.text"))
               .drop("_e", "_p", "_i"))
