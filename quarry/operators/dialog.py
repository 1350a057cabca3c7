"""P18 dialog formatting and W8 turn parity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import patterns as pt
from quarry.functions.text import _c, py_strip


def format_utterances(utts: Column) -> Column:
    """P18 on an array of utterances: trim, drop empty, need >= 2,
    alternate user/assistant by index after dropping, end with the sentinel."""
    kept = F.filter(F.transform(utts, lambda u: py_strip(u)), lambda u: F.length(u) > 0)
    body = F.array_join(F.transform(kept, lambda u, i: F.concat(
        F.when(i % 2 == 0, F.lit(pt.USER_TAG + "\n")).otherwise(F.lit(pt.ASSISTANT_TAG + "\n")),
        u, F.lit("\n"))), "")
    return F.when(F.size(kept) >= 2, F.concat(body, F.lit(pt.ENDOFTEXT + "\n")))


def dialog_from_line(line) -> Column:
    """P18 for one DailyDialog line: utterances joined by ``__eou__``."""
    return format_utterances(F.split(_c(line), "__eou__", -1))


def format_conversations(conv: DataFrame, key: str = "conv_id") -> DataFrame:
    """P18 on the conversations table: system turns dropped first.

    One group per conversation (bounded by its number of turns).
    """
    turns = conv.filter(F.col("role") != "system")
    g = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return (g.select(key, format_utterances(F.transform("t", lambda x: x["text"])).alias("text"))
             .filter(F.col("text").isNotNull()))


def turn_roles(conv: DataFrame, key: str = "conv_id") -> DataFrame:
    """Expected role from parity among non-system turns vs the stored role."""
    w = Window.partitionBy(key).orderBy("turn")
    t = conv.filter(F.col("role") != "system").withColumn("idx", F.row_number().over(w) - 1)
    t = t.withColumn("expected", F.when(F.col("idx") % 2 == 0, "user").otherwise("assistant"))
    return t.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("n_turns"),
                              F.count_if(F.col("expected") != F.col("role")).cast("bigint").alias("n_mismatch"))


def dialog_split_counts(lines: DataFrame, split: str = "split", line: str = "line") -> DataFrame:
    """A10: formatted dialogs per split (lines with fewer than two utterances drop)."""
    f = lines.select(split, dialog_from_line(F.col(line)).alias("text")).filter(F.col("text").isNotNull())
    return f.groupBy(split).agg(F.count(F.lit(1)).cast("bigint").alias("n_dialogs"))
