"""A13 cross-entropy / perplexity, A14 softmax, W5 top-p, W6 masks, W7 repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import _c


def masked_logits(logits, temperature: float = 1.0, banned: list[int] | None = None,
                  eos_id: int | None = None, step=None, min_new_tokens: int = 0) -> Column:
    """Divide by temperature, banned ids and an early EOS set to -1e9."""
    z = F.transform(_c(logits), lambda x: x.cast("double"))
    if temperature != 1.0:
        z = F.transform(z, lambda x: x / temperature)
    bad = list(banned or [])
    if bad or (eos_id is not None and step is not None):
        bset = F.array(*[F.lit(b) for b in bad]) if bad else F.array().cast("array<int>")
        early = (_c(step) < min_new_tokens) if step is not None else F.lit(False)
        z = F.transform(z, lambda x, i: F.when(
            F.array_contains(bset, i) | (early & (F.lit(eos_id if eos_id is not None else -1) == i)),
            F.lit(-1e9)).otherwise(x))
    return z


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def log_sum_exp(z: Column) -> Column:
    return _bind(F.array_max(z), lambda m: m + F.log(F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x - m))))


def cross_entropy(logits, target) -> Column:
    """A13 per row: -(z_y - max - ln sum exp(z - max))."""
    z = F.transform(_c(logits), lambda x: x.cast("double"))
    return log_sum_exp(z) - F.element_at(z, _c(target) + 1)


def softmax(logits) -> Column:
    """A14 max-shifted softmax of an array."""
    z = F.transform(_c(logits), lambda x: x.cast("double"))
    return _bind(z, lambda v: _bind(F.array_max(v), lambda m: _bind(
        F.aggregate(v, F.lit(0.0), lambda a, x: a + F.exp(x - m)),
        lambda s: F.transform(v, lambda x: F.exp(x - m) / s))))


def nucleus(rows: DataFrame, probs: str, top_p: float, keys: list[str]) -> DataFrame:
    """The entries that nucleus selection keeps, one row each: keys, rank (from 1), i, p, share.

    Sorted by falling probability, ties by index; kept while cumsum - p <=
    top_p; ``share`` is p renormalised over the kept entries.  Prefix sums are
    windows over the exploded entries of a row (at most the vocabulary), linear
    in its width.
    """
    entries = rows.select(*keys, F.posexplode(probs).alias("i", "p"))
    order = Window.partitionBy(*keys).orderBy(F.desc("p"), "i")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = (entries.withColumns({"rank": F.row_number().over(order), "upto": F.sum("p").over(upto)})
                   .filter(F.col("upto") - F.col("p") <= top_p).drop("upto"))
    return kept.withColumn("share", F.col("p") / F.sum("p").over(Window.partitionBy(*keys)))


def _first_triple_end(s: Column, n: int) -> Column:
    """Smallest end e such that the three n-grams ending at e are equal.

    a[i] = (s[i] == s[i+n]); three equal n-grams end at e exactly when a holds
    on the 2n positions e-3n+1 .. e-n.  One left fold tracks the current run
    of a (O(len) per n instead of comparing slices at every end).
    """
    acc0 = F.struct(F.lit(0).alias("run"), F.lit(None).cast("int").alias("end"))

    def step(acc, i):
        same = F.coalesce(F.element_at(s, i) == F.element_at(s, i + n), F.lit(False))
        run = F.when(same, acc["run"] + 1).otherwise(F.lit(0))
        end = F.coalesce(acc["end"], F.when(run >= 2 * n, i + n))
        return F.struct(run.alias("run"), end.alias("end"))

    idx = F.sequence(F.lit(1), F.greatest(F.size(s) - n, F.lit(1)))
    out = F.aggregate(idx, acc0, step)["end"]
    return F.when(F.size(s) >= 3 * n, out)


def repeat_cut(seq, ns=(3, 4, 5, 6, 7, 8)) -> Column:
    """W7 on a token/word array column: the smallest end e (1-based) where
    the last three n-grams are equal (smallest n on ties), as
    struct(end, n, keep) with ``keep`` = e - 2n tokens left after cutting the
    repeated tail; null when no triple repeat occurs.  ``seq`` should be a
    column reference (it is read inside the fold)."""
    s = _c(seq)
    cands = [F.when(_first_triple_end(s, n).isNotNull(),
                    F.struct(_first_triple_end(s, n).alias("end"), F.lit(n).alias("n")))
             for n in ns]
    best = F.array_min(F.filter(F.array(*cands), lambda x: x.isNotNull()))
    return F.when(best.isNotNull(), F.struct(best["end"].alias("end"), best["n"].alias("n"),
                                             (best["end"] - 2 * best["n"]).alias("keep")))
