"""M5 text classifier of low rank: hashed words and word bigrams, an embedding
table, the mean embedding of a text, a softmax layer.

With X the (text x bucket) matrix of mean bucket counts, E the embedding table
and W the softmax layer, a text's logits are its row of X (E W).  Both gradients
follow from one matrix of a row per bucket and a column per label,
G = X^T (P - Y): dE = G W^T and dW = E^T G.  So a training round sends E W to
the tasks, sums G by bucket as a Spark aggregation and takes the step on the
driver; what travels is buckets x labels numbers, however many texts there are
and whatever the embedding's width.  The rounds read the texts as blocks of
bucket numbers (``packed``), written once.

Bounds: ``buckets`` x ``dim`` numbers on the driver, ``buckets`` x labels in a
task, at most ``MOST_CELLS`` of the latter (checked).

Cases: rows without a label are not trained on; null and empty texts hold no
features, so they get the first label (in sorted order) at equal shares; equal
shares go to the first label; repeated rows count as often as they occur; one
label alone has share 1; an empty training table is an error, an empty table
to predict gives no rows; other columns are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.session import reliable_checkpoint

MOST_CELLS = 1 << 24
#: Features whose numbers a task lays out at a time (whole texts).
BLOCK = 1 << 18


@dataclass
class LowRankModel:
    """Labels in sorted order, embedding table, softmax layer, mean loss of each round."""

    labels: list
    embedding: np.ndarray
    layer: np.ndarray
    losses: list

    @property
    def table(self) -> np.ndarray:
        """What a bucket adds to each label's logit."""
        return self.embedding.astype(np.float64) @ self.layer


def feature_buckets(text: str | Column, buckets: int) -> Column:
    """Buckets of a text's words and word bigrams, one for each occurrence."""
    def both(words: Column) -> Column:
        pairs = F.greatest(F.size(words) - 1, F.lit(0))
        one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
        two = F.zip_with(F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs),
                         lambda a, b: F.pmod(F.xxhash64(F.lit(2), a, b), F.lit(buckets)).cast("int"))
        return F.concat(one, two)

    split_once = F.transform(F.array(T.split_whitespace(text)), both)  # the bound words are read six times
    return F.coalesce(split_once[0], F.array().cast("array<int>"))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all rows end to end, and each row's number of them."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _blocks(flat: np.ndarray, size: np.ndarray):
    """(rows, features) slices of whole rows with about ``BLOCK`` features each."""
    ends = np.cumsum(size, dtype=np.int64)
    firsts = np.flatnonzero(np.diff((ends - size) // BLOCK, prepend=-1)) if len(size) else []
    for a, b in zip(firsts, [*firsts[1:], len(size)], strict=True):
        yield slice(a, b), slice(ends[a] - size[a], ends[b - 1])


def _shares(columns: np.ndarray, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Softmax shares of each row, given a row of ``columns`` a label; equal shares without features."""
    logits = np.zeros((len(size), len(columns)))
    some = np.flatnonzero(size)
    if len(some):
        starts = (np.cumsum(size, dtype=np.int64) - size)[some]
        for k, column in enumerate(columns):
            logits[some, k] = np.add.reduceat(column[flat], starts) / size[some]
    p = np.exp(logits - logits.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def packed(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows (y, x) as blocks (y, size, x) of numbers in bytes: labels, numbers of features, buckets end to end.

    A training round then reads a few large values, two bytes a feature for
    up to 65,536 buckets, instead of an array a text.  Blocks are dealt evenly
    over the task slots, since each task sends a row per bucket.
    """
    kind = "<u2" if buckets <= 1 << 16 else "<i4"

    def run(batches):
        for batch in batches:
            flat, size = _flat(batch.column("x"))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for r, f in _blocks(flat, size):
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (
                    y[r].astype("<i4"), size[r].astype("<i4"), flat[f].astype(kind))], ["y", "size", "x"])

    return rows.mapInArrow(run, "y binary, size binary, x binary").repartition(rows.sparkSession.sparkContext.defaultParallelism)


def gradient_sums(rows: DataFrame, table: np.ndarray) -> tuple[np.ndarray, float]:
    """(X^T (P - Y), summed loss) over rows (y, x) or their blocks: partial sums in the tasks, added up by bucket."""
    buckets, n_labels = table.shape
    blocks = rows if "size" in rows.columns else packed(rows, buckets)
    kind = "<u2" if buckets <= 1 << 16 else "<i4"
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))
    names = [f"g{k}" for k in range(n_labels)]

    def run(batches):
        sums, loss = np.zeros((n_labels, buckets)), 0.0
        for batch in batches:
            for y, size, flat in zip(*(batch.column(c) for c in ("y", "size", "x")), strict=True):
                y, size = (np.frombuffer(v.as_buffer(), "<i4") for v in (y, size))
                flat = np.frombuffer(flat.as_buffer(), kind).astype(np.intp)
                p = _shares(shared.value, flat, size)
                loss -= float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum())
                p[np.arange(len(y)), y] -= 1
                p /= np.maximum(size, 1)[:, None]
                for k in range(n_labels - 1):
                    sums[k] += np.bincount(flat, weights=np.repeat(p[:, k], size), minlength=buckets)
        sums[-1] = -sums[:-1].sum(0)  # a row of P - Y adds up to 0
        at = np.flatnonzero(sums.any(0))
        grown = np.vstack([sums.T[at], [[loss] + [0.0] * (n_labels - 1)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), *[pa.array(grown[:, k]) for k in range(n_labels)]], ["b", *names])

    parts = blocks.mapInArrow(run, "b int, " + ", ".join(f"{c} double" for c in names))
    got = parts.groupBy("b").agg(*[F.sum(c).alias(c) for c in names]).toPandas()
    shared.destroy()
    out, b, g = np.zeros((buckets, n_labels)), got["b"].to_numpy(), got[names].to_numpy()
    out[b[b >= 0]] = g[b >= 0]
    return out, float(g[b < 0, 0].sum())


def _step(value: np.ndarray, grad: np.ndarray, state: list, turn: int, rate: float) -> None:
    """One step with momentum in place, scaled by the gradient's largest number.

    One scale for the whole matrix: a scale for each number (as Adam has) would
    move the buckets of rare words as far as those of frequent ones.
    """
    state[0] = 0.9 * state[0] + 0.1 * grad
    state[1] = 0.99 * state[1] + 0.01 * float(np.abs(grad).max()) ** 2
    value -= rate * (state[0] / (1 - 0.9 ** turn)) / (np.sqrt(state[1] / (1 - 0.99 ** turn)) + 1e-12)


def train(df: DataFrame, label: str = "label", text: str = "text", dim: int = 100, buckets: int = 1 << 16,
          rounds: int = 40, rate: float = 0.3, least_gain: float = 1e-3, least_loss: float = 3e-3, seed: int = 7) -> LowRankModel:
    """Fits the classifier to (label, text) rows by whole-table gradients.

    Stops after ``rounds``, at a mean loss below ``least_loss``, or when five
    rounds together lower the loss by a share of less than ``least_gain``.
    """
    known = df.filter(F.col(label).isNotNull())
    most = MOST_CELLS // buckets
    labels = sorted(r[0] for r in known.select(label).distinct().limit(most + 1).collect())
    if not labels or len(labels) > most:
        raise ValueError(f"need 1 to {most} labels for {buckets} buckets")
    code = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label)) - 1
    rows = reliable_checkpoint(packed(known.select(code.cast("int").alias("y"), feature_buckets(text, buckets).alias("x")), buckets))
    n = rows.agg(F.sum(F.octet_length("y") / 4)).first()[0]
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer = rng.uniform(-1, 1, (dim, len(labels))) / np.sqrt(dim)
    model, states = LowRankModel(labels, embedding, layer, []), ([np.float32(0), 0.0], [0.0, 0.0])
    for turn in range(1, rounds + 1):
        sums, loss = gradient_sums(rows, model.table)
        model.losses.append(loss / n)
        if model.losses[-1] < least_loss or turn > 5 and model.losses[-6] - model.losses[-1] < least_gain * model.losses[-6]:
            break
        to_layer = embedding.astype(np.float64).T @ sums / n
        to_embedding = (sums / n @ layer.T).astype(np.float32)
        _step(embedding, to_embedding, states[0], turn, rate)
        _step(layer, to_layer, states[1], turn, rate)
    return model


def predict(df: DataFrame, model: LowRankModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pred, score) of every row: the label of the largest share, and that share."""
    table = model.table
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(table.T))

    def run(batches):
        for batch in batches:
            flat, size = _flat(batch.column("x"))
            p = np.vstack([np.zeros((0, len(shared.value))), *[_shares(shared.value, flat[f], size[r]) for r, f in _blocks(flat, size)]])
            best = p.argmax(1)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(best, pa.int32()), pa.array(p[np.arange(len(p)), best])], ["k", "y", "score"])

    kind = df.schema[key].dataType.simpleString()
    found = df.select(F.col(key).alias("k"), feature_buckets(text, len(table)).alias("x")).mapInArrow(run, f"k {kind}, y int, score double")
    name = F.element_at(F.array(*[F.lit(x) for x in model.labels]), F.col("y") + 1)
    return found.select(F.col("k").alias(key), name.alias("pred"), "score")
