"""W2-W4 token-stream positions, training windows and rank shards, O7 mixing.

The token stream is the concatenation of documents in ``doc_id`` order.
Positions come from a two-level prefix sum (never an unpartitioned window):
range-partition the per-document counts, total each partition (one row each),
then add the partition's base to a running sum inside the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import reliable_checkpoint


def doc_offsets(tokens: DataFrame, key: str = "doc_id", ids: str = "ids",
                partitions: int | None = None) -> DataFrame:
    """(key, n, offset) with offset = tokens of all documents before it."""
    spark = tokens.sparkSession
    p = partitions or max(1, spark.sparkContext.defaultParallelism)
    counts = tokens.select(F.col(key).alias("k"), F.size(ids).cast("bigint").alias("n"))
    # Range bounds come from a sample: materialise once so both passes agree.
    ranged = reliable_checkpoint(
        counts.repartitionByRange(p, "k").sortWithinPartitions("k")
              .withColumn("pid", F.spark_partition_id()))
    # one row per range partition; the running total over them is small by construction
    totals = ranged.groupBy("pid").agg(F.sum("n").alias("t"))
    base = totals.select("pid", (F.sum("t").over(Window.orderBy("pid")) - F.col("t")).alias("base"))
    inside = Window.partitionBy("pid").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(base), "pid")
    return out.select(F.col("k").alias(key), "n", (F.col("base") + F.col("upto") - F.col("n")).alias("offset"))


def flat_tokens(tokens: DataFrame, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(pos, id) for the whole stream (K5/S12 flat view of the token table)."""
    off = doc_offsets(tokens, key, ids)
    t = tokens.select(key, ids).join(off, key)
    return (t.select(F.posexplode(ids).alias("i", "id"), "offset")
             .select((F.col("offset") + F.col("i")).alias("pos"), "id"))


def pack_windows(flat: DataFrame, seq_len: int, n_total: int) -> DataFrame:
    """W2 with stride ``seq_len``: window w has x = [wL, wL+L), y = [wL+1, wL+L].

    Every token goes to its own window and, when it starts a block, also to
    the previous window's last target: groups are bounded by L+1 rows.
    """
    n_windows = max(0, (n_total - 1) // seq_len)
    L = seq_len
    w_own = F.floor(F.col("pos") / L)
    tagged = flat.select("pos", "id", F.explode(F.when(
        (F.col("pos") % L == 0) & (F.col("pos") > 0), F.array(w_own, w_own - 1)
    ).otherwise(F.array(w_own))).alias("w"))
    tagged = tagged.filter(F.col("w") < n_windows)
    g = tagged.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("s"))
    ids = F.transform("s", lambda x: x["id"])
    return g.select(F.col("w").cast("bigint").alias("window_id"),
                    (F.col("w") * L).cast("bigint").alias("start"),
                    F.slice(ids, 1, L).alias("x"), F.slice(ids, 2, L).alias("y"))


def doc_windows(tokens: DataFrame, seq_len: int, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """W2 with stride ``seq_len`` straight from per-document arrays.

    Each document emits one slice per window it overlaps (about n/L + 1 rows
    instead of n token rows); a window then concatenates at most a few slices
    in stream order.  Same output as :func:`pack_windows`.
    """
    L = seq_len
    off = doc_offsets(tokens, key, ids)
    t = tokens.select(key, ids).join(off, key).filter(F.col("n") > 0)
    n_total = off.agg(F.sum("n")).first()[0] or 0
    n_windows = max(0, (n_total - 1) // L)
    o, n = F.col("offset"), F.col("n")
    first_w = F.floor(o / L) - F.when((o % L == 0) & (o > 0), 1).otherwise(0)
    last_w = F.least(F.floor((o + n - 1) / L), F.lit(n_windows - 1))
    t = t.filter(first_w <= last_w).select(ids, "offset", "n", F.explode(F.sequence(first_w, last_w)).alias("w"))
    lo = F.greatest(F.col("w") * L, o)
    hi = F.least(F.col("w") * L + L, o + n - 1)
    part = F.slice(ids, (lo - o + 1).cast("int"), (hi - lo + 1).cast("int"))
    g = (t.select("w", F.struct("offset", part.alias("p")).alias("s"))
          .groupBy("w").agg(F.array_sort(F.collect_list("s")).alias("s")))
    flat = F.flatten(F.transform("s", lambda x: x["p"]))
    return g.select(F.col("w").cast("bigint").alias("window_id"), (F.col("w") * L).cast("bigint").alias("start"),
                    F.slice(flat, 1, L).alias("x"), F.slice(flat, 2, L).alias("y"))


def md5_uniform(seed, k) -> "F.Column":
    """Deterministic 60-bit non-negative integer from md5(seed:k) (SQL-checkable)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def random_windows(flat: DataFrame, n_total: int, batch_size: int, seq_len: int,
                   seed: int = 0) -> DataFrame:
    """W2 ``get_batch``: starts uniform in [0, n - L), x = [s, s+L), y = [s+1, s+L].

    Starts are md5-derived so the draw is reproducible.  The start table has
    ``batch_size`` rows (a bounded parameter) and is broadcast; each window
    touches at most two blocks of the block-keyed token table.
    """
    if n_total - seq_len <= 0:
        raise ValueError("token stream shorter than a window")
    spark = flat.sparkSession
    L = seq_len
    starts = spark.range(batch_size).select(
        F.col("id").alias("k"), F.pmod(md5_uniform(seed, F.col("id")), F.lit(n_total - L)).alias("start"))
    wants = starts.select("k", "start", F.explode(F.array_distinct(F.array(
        F.floor(F.col("start") / L), F.floor((F.col("start") + L) / L)))).alias("blk"))
    blocks = flat.withColumn("blk", F.floor(F.col("pos") / L))
    j = blocks.join(F.broadcast(wants), "blk").filter(
        (F.col("pos") >= F.col("start")) & (F.col("pos") <= F.col("start") + L))
    g = j.groupBy("k", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("s"))
    ids = F.transform("s", lambda x: x["id"])
    return g.select("k", "start", F.slice(ids, 1, L).alias("x"), F.slice(ids, 2, L).alias("y"))


def windows_at(tokens: DataFrame, offsets: DataFrame, starts: DataFrame, seq_len: int,
               key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The windows that begin at ``start`` in the stream: all columns of ``starts``, x = [s, s+L), y = [s+1, s+L].

    Per-document arrays, no per-token rows: each document emits one row per
    block of ``seq_len`` positions it covers; the start list (a bounded
    parameter of the caller, broadcast) picks the blocks it needs, and each
    window concatenates its slices in stream order.  ``offsets`` is
    :func:`doc_offsets` of the tokens.
    """
    L = seq_len
    names = starts.columns
    wants = starts.select("*", F.explode(F.array_distinct(F.array(
        F.floor(F.col("start") / L), F.floor((F.col("start") + L) / L)))).alias("blk"))
    t = tokens.select(key, ids).join(offsets, key).filter(F.col("n") > 0)
    o, n = F.col("offset"), F.col("n")
    t = t.select(ids, "offset", "n", F.explode(F.sequence(F.floor(o / L), F.floor((o + n - 1) / L))).alias("blk"))
    j = t.join(F.broadcast(wants), "blk")
    lo = F.greatest(F.col("start"), o, F.col("blk") * L)
    hi = F.least(F.col("start") + L, o + n - 1, F.col("blk") * L + L - 1)
    j = j.filter(lo <= hi).select(*names, F.struct(lo.alias("lo"), F.slice(
        ids, (lo - o + 1).cast("int"), (hi - lo + 1).cast("int")).alias("p")).alias("s"))
    g = j.groupBy(*names).agg(F.array_sort(F.collect_list("s")).alias("s"))
    flat = F.flatten(F.transform("s", lambda x: x["p"]))
    return g.select(*names, F.slice(flat, 1, L).alias("x"), F.slice(flat, 2, L).alias("y"))


def doc_random_windows(tokens: DataFrame, batch_size: int, seq_len: int, seed: int = 0,
                       key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """W2 ``get_batch`` from per-document arrays.  Same output as :func:`random_windows`."""
    off = doc_offsets(tokens, key, ids)
    n_total = off.agg(F.sum("n")).first()[0] or 0
    if n_total - seq_len <= 0:
        raise ValueError("token stream shorter than a window")
    starts = tokens.sparkSession.range(batch_size).select(
        F.col("id").alias("k"), F.pmod(md5_uniform(seed, F.col("id")), F.lit(n_total - seq_len)).alias("start"))
    return windows_at(tokens, off, starts, seq_len, key, ids)


def rank_batches(tokens: DataFrame, world_size: int, batch_size: int, seq_len: int, seed: int = 42, epoch: int = 0,
                 key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """W3 every rank's batch of an epoch: rank, k, start, x, y.

    Rank r owns the positions from r * floor(n / W) on, the last rank the
    remainder too; its starts are drawn from its own shard under the seed
    ``seed + r + 1000 * epoch``.  A shard without room for a window is an error.
    The start list has ``world_size * batch_size`` rows.
    """
    off = doc_offsets(tokens, key, ids)
    n_total = off.agg(F.sum("n")).first()[0] or 0
    per = n_total // world_size
    if per - seq_len <= 0:
        raise ValueError("data shard too small for the sequence length")
    last = n_total - per * (world_size - 1)
    slots = tokens.sparkSession.range(world_size * batch_size).select(
        F.floor(F.col("id") / batch_size).cast("int").alias("rank"), (F.col("id") % batch_size).alias("k"))
    room = F.when(F.col("rank") == world_size - 1, F.lit(last)).otherwise(F.lit(per)) - seq_len
    draw = md5_uniform("", F.concat((F.col("rank") + seed + 1000 * epoch).cast("string"), F.lit(":"), F.col("k").cast("string")))
    starts = slots.withColumn("start", F.col("rank").cast("bigint") * per + F.pmod(draw, room))
    return windows_at(tokens, off, starts, seq_len, key, ids)


def shard_summary(tokens: DataFrame, world_size: int, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """W3 per rank: token count and first/last stream position, from
    per-document spans (a document crosses at most a few shard bounds)."""
    off = doc_offsets(tokens, key, ids).filter(F.col("n") > 0)
    n_total = off.agg(F.sum("n")).first()[0] or 0
    per = n_total // world_size
    if per <= 0:
        raise ValueError("token stream shorter than the number of ranks")
    o, n = F.col("offset"), F.col("n")
    W = world_size
    r0 = F.least(F.floor(o / per), F.lit(W - 1))
    r1 = F.least(F.floor((o + n - 1) / per), F.lit(W - 1))
    t = off.select("offset", "n", F.explode(F.sequence(r0, r1)).alias("rank"))
    r = F.col("rank")
    lo = F.greatest(o, r * per)
    hi = F.least(o + n - 1, F.when(r == W - 1, F.lit(n_total - 1)).otherwise(r * per + per - 1))
    return (t.select(r.cast("int").alias("rank"), lo.alias("lo"), hi.alias("hi"))
             .groupBy("rank").agg(F.sum(F.col("hi") - F.col("lo") + 1).cast("bigint").alias("n_tokens"),
                                  F.min("lo").cast("bigint").alias("first_pos"),
                                  F.max("hi").cast("bigint").alias("last_pos")))


def rank_shards(flat: DataFrame, n_total: int, world_size: int) -> DataFrame:
    """Shard r = [r*floor(n/W), ...), the last shard takes the remainder."""
    per = n_total // world_size
    if per <= 0:
        raise ValueError("token stream shorter than the number of ranks")
    return flat.withColumn("rank", F.least(F.floor(F.col("pos") / per), F.lit(world_size - 1)).cast("int"))


def mix_slots(n_slots: int, weights: list[float] | None, n_datasets: int, seed: int = 0,
              spark=None) -> DataFrame:
    """O7 dataset choice per micro-batch slot from normalised weights.

    Bad weights (wrong length, non-numeric, non-positive sum) fall back to
    uniform, as the reference does.  The slot table is generated by Spark.
    """
    try:
        w = [float(x) for x in weights] if weights is not None else None
        assert w is not None and len(w) == n_datasets and sum(w) > 0
    except Exception:
        w = [1.0] * n_datasets
    total = sum(w)
    cum, acc = [], 0.0
    for x in w[:-1]:
        acc += x / total
        cum.append(acc)
    u = (md5_uniform(seed, F.col("id")) % F.lit(1 << 30)) / float(1 << 30)
    choice = F.lit(n_datasets - 1)
    for i in reversed(range(len(cum))):
        choice = F.when(u < cum[i], F.lit(i)).otherwise(choice)
    return spark.range(n_slots).select(F.col("id").alias("slot"), choice.alias("dataset"))
