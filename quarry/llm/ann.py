"""Nearest neighbours by collision counting over query-centred windows.

Every vector is projected on ``projections`` lines of random orthonormal
frames; per piece of vectors each line is a sorted array.  A query opens a
window around its own projection on every line, as wide as its radius asks, and
a vector found in the windows of at least ``threshold`` of the lines is verified
with its exact distance.  The threshold is one that all but ``miss`` of the
vectors at the radius itself reach, and nearer ones more surely; counts over
whole frames vary less than those over as many independent lines.

A radius comes from the table: a query first meets a part of it (a sixteenth,
2,048 vectors at least), where it widens all windows by a constant factor
(virtual rehashing) until enough vectors collide; the distance of the k-th best
is an upper bound of that in the whole table, with which it meets the other
rows, and which shrinks as nearer ones are found.  So the vectors verified
follow the radius, not the number of blocks.

Collisions are counted for 64 vectors at a time: a line keeps the rows before
each of ``steps`` places as a bit string, a window is the difference of two of
them (rounded outwards), and the strings of all lines are added bit by bit.

Blocks of queries meet blocks of vectors, so memory is bounded by two blocks
whatever the table's size, and the best of all blocks are ranked per query.
Every query still counts over all rows, so queries that are a share of the table
take time with its square, at a small cost a pair.

Equal vectors are one entry that carries its k+1 smallest ids, which is all a
top-k with ties to the smaller id can use; so a vector shared by a third of the
rows costs one entry.

Cases: vectors that are null, empty, zero or hold null or non-finite components
take no part; vectors are compared with those of equal length only; repeated
rows count once; fewer than k candidates give them all; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import blocks_for, settled
from quarry.llm.vectors import classes, matrix, usable

SEED = 20240
PIECE, CHUNK = 8192, 64  # vectors of one index, queries counted at once: their bit strings stay in the processor's cache


def frames(dim: int, projections: int) -> np.ndarray:
    """That many unit vectors as columns, each ``dim`` of them orthogonal to one another."""
    rng = np.random.default_rng(SEED + dim)
    widths = [min(dim, projections - at) for at in range(0, projections, dim)]
    return np.hstack([np.linalg.qr(rng.standard_normal((dim, w)))[0] for w in widths])


def threshold(lines: np.ndarray, half: float, miss: float, draws: int = 4096) -> int:
    """Collisions that all but ``miss`` of the vectors at distance 1 reach with windows of that half width."""
    u = np.random.default_rng(SEED).standard_normal((draws, len(lines)))
    u /= np.sqrt((u ** 2).sum(1, keepdims=True))
    return max(1, int(np.quantile((np.abs(u @ lines) <= half).sum(1), miss)))


def added(strings) -> list[np.ndarray]:
    """Sums of bit strings place by place, as strings of binary digits, the lowest first."""
    digits: list[list[np.ndarray]] = [[]]
    for string in strings:
        digits[0].append(string)
        at = 0
        while len(digits[at]) == 3:
            a, b, c = digits[at]
            one = a ^ b
            digits[at] = [one ^ c]
            if at + 1 == len(digits):
                digits.append([])
            digits[at + 1].append((a & b) | (one & c))
            at += 1
    out, carry = [], []
    for digit in digits:
        total, up = None, []
        for s in digit + carry:
            total, up = (s, up) if total is None else (total ^ s, [*up, total & s])
        out.append(total)
        carry = [np.bitwise_or.reduce(up)] if up else []
    return out + carry


def distances(x: np.ndarray, r: np.ndarray, queries: np.ndarray, q: np.ndarray, batch: int = 1024) -> np.ndarray:
    """Distance of row r of x to row q of the queries, pair by pair."""
    d = np.empty(len(q))
    for at in range(0, len(q), batch):
        apart = x[r[at:at + batch]]
        apart -= queries[q[at:at + batch]]
        apart *= apart
        d[at:at + batch] = apart.sum(1)
    return np.sqrt(d)


class SortedLines:
    """One piece's projections, each a sorted array with the rows before its steps as bits."""

    def __init__(self, x: np.ndarray, lines: np.ndarray, least: int, half: float, steps: int = 64):
        n = len(x)
        self.x, self.lines, self.least, self.half = x, lines, least, half
        p = (x @ lines).T
        order = np.argsort(p, axis=1, kind="stable")
        values = np.take_along_axis(p, order, 1)
        steps = np.unique(np.arange(steps + 1) * n // steps)
        self.bits = np.zeros((len(p), len(steps), -(-n // 64)), np.uint64)
        place = np.empty(n, np.int32)
        for j, by in enumerate(order):
            place[by] = np.arange(n, dtype=np.int32)
            packed = np.packbits(place < steps[:, None], axis=1, bitorder="little")
            self.bits[j].view(np.uint8)[:, :packed.shape[1]] = packed
        self.before, self.after = values[:, steps[1:] - 1], values[:, steps[:-1]]  # last value before a step, first one after it
        self.ends, self.spread = values[:, [0, -1]], values.std()

    def _windows(self, at: np.ndarray, reach: np.ndarray):
        """Per line the bit strings of the rows in every query's window."""
        low, high = at - reach, at + reach
        low[np.isnan(low)], high[np.isnan(high)] = -np.inf, np.inf
        rows, other = np.empty((2, len(reach), self.bits.shape[2]), np.uint64)
        for j, bits in enumerate(self.bits):
            np.take(bits, np.searchsorted(self.after[j], high[j], "right"), axis=0, out=rows, mode="clip")
            np.take(bits, np.searchsorted(self.before[j], low[j], "left"), axis=0, out=other, mode="clip")
            yield rows ^ other

    def search(self, queries: np.ndarray, radius: np.ndarray):
        """(query, row) pairs whose collisions reach the threshold in the windows of each query's radius."""
        rounding = 1e-12 * (np.sqrt((queries ** 2).sum(1)) + radius)
        digits = added(self._windows((queries @ self.lines).T, radius * self.half + rounding))
        rest = 2 ** len(digits) - self.least
        hit = np.zeros_like(digits[0])
        for i, digit in enumerate(digits):  # the carry of count + rest says whether the count reaches the threshold
            hit = (hit | digit) if rest >> i & 1 else (hit & digit)
        rows = np.unpackbits(hit.view(np.uint8), axis=1, count=len(self.x), bitorder="little")
        return np.divmod(np.flatnonzero(rows), len(self.x))

    def widened(self, queries: np.ndarray, enough: int, growth: float = 1.3, first: float = 0.35) -> np.ndarray:
        """Radius of every query at which ``enough`` rows collide, or infinity where its windows hold everything."""
        radius = np.full(len(queries), np.inf)
        if len(self.x) < enough:
            return radius
        at = (queries @ self.lines).T
        reach = np.maximum(np.abs(at - self.ends[:, :1]), np.abs(at - self.ends[:, 1:])).max(0)
        live, wide = np.arange(len(queries)), first * (self.spread or 1.0) / self.half
        while len(live := live[wide * self.half < reach[live]]):
            hits = np.bincount(self.search(queries[live], np.full(len(live), wide))[0], minlength=len(live))
            radius[live[hits >= enough]] = wide
            live, wide = live[hits < enough], wide * growth
        return radius


def _verified(index: SortedLines, gids, queries: np.ndarray, names, radius: np.ndarray, most: np.ndarray):
    """(query, row, distance, whether it counts) of the rows that collide and are no farther than ``most``, nearest first.

    Counted are rows whose smallest id is neither the query's own nor that of the row before at the same distance.
    """
    q, r = index.search(queries, radius)
    d = distances(index.x, r, queries, q)
    near = d <= most[q]
    q, r, d = q[near], r[near], d[near]
    by = np.lexsort((r, d, q))
    q, r, d = q[by], r[by], d[by]
    counts = gids[r] != names[q]
    counts[1:] &= (q[1:] != q[:-1]) | (d[1:] != d[:-1]) | (gids[r[1:]] != gids[r[:-1]])
    return q, r, d, counts


def _opened(index: SortedLines, gids, queries: np.ndarray, names, k: int) -> np.ndarray:
    """A radius for queries without one: no less than their k-th distance in the piece, infinity if unknown."""
    wide, radius = index.widened(queries, k + 1), np.full(len(queries), np.inf)
    some = np.flatnonzero(np.isfinite(wide))
    q, _, d, counts = _verified(index, gids, queries[some], names[some], wide[some], radius[some])
    q, d = q[counts], d[counts]
    kth = np.searchsorted(q, np.arange(len(some))) + k - 1
    has = kth < np.searchsorted(q, np.arange(len(some)), "right")
    radius[some[has]] = d[kth[has]]
    return radius


def _block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, projections: int, width: float = 1.5, miss: float = 0.02) -> pd.DataFrame:
    if not len(vectors) or not len(queries):
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "score": np.zeros(0), "ids": np.zeros(0, object)})
    vectors = vectors.sort_values("gid", kind="stable").reset_index(drop=True)
    x, qs = matrix(vectors["v"]), matrix(queries["v"])
    ids, gids, names, radius = vectors["ids"].to_numpy(), vectors["gid"].to_numpy(), queries["query_id"].to_numpy(), queries["radius"].to_numpy().copy()
    lines, half = frames(x.shape[1], projections), width / np.sqrt(x.shape[1])
    least = threshold(lines, half, miss)
    best = np.full((len(qs), k), np.inf)  # distances of the nearest counted rows so far
    out = []
    for start in range(0, len(x), PIECE):
        index, own = SortedLines(x[start:start + PIECE], lines, least, half), gids[start:start + PIECE]
        for at in range(0, len(qs), CHUNK):
            part, name, now = qs[at:at + CHUNK], names[at:at + CHUNK], radius[at:at + CHUNK]
            free = np.flatnonzero(np.isinf(now))
            if len(free):
                now[free] = _opened(index, own, part[free], name[free], k)
            q, r, d, counts = _verified(index, own, part, name, now, now)
            before = np.cumsum(counts) - counts
            rank = before - before[np.searchsorted(q, q)]
            keep = rank < k
            out.append(pd.DataFrame({"query_id": name[q], "at": at + q, "score": d, "ids": ids[start + r]})[keep])
            fresh = np.full((len(part), k), np.inf)
            fresh[q[keep & counts], rank[keep & counts]] = d[keep & counts]
            best[at:at + CHUNK] = np.sort(np.hstack([best[at:at + CHUNK], fresh]), axis=1)[:, :k]
            now[:] = np.minimum(now, best[at:at + CHUNK, -1])
    found = pd.concat(out)
    return found[found["score"].to_numpy() <= radius[found["at"].to_numpy()]].drop(columns="at")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest distinct rows of every query."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _met(index: DataFrame, rows: int, asked: DataFrame, asking: int, k: int, per_block: int, projections: int) -> DataFrame:
    """(query_id, vec_id, score) found where every block of queries meets every block of vectors."""
    slots = index.sparkSession.sparkContext.defaultParallelism
    blocks, groups = blocks_for(rows, min(per_block, max(1024, rows // (2 * slots)))), blocks_for(asking, per_block)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select("gid", "ids", "v", "dim", F.pmod(F.xxhash64("gid"), F.lit(blocks)).cast("int").alias("b"), every(groups).alias("g"))
    right = asked.select(F.col("vec_id").alias("query_id"), "v", "dim", "radius", every(blocks).alias("b"),
                         F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _block(a, b, k, projections)

    found = left.groupBy("dim", "b", "g").cogroup(right.groupBy("dim", "b", "g")).applyInPandas(
        run, "query_id long, score double, ids array<long>")
    return found.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id != query_id")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, per_block: int | None = None, projections: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found of every query row (vec_id, embedding).

    A block holds ``per_block`` rows at most on average, by default as many as make four million components.
    """
    rows = settled(usable(vectors))
    index = settled(classes(rows, k + 1).withColumn("dim", F.size("v")))
    asked = settled(usable(queries).withColumn("dim", F.size("v")))
    n, dim = index.agg(F.count(F.lit(1)), F.max("dim")).first()
    asking, per_block = asked.count(), per_block or max(1, (1 << 22) // (dim or 1))
    parts = max(1, min(16, n // 2048))
    part = F.pmod(F.xxhash64("gid", F.lit(1)), F.lit(parts))
    free = asked.withColumn("radius", F.lit(float("inf")))
    first = _ranked(_met(index.filter(part == 0), n // parts, free, asking, k, per_block, projections), k)
    if parts == 1:
        return first
    first = settled(first)
    radius = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("radius"))
    bound = asked.join(radius, "vec_id", "left").fillna(float("inf"), ["radius"])
    rest = _met(index.filter(part != 0), n - n // parts, bound, asking, k, per_block, projections)
    return _ranked(rest.unionByName(first.drop("rank")), k)
