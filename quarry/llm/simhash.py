"""SimHash near-duplicates by segment-popcount embedding.

A 64-bit fingerprint is cut into 16 segments of 4 bits; the 16 bit counts are
a point on an integer grid.  The Manhattan distance of two points is never
more than the bit distance of their fingerprints, so fingerprints within 2
bits lie within Manhattan distance 2, hence share a grid cell within distance
1 of both.  Every distinct fingerprint is put into its own cell and the cells
one step away (33 at most), equal cells are joined, and pairs that meet are
verified on the exact bit distance.

Skew: copies collapse to one fingerprint before the join.  A cell of two
fingerprints yields its pair from ``min``/``max`` alone; small cells are
joined; fingerprints of crowded cells are linked through their one-bit
variants instead (two fingerprints within 2 bits share a variant, and all
holders of a variant are within 2 bits of each other, so a star around the
smallest keeps them connected).  No cell is dropped and no group is expanded
into all its pairs.  Spark sizes an exploded table like the table before the
explode (33 and 65 times too low here), so tables of cells and variants are
joined by sorting, never broadcast.

Cases: a null or empty text, or one without words, has fingerprint zero and
links like any other; fewer words than a shingle give one shingle of the whole
sequence; repeated rows get the same fingerprint and component; an empty table
gives an empty result; further columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import settled
from quarry.llm.components import components

SEED = 42
SEGMENTS, WIDTH = 16, 4
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles (zero without words)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    k = min(shingle, len(words))
    stop = (start + size)[k - 1:]
    n = len(stop)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, _CHUNK):
        part = zip(start[lo:lo + _CHUNK].tolist(), stop[lo:lo + _CHUNK].tolist())
        h = np.fromiter((digest(line[s:e], SEED) for s, e in part), np.uint64)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: str, shingle: int) -> Column:
    """Signed long holding the fingerprint's 64 bits, by an Arrow-batched helper."""

    def run(texts: pd.Series) -> pd.Series:
        bits = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(bits.view(np.int64))

    return F.pandas_udf(run, "long")(F.col(text))


def _grid_point(fp: str) -> Column:
    """Bit counts of the 16 segments, packed in one long (4 bits a segment)."""
    ones = F.lit(0x1111111111111111)
    point = F.col(fp).bitwiseAND(ones)
    for i in range(1, WIDTH):
        point = point + F.shiftrightunsigned(F.col(fp), i).bitwiseAND(ones)
    return point


def _cells(point: str) -> Column:
    """The fingerprint's grid cell and all valid cells one step away."""
    steps = [F.col(point)]
    for i in range(SEGMENTS):
        n = F.shiftrightunsigned(F.col(point), WIDTH * i).bitwiseAND(F.lit(15))
        unit = F.lit(1 << WIDTH * i)
        steps += [F.when(n < WIDTH, F.col(point) + unit), F.when(n > 0, F.col(point) - unit)]
    return F.array_compact(F.array(*steps))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def fingerprint_links(fps: DataFrame, max_bits: int = 2, crowded: int = 64) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints ``fp`` within ``max_bits``.

    Of a crowded cell only a star per one-bit variant is returned, which has
    the same components as all its links.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the one-step grid covers bit distances 0 to 2")
    cells = (fps.select("fp", _grid_point("fp").alias("point"))
                .select("fp", F.explode(_cells("point")).alias("cell")))
    met = settled(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                       .filter("n > 1"))
    members = settled(cells.hint("merge").join(met.filter("n > 2").select("cell", "n"), "cell"))
    near = members.filter(F.col("n") <= crowded)
    small = near.select("cell", F.col("fp").alias("a")).join(near.select("cell", F.col("fp").alias("b")), "cell") \
                .filter("a < b")
    hot = members.filter(F.col("n") > crowded).select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")) for i in range(64)]
    variants = hot.select("fp", F.explode(F.array(*flips)).alias("variant"))
    least = variants.groupBy("variant").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = variants.hint("merge").join(least.select("variant", "a"), "variant").filter("fp != a").select("a", F.col("fp").alias("b"))
    pairs = met.filter("n = 2").select("a", "b").unionByName(small.select("a", "b")).unionByName(stars)
    return pairs.distinct().filter(_distance("a", "b") <= max_bits)


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id."""
    prints = settled(docs.select("doc_id", fingerprint_column("text", shingle).alias("fp")))
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    roots = components(fingerprint_links(firsts.select("fp"), max_bits), "a", "b")
    named = (firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                   .select("fp", "first_doc", F.coalesce("component", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_print = named.join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Keep the smallest doc_id of every component; all columns pass through.

    Rows without a doc_id cannot be told apart and are kept.
    """
    groups = simhash_groups(docs, shingle, max_bits)
    gone = groups.filter("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
