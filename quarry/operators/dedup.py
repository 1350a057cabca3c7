"""A1/A2/J1 exact line dedup and A3-A6/J2-J5/W9 MinHash-LSH dedup."""

from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.arrow import pieces
from quarry.session import reliable_checkpoint

try:  # the built-in digest starts faster than the OpenSSL one, which matters for short shingles
    from _md5 import md5 as _md5
except ImportError:
    _md5 = hashlib.md5

# ---------------------------------------------------------------------------
# Exact line dedup
# ---------------------------------------------------------------------------


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos, h): one row per line, h = md5(line) as 16 raw bytes."""
    return (docs.select(key, F.posexplode(T.file_lines(text)).alias("pos", "line"))
                .select(key, "pos", F.unhex(F.md5("line")).alias("h")))


def line_frequency(docs: DataFrame, text: str = "text") -> DataFrame:
    """A1: (line_hash, cnt) over the corpus; only md5 digests enter the hash aggregation, never whole lines."""
    return (docs.select(F.explode(T.file_lines(text)).alias("line"))
                .groupBy(F.md5("line").alias("line_hash")).agg(F.count(F.lit(1)).alias("cnt")))


def frequent_lines(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """A1: the k most frequent lines (line_hash, cnt, line); their texts are looked up for these k alone."""
    top = line_frequency(docs, text).orderBy(F.desc("cnt"), "line_hash").limit(k)
    lines = docs.select(F.explode(T.file_lines(text)).alias("line")).withColumn("line_hash", F.md5("line"))
    found = lines.join(F.broadcast(top), "line_hash")  # k rows
    return found.groupBy("line_hash", "cnt").agg(F.min("line").alias("line"))


def unique_line_positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pos) of every line that occurs exactly once in the whole corpus.

    A line that occurs once has exactly one (key, pos); carrying its minima
    through the hash aggregation yields it without joining lines back to the
    counts, so a hot line (say a blank line in a third of all rows) is folded
    map-side and never concentrates in one task.
    """
    # For a count-1 group min(key) and min(pos) come from its only row; both
    # buffers are fixed-width, so this stays a hash aggregation.
    return (line_hashes(docs, key, text)
            .groupBy("h")
            .agg(F.count(F.lit(1)).alias("c"), F.min(key).alias(key), F.min("pos").alias("pos"))
            .filter(F.col("c") == 1)
            .select(key, "pos"))


def exact_line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A2: keep only lines occurring exactly once in the corpus.

    Output keeps every document; its text is the kept lines, each followed by
    a newline ('' when nothing is kept), as the reference's rewritten files.
    """
    kept = (unique_line_positions(docs, key, text)
            .groupBy(key).agg(F.array_sort(F.collect_list("pos")).alias("_keep")))
    kept_lines = F.transform(F.col("_keep"), lambda i: F.element_at(F.col("_lines"), i + 1))
    new_text = F.when(F.size(F.col("_keep")) > 0,
                      F.concat(F.array_join(kept_lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return (docs.join(kept, key, "left")
                .withColumn("_keep", F.coalesce(F.col("_keep"), F.array().cast("array<int>")))
                .withColumn("_lines", T.file_lines(text))
                .withColumn("n_lines", F.size("_lines").cast("bigint"))
                .withColumn("n_kept", F.size("_keep").cast("bigint"))
                .withColumn(text, new_text)
                .drop("_keep", "_lines"))


# ---------------------------------------------------------------------------
# MinHash LSH
# ---------------------------------------------------------------------------

INF = b"inf"  # signature value of an empty shingle set
_EPS = 1e-9   # keeps rounding on the safe side of the size bounds


def normalized_words(low: str) -> list[str]:
    """Words of P14's normalised form of a text that is in lower case: NFD, punctuation out, split at whitespace.

    The characters of a document are looked up once each; a punctuation mark
    then goes by ``replace``, so the cost stays that of a few scans.
    """
    if not low.isascii():
        low = unicodedata.normalize("NFD", low)
    for c in set(low):
        if unicodedata.category(c)[0] == "P":
            low = low.replace(c, "")
    return low.split()


def shingles(words: list[str], n: int) -> list[bytes]:
    """A3 distinct word n-grams in UTF-8; none when there are fewer than n words."""
    w = [x.encode("utf-8", "surrogatepass") for x in words]
    return list(dict.fromkeys(b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)))


def min_hashes(grams: list[bytes], num_hashes: int) -> list[bytes]:
    """A4 for i in 0..k-1: min over shingles of md5(str(i) + shingle), as raw bytes (the 128-bit integer order)."""
    return [min([_md5(salt + g).digest() for g in grams]) if grams else INF
            for salt in (str(i).encode() for i in range(num_hashes))]


def band_keys(sig: list[bytes], num_bands: int) -> list[bytes]:
    """W9 one 16-byte key per band: md5 of the band's signature values; rows past the last whole band are not used."""
    r = len(sig) // num_bands
    return [_md5(b",".join(sig[b * r:b * r + r])).digest() for b in range(num_bands)]


def jaccard(a: Column, b: Column) -> Column:
    """A6 on distinct arrays: both empty -> 1.0, one empty -> 0.0."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
             .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
             .otherwise(inter.cast("double") / union))


def _check(num_hashes, num_bands, ngrams):
    if num_bands <= 0 or num_hashes <= 0 or num_bands > num_hashes:
        raise ValueError("need 0 < num_bands <= num_hashes")
    if ngrams <= 0:
        raise ValueError("ngrams must be positive")


def _mapped(docs: DataFrame, ngrams: int, key: str, text: str, describe, columns: str) -> DataFrame:
    """(doc_id, columns): an Arrow map from a document's distinct shingles to ``describe``'s arrays, narrow."""
    def run(batches):
        for batch in pieces(batches):
            grams = [shingles(normalized_words(t), ngrams) if t else [] for t in batch.column(1).to_pylist()]
            arrays = describe(grams)
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays.values()], ["doc_id", *arrays])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.lower(text).alias("low")).mapInArrow(run, f"doc_id {kind}, {columns}")


def signatures(docs: DataFrame, num_hashes: int, num_bands: int, ngrams: int,
               key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sz, set_key, bands) per document, without a shuffle.

    One Arrow map takes a document to its distinct shingles, their seeded
    minima and the band keys; no shingle leaves the task, a document goes on as
    about 150 bytes.  ``set_key`` is the digest of the whole shingle set,
    ``sz`` its size.
    """
    _check(num_hashes, num_bands, ngrams)

    def describe(sets):
        return {"sz": pa.array([len(g) for g in sets], pa.int32()),
                "set_key": pa.array([_md5(b"\n".join(sorted(g))).digest() for g in sets], pa.binary()),
                "bands": pa.array([band_keys(min_hashes(g, num_hashes), num_bands) for g in sets], pa.list_(pa.binary()))}

    return _mapped(docs, ngrams, key, text, describe, "sz int, set_key binary, bands array<binary>")


def shingle_sets(docs: DataFrame, ngrams: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sh): distinct shingles by 64 bits of their digest; built for candidates only, after the band join."""
    def describe(sets):
        return {"sh": pa.array([list({int.from_bytes(_md5(x).digest()[:8], "little", signed=True) for x in g}) for g in sets],
                               pa.list_(pa.int64()))}

    return _mapped(docs, ngrams, key, text, describe, "sh array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Keep (i, j) whose shingle sets reach the Jaccard threshold; returns j."""
    a = sets.select(F.col("doc_id").alias("i"), F.col("sh").alias("sh_i"))
    b = sets.select(F.col("doc_id").alias("j"), F.col("sh").alias("sh_j"))
    return (pairs.join(a, "i").join(b, "j")
                 .filter(jaccard(F.col("sh_i"), F.col("sh_j")) >= threshold)
                 .select("j").distinct())


def _size_ok(a, b, threshold: float) -> Column:
    """Jaccard <= min/max of the set sizes: pairs below t by size alone never get their sets joined in."""
    return F.least(a, b) >= F.lit(threshold) * F.greatest(a, b) - F.lit(_EPS)


def _reach(pos_a, size_a, pos_b, size_b, threshold: float) -> Column:
    """Position filter: what can still be shared from a first common shingle on is enough for the threshold."""
    need = F.lit(threshold / (1.0 + threshold)) * (size_a + size_b) - F.lit(_EPS)
    return F.least(size_a - pos_a, size_b - pos_b) + 1 >= need


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, tok, pos, sz): the shingles of which two sets of Jaccard >= t must share one.

    Shingles are ordered by how many of the given sets hold them, rarest
    first; a set's prefix is its first sz - ceil(t sz) + 1 of them.  Shingles
    that no other set holds keep their position but meet nobody and go.
    """
    toks = sets.select("doc_id", F.size("sh").alias("sz"), F.explode("sh").alias("tok"))
    often = toks.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("doc_id").orderBy("df", "tok")
    last = F.col("sz") - F.ceil(F.col("sz") * threshold - _EPS) + 1
    return (toks.join(often, "tok").withColumn("pos", F.row_number().over(order))
                .filter((F.col("pos") <= last) & (F.col("df") > 1)).select("doc_id", "tok", "pos", "sz"))


def minhash_removed(docs: DataFrame, num_hashes: int = 20, num_bands: int = 5,
                    ngrams: int = 5, threshold: float = 0.8,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """A5 ids removed by MinHash-LSH dedup (reference rule, N3).

    ``j`` is removed iff some ``i < j`` shares an LSH bucket with it and
    Jaccard(i, j) >= threshold.  Exact plan without all-pairs buckets:

    1. documents with equal shingle sets collapse to the lowest id (N3e);
       the copies are removed by definition;
    2. leader pass: every bucket member is checked against the bucket's
       lowest id only (one pair per member and bucket);
    3. residual pass: members not yet removed are joined with the other lower
       members of their buckets on the rare shingles of their prefixes
       (:func:`prefixes`), first with the lowest of each (bucket, shingle),
       then, where that removes nothing, with the rest.  Documents that only
       share a bucket meet nobody, so a bucket of dissimilar documents costs
       in proportion to its members.

    Pairs whose set sizes alone rule out Jaccard >= t are dropped before the
    shingle sets are joined in, and shingle sets are built for documents of
    such pairs only.  Signatures, bucket members and the residual's parts are
    written to the shared checkpoint folder, each once.
    """
    if threshold > 1.0:
        return docs.sparkSession.range(0).select(F.col("id").alias("doc_id")).limit(0)
    sig = reliable_checkpoint(signatures(docs, num_hashes, num_bands, ngrams, key, text))
    reps = reliable_checkpoint(sig.groupBy("set_key").agg(F.min("doc_id").alias("rep")).select("rep"))
    # Copies are keyed by the unique doc id, never by the (possibly hot) set key.
    copies = sig.select(F.col("doc_id").alias("j")).join(reps.select(F.col("rep").alias("j")), "j", "left_anti")
    rep_sig = sig.join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")

    members = rep_sig.select("doc_id", "sz", F.posexplode("bands").alias("band", "bkey"))
    leaders = members.groupBy("band", "bkey").agg(F.min("doc_id").alias("leader"), F.min_by("sz", "doc_id").alias("leader_sz"),
                                                  F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    m = reliable_checkpoint(members.join(leaders, ["band", "bkey"]))
    follows = F.col("doc_id") > F.col("leader")
    if threshold <= 0.0:
        removed = m.filter(follows).select(F.col("doc_id").alias("j"))
        return copies.unionByName(removed).distinct().withColumnRenamed("j", "doc_id")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = ids.select(F.col("doc_id").alias(key)).distinct()
        return reliable_checkpoint(shingle_sets(docs.select(key, text).join(wanted, key, "left_semi"), ngrams, key, text))

    p1 = (m.filter(follows & _size_ok(F.col("sz"), F.col("leader_sz"), threshold))
           .select(F.col("leader").alias("i"), F.col("doc_id").alias("j")).distinct())
    p1 = reliable_checkpoint(p1)
    in_p1 = p1.select(F.explode(F.array("i", "j")).alias("doc_id"))
    removed1 = reliable_checkpoint(_verified(p1, sets_of(in_p1), threshold))
    done = copies.unionByName(removed1)

    # residual: unresolved members, and the lower members they may still match
    gone = removed1.select(F.col("j").alias("doc_id"), F.lit(False).alias("is_open"))
    marked = m.filter(follows).select("band", "bkey", "doc_id").join(gone, "doc_id", "left") \
              .withColumn("is_open", F.coalesce("is_open", F.lit(True)))
    # the leader pass settled buckets without an open member above their second-lowest
    buckets = marked.groupBy("band", "bkey").agg(F.max(F.when(F.col("is_open"), F.col("doc_id"))).alias("last"),
                                                 F.min("doc_id").alias("second")).filter("last > second")
    rest = reliable_checkpoint(marked.join(buckets.drop("second"), ["band", "bkey"]).filter("doc_id <= last").drop("last"))
    if rest.isEmpty():
        return done.distinct().withColumnRenamed("j", "doc_id")
    sets = sets_of(rest)
    spots = reliable_checkpoint(rest.join(prefixes(sets, threshold), "doc_id"))
    place = ["band", "bkey", "tok"]
    first = spots.groupBy(*place).agg(F.min(F.struct("doc_id", "sz", "pos")).alias("low"))

    def may_match(i, size_i, pos_i):
        return ((F.col(i) < F.col("doc_id")) & _size_ok(F.col(size_i), F.col("sz"), threshold)
                & _reach(F.col(pos_i), F.col(size_i), F.col("pos"), F.col("sz"), threshold))

    p2 = (spots.filter("is_open").join(first, place).filter(may_match("low.doc_id", "low.sz", "low.pos"))
               .select(F.col("low.doc_id").alias("i"), F.col("doc_id").alias("j")).distinct())
    removed2 = reliable_checkpoint(_verified(p2, sets, threshold))
    lower = spots.select(*place, F.col("doc_id").alias("i"), F.col("sz").alias("sz_i"), F.col("pos").alias("pos_i"))
    p3 = (spots.filter("is_open").join(removed2.withColumnRenamed("j", "doc_id"), "doc_id", "left_anti")
               .join(lower, place).filter(may_match("i", "sz_i", "pos_i"))
               .select("i", F.col("doc_id").alias("j")).distinct())
    removed3 = _verified(p3, sets, threshold)
    return done.unionByName(removed2).unionByName(removed3).distinct().withColumnRenamed("j", "doc_id")


def minhash_dedup(docs: DataFrame, num_hashes: int = 20, num_bands: int = 5,
                  ngrams: int = 5, threshold: float = 0.8,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """A5 surviving documents (J5 anti join on the removed ids)."""
    removed = minhash_removed(docs, num_hashes, num_bands, ngrams, threshold, key, text)
    return docs.join(removed.withColumnRenamed("doc_id", key), key, "left_anti")
