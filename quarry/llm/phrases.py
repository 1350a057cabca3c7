"""Phrase collocation mining by the stripes pattern.

A stripe is an associative counter: its key is a prefix of none to four words,
its entries the words that follow with their counts.  A task builds one stripe
per prefix and chunk of text, stripes of a prefix are merged entry by entry, and
the merged stripes give all the mining needs: an entry is the count of the
extended phrase, the entry of a prefix in the stripe one word shorter is the
prefix total, and the largest entry of a stripe says whether an extension
subsumes the prefix (extensions to the left: the same entries by the words
behind the first).

Most phrases of a corpus are rare, and a stripe entry for each would cost more
than the corpus.  So hashes go ahead: words, then pairs of words that may be
frequent, then runs of such pairs, are counted by 32 + log2(shards) bits of a
hash, packed as sorted differences.  Equal hashes add up, so a total is never
too small: what stays below the least count is rare for certain, and only the
rest enters the stripes, which count exactly.  The tasks get what may be frequent
as bitmaps of ``FILTER_BITS`` bits, a fixed size whatever the corpus; false
positives cost entries that the exact counts drop, nothing is missed.

Skew: chunks are folded before every shuffle, so a pair in a third of all text
is one entry per chunk.  Entries are dealt into parts by the hash of their
prefix; the empty prefix and prefixes of words that each make up a thousandth
of all words (at most a thousand such words) are dealt by prefix and next word,
so no task merges a whole wide stripe.  Parts and shards grow with the number
of words (one per 2^20, 256 to 16,384).  The look-ups of parts are joins with
unique keys on one side, which Spark's skew join may split.  A long text is cut
between pieces; every piece is read whole.

Cases: null text is empty, null lang is ``und``; words are cut at blanks and
tabs inside pieces only, so other signs (letters of any script, NUL) belong to
words; repeated rows count again; texts without words and empty tables give no
phrase; further columns take no part; ties go by the order stated at
:func:`mine`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import settled

LONGEST = 5
FILTER_BITS = 1 << 26  # 8 MB
HOT_SHARE = 1000       # words of at least n / HOT_SHARE occurrences: at most HOT_SHARE of them
CHUNK = 8 << 20        # bytes of text of one language that are counted together
WORD_SHARDS = 1 << 8
_CUT = ord(".")        # stands for every piece end; no word holds it
_TABLE = bytes(_CUT if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_SKETCH = "shard long, lang string, n long, low binary, counts binary"
_STRIPES = "part long, lang string, prefixes binary, sizes binary, words binary, counts binary"


# ---------------------------------------------------------------------------
# Text to words
# ---------------------------------------------------------------------------

def _cut_up(text: bytes):
    """Parts of a long text, cut at piece ends (a piece alone may be longer than a chunk)."""
    lo = 0
    while len(text) - lo > CHUNK:
        hi = text.find(b".", lo + CHUNK)
        if hi < 0:
            break
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def _parts(batches):
    """(lang, texts) with about CHUNK bytes of one language each."""
    held: dict[str, tuple[list, int]] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _cut_up(text.as_py().translate(_TABLE)):
                parts, size = held.get(lang, ([], 0))
                parts.append(part)
                held[lang] = (parts, size + len(part))
                if size + len(part) >= CHUNK:
                    yield lang, held.pop(lang)[0]
    while held:
        lang, (parts, _) = held.popitem()
        yield lang, parts


class _Chunk:
    """Words of one chunk: ``codes`` in order (the last code is a piece end), ``names`` and ``hashes`` by code."""

    def __init__(self, lang: str, parts: list[bytes]):
        words = b".".join(parts).replace(b".", b" . ").split()
        codes, names = pd.factorize(np.array([b".", *words, None], object)[:-1])  # so code 0 is the piece end
        self.names = [b"", *names[1:]]
        self.codes = np.concatenate([codes, np.zeros(LONGEST, codes.dtype)])  # no phrase runs over the end
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.names), np.uint64, len(self.names))
        self._rolled = {1: self.hashes[self.codes]}

    def rolled(self, width: int) -> np.ndarray:
        """Hash of the ``width`` words from every place on."""
        if width not in self._rolled:
            short = self.rolled(width - 1)
            self._rolled[width] = _mix(short[:-1] * np.uint64(0x9E3779B97F4A7C15) + self._rolled[1][width - 1:])
        return self._rolled[width]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) ^ (x >> np.uint64(32))


# ---------------------------------------------------------------------------
# What may be frequent
# ---------------------------------------------------------------------------

def _present(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes >> np.uint64(65 - FILTER_BITS.bit_length())).astype(np.int64)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _places(chunk: _Chunk, words, pairs=None, longer=None):
    """(width, places) of the phrases that the known bitmaps let pass; those of the next width follow from the last."""
    if words is None:
        return
    good = (_present(words, chunk.hashes) & (np.arange(len(chunk.hashes)) > 0))[chunk.codes]
    yield 1, np.flatnonzero(good)
    at = np.flatnonzero(good[:-1] & good[1:])
    if pairs is None:
        yield 2, at
        return
    at = at[_present(pairs, chunk.rolled(2)[at])]
    link = np.zeros(len(good), bool)
    link[at] = True
    yield 2, at
    for width in range(3, LONGEST + 1):
        at = at[link[at + width - 2]]
        if longer is not None:
            at = at[_present(longer, chunk.rolled(width)[at])]
        yield width, at


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 byte plane by byte plane: small ones leave planes of zeros, which compress away."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


def _sketcher(known, shards: int):
    """Arrow map from (lang, text) to packed counts of hashes: words, pairs or longer phrases, as far as bitmaps are known."""
    def run(batches):
        drop = np.uint64(33 - shards.bit_length())  # leaves the shard and 32 bits
        maps = [b.value for b in known]
        for lang, parts in _parts(batches):
            chunk = _Chunk(lang, parts)
            if not maps:
                times = np.bincount(chunk.codes, minlength=len(chunk.names))[1:]
                order = np.argsort(chunk.hashes[1:])
                hashes, times = chunk.hashes[1:][order], times[order]
                yield _row(-1, lang, int(times.sum()), b"", b"")
            else:
                wanted = 2 if len(maps) == 1 else 3
                hashes = [chunk.rolled(w)[at] for w, at in _places(chunk, *maps) if w >= wanted]
                hashes, times = np.unique(np.concatenate(hashes), return_counts=True)
            if not len(hashes):
                continue
            number = hashes >> drop
            shard = (number >> np.uint64(32)).astype(np.int64)
            start = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            low = (number & np.uint64(0xFFFFFFFF)).astype(np.int64)
            step = np.diff(low, prepend=0)
            step[start] = low[start]
            ends = np.r_[start[1:], len(low)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[start], pa.int64()), pa.nulls(len(start), pa.string()), pa.nulls(len(start), pa.int64()),
                 pa.array([_planes(step[a:b]) for a, b in zip(start, ends)], pa.binary()),
                 pa.array([_planes(np.minimum(times[a:b], 0xFFFFFFFF)) for a, b in zip(start, ends)], pa.binary())],
                ["shard", "lang", "n", "low", "counts"])
    return run


def _row(shard, lang, n, low, counts):
    return pa.RecordBatch.from_pylist([{"shard": shard, "lang": lang, "n": n, "low": low, "counts": counts}], pa.schema(
        [("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("low", pa.binary()), ("counts", pa.binary())]))


def _folded(low: list, counts: list):
    """Sums by number of several sorted lists."""
    low, counts = np.concatenate(low), np.concatenate(counts)
    order = np.argsort(low, kind="stable")
    low, counts = low[order], counts[order]
    start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    return low[start], np.add.reduceat(counts, start)


def _summed(least: int):
    """Arrow map from shards' rows (sorted by shard) to (h, total) of totals of ``least`` or more, and (lang, n)."""
    def run(batches):
        shard, low, counts, held = None, [], [], 0
        schema = pa.schema([("h", pa.int64()), ("total", pa.int64()), ("lang", pa.string())])

        def closed():
            numbers, sums = _folded(low, counts)
            pick = sums >= least
            return pa.RecordBatch.from_arrays([pa.array(shard << 32 | numbers[pick], pa.int64()), pa.array(sums[pick], pa.int64()),
                                               pa.nulls(int(pick.sum()), pa.string())], schema=schema)
        for batch in batches:
            for s, lang, n, steps, times in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if s < 0:
                    yield pa.RecordBatch.from_pylist([{"h": None, "total": n, "lang": lang}], schema)
                    continue
                if s != shard and low:
                    yield closed()
                    low, counts, held = [], [], 0
                shard = s
                low.append(np.cumsum(_numbers(steps)))
                counts.append(_numbers(times))
                held += len(low[-1])
                if held > 1 << 22 and len(low) > 1:
                    a, b = _folded(low, counts)
                    low, counts, held = [a], [b], 0
        if low:
            yield closed()
    return run


def _likely(text: DataFrame, known: list, shards: int, least: int) -> DataFrame:
    """(h, total, lang): hashes whose total reaches ``least``; rows without h hold the words of a language."""
    width = int(text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = text.mapInArrow(_sketcher(known, shards), _SKETCH)
    return settled(packed.repartition(width, "shard").sortWithinPartitions("shard")
                         .mapInArrow(_summed(least), "h long, total long, lang string"))


def _bitmap(spark, likely: DataFrame, shards: int):
    """Broadcast bitmap of the likely hashes: FILTER_BITS bits, collected as at most FILTER_BITS / 64 words."""
    slot = F.shiftright("h", 32 + shards.bit_length() - FILTER_BITS.bit_length())  # the leading bits, as in _present
    words = likely.filter("h is not null").select(F.shiftright(slot, 6).cast("int").alias("at"), (slot % 64).cast("int").alias("bit")) \
                  .select("at", F.expr("shiftleft(1L, bit)").alias("bits")).groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words["at"].to_numpy()] = words["bits"].to_numpy()
    return spark.sparkContext.broadcast(out.view(np.uint8))


# ---------------------------------------------------------------------------
# Stripes
# ---------------------------------------------------------------------------

def _entries(chunk: _Chunk, width: int, at: np.ndarray):
    """Example place and count of every phrase of ``width`` words at the places, told apart by their words, not their hashes."""
    number = chunk.codes[at].astype(np.int64)
    for k in range(1, width):
        _, number = np.unique(number * len(chunk.names) + chunk.codes[at + k], return_inverse=True)
    _, example, counts = np.unique(number, return_index=True, return_counts=True)
    return at[example], counts


def _striper(known, hot_bc, parts: int):
    """Arrow map from (lang, text) to stripes, those of one part in one row."""
    def run(batches):
        maps, hot = [b.value for b in known], hot_bc.value
        for lang, texts in _parts(batches):
            chunk = _Chunk(lang, texts)
            names, rows = chunk.names, {}
            is_hot = np.isin(chunk.hashes >> np.uint64(33 - WORD_SHARDS.bit_length()), hot.astype(np.uint64))
            for width, at in _places(chunk, *maps):
                if not len(at):
                    continue
                place, counts = _entries(chunk, width, at)
                by_entry = np.ones(len(place), bool)  # the empty prefix and hot ones are dealt entry by entry
                for k in range(width - 1):
                    by_entry &= is_hot[chunk.codes[place + k]]
                key = chunk.rolled(width)[place]
                if width > 1:
                    key = np.where(by_entry, key, chunk.rolled(width - 1)[place])
                part = (key % np.uint64(parts)).astype(np.int64)
                order = np.lexsort((key, part))
                part, key, place, counts = part[order], key[order], place[order], counts[order]
                # a stripe's entries stand together; a prefix of equal hash only ends the run early
                codes = chunk.codes[place[:, None] + np.arange(width - 1)]
                new = np.r_[True, (key[1:] != key[:-1]) | (codes[1:] != codes[:-1]).any(1)]
                edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                for a, b in zip(edge, np.r_[edge[1:], len(part)]):
                    first = a + np.flatnonzero(np.r_[True, new[a + 1:b]])
                    prefixes = [b" ".join([names[c] for c in codes[i].tolist()]) for i in first.tolist()]
                    words = [names[c] for c in chunk.codes[place[a:b] + width - 1].tolist()]
                    rows.setdefault(int(part[a]), []).append((prefixes, np.diff(np.r_[first, b]), words, counts[a:b]))
            if rows:
                out = []
                for part, stripes in rows.items():
                    p, s, w, c = zip(*stripes)
                    out.append((part, lang, b".".join(x for y in p for x in y), _planes(np.concatenate(s)),
                                b".".join(x for y in w for x in y), np.concatenate(c).astype("<i8").tobytes()))
                kinds = [pa.int64(), pa.string(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["part", "lang", "prefixes", "sizes", "words", "counts"])
    return run


def _merger(least: int):
    """Arrow map that adds the stripes of each (part, lang) entry by entry; entries of ``least`` or more leave it."""
    def run(batches):
        key, phrases, counts, held = None, [], [], 0

        def folded():
            # of bytes: text with NUL would be cut short
            codes, names = pd.factorize(np.array([*phrases, None], object)[:-1])
            sums = np.zeros(len(names), np.int64)
            np.add.at(sums, codes, np.concatenate(counts))
            return names, sums

        def closed():
            names, sums = folded()
            pick = np.flatnonzero(sums >= least)
            split = [names[i].split(b".", 1) for i in pick]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[1]] * len(pick), pa.string()), pa.array([p for p, _ in split], pa.binary()).cast(pa.string()),
                 pa.array([w for _, w in split], pa.binary()).cast(pa.string()), pa.array(sums[pick], pa.int64())],
                ["lang", "prefix", "word", "cnt"])

        for batch in batches:
            for part, lang, prefixes, sizes, words, times in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (part, lang) != key and phrases:
                    yield closed()
                    phrases, counts, held = [], [], 0
                key = (part, lang)
                owner = np.repeat(np.array([*prefixes.split(b"."), None], object)[:-1], _numbers(sizes))
                phrases += [p + b"." + w for p, w in zip(owner.tolist(), words.split(b"."))]
                counts.append(np.frombuffer(times, "<i8"))
                held += len(counts[-1])
                if held > 1 << 20 and len(counts) > 1:
                    names, sums = folded()
                    phrases, counts, held = names.tolist(), [sums], 0
        if phrases:
            yield closed()
    return run


def merged_stripes(text: DataFrame, known: list, hot, parts: int, least: int) -> DataFrame:
    """(lang, prefix, word, cnt): the entries of ``least`` or more of the merged stripes, prefixes of 0 to 4 words."""
    width = int(text.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripes = text.mapInArrow(_striper(known, hot, parts), _STRIPES)
    return stripes.repartition(width, "part").sortWithinPartitions("part", "lang") \
                  .mapInArrow(_merger(least), "lang string, prefix string, word string, cnt long")


# ---------------------------------------------------------------------------
# Mining
# ---------------------------------------------------------------------------

def _shards(words: int) -> int:
    return min(1 << 14, max(1 << 8, 1 << (words >> 20).bit_length()))


def mine(docs: DataFrame, least: int = 100, percent: int = 100, top: int | None = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): collocations of 2 to 5 words, best first.

    ``a``: occurrences of the phrase (``least`` or more); ``l``, ``r``:
    occurrences of its two parts at the cut of lowest score, the first such cut
    on ties; ``n``: words of the language; score = floor(1000 a n / (l r)) in
    exact decimal arithmetic.  A phrase goes when a longer one with at least
    ``percent`` % of its occurrences holds it; by monotony of counts it
    suffices to ask the phrases one word longer.  Ranks by score, then a, both
    falling, then phrase; ``top`` per language, or all with None.
    """
    spark = docs.sparkSession
    text = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    words = _likely(text, [], WORD_SHARDS, least)
    totals = settled(words.filter("h is null").groupBy("lang").agg(F.sum("total").alias("n")))
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = _shards(n)
    hot = [r["h"] for r in words.filter(F.col("h").isNotNull() & (F.col("total") * HOT_SHARE >= n)).select("h").collect()]
    known = [_bitmap(spark, words, WORD_SHARDS)]
    for _ in range(2):
        known.append(_bitmap(spark, _likely(text, known, shards, least), shards))
    hot = spark.sparkContext.broadcast(np.array(hot, np.int64))  # at most HOT_SHARE numbers
    entries = settled(merged_stripes(text, known, hot, shards, least))

    # prefix totals, extensions and the largest extension to either side, all from the merged entries
    found = entries.select("lang", "prefix", F.when(F.col("prefix") == "", F.col("word")).otherwise(
        F.concat_ws(" ", "prefix", "word")).alias("phrase"), F.col("cnt").alias("a"))
    several = found.filter("prefix != ''")
    right = several.select("lang", F.col("prefix").alias("part"), "a")
    left = several.select("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("part"), "a")
    longest = right.union(left).groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = several.drop("prefix").join(longest, ["lang", "phrase"], "left") \
                  .filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(F.split("phrase", " ")) - 1))) \
               .withColumn("first", F.expr("substring_index(phrase, ' ', k)")) \
               .withColumn("rest", F.expr("substring(phrase, char_length(first) + 2)"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"]) \
               .join(found.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    scored = cuts.join(totals, "lang").withColumn(
        "score", F.expr("cast(a * 1000 as decimal(19, 0)) * cast(n as decimal(18, 0)) "
                        "div (cast(l as decimal(19, 0)) * cast(r as decimal(18, 0)))"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut")) \
                  .select("lang", "phrase", "cut.*")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = worst.withColumn("rank", rank.cast("long"))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, s AS words FROM (
  SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece_text FROM documents) d,
  LATERAL (SELECT regexp_extract_all(d.piece_text, '[^\x20\x09]+') AS s)),
q AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM p),
g AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, count(*) AS f
      FROM q, range(1, 6) t(m) WHERE i + m - 1 <= len(words) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE f >= 100),
kept AS (SELECT * FROM c WHERE m >= 2 AND NOT EXISTS (SELECT 1 FROM c x WHERE x.lang = c.lang AND x.m > c.m
           AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * x.f >= 100 * c.f)),
cut AS (SELECT k.lang, k.phrase, k.f AS a, u.k, array_to_string(string_split(k.phrase, ' ')[1:u.k], ' ') AS first,
               array_to_string(string_split(k.phrase, ' ')[u.k + 1:], ' ') AS rest
        FROM kept k, range(1, 5) u(k) WHERE u.k < k.m),
s AS (SELECT cut.lang, cut.phrase, cut.a, cut.k, l.f AS l, r.f AS r, n.n,
             ((1000::HUGEINT * cut.a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM cut JOIN c l ON l.lang = cut.lang AND l.phrase = cut.first JOIN c r ON r.lang = cut.lang AND r.phrase = cut.rest
      JOIN n ON n.lang = cut.lang),
w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM w QUALIFY rank <= 2000"""
