"""Line dedup by a deletion-neighbourhood join: of lines within one edit, the earliest stays.

A line class is one distinct line; its place is its first (doc_id, line
number).  A class goes when an earlier class is within one edit (insertion,
deletion or substitution of one character); of the class that stays, the first
occurrence stays.

Every variant within the edit bound is emitted as a hashed key.  Two kinds
keep the join exact and linear: "the line without character i, i, length"
(lines that meet differ in that character alone, so all of them are within one
edit of each other and the earliest settles the rest), and "the line without
one character" against whole lines (a star around the whole line).  Pairs that
meet are verified with the real edit distance.  Two filters keep the join small
and lose no pair.  Lines within one edit agree on the half without the edit, so
lines that share neither half with a different line emit nothing.  And they
agree on all but the segment of the edit (a line is laid into segments of about
``SEGMENT`` characters, once at its length and once as a line one character
longer), so a line emits variants only inside segments outside of which it
equals another line.  A group of near copies that differ in words costs its
lines times the segments, not times the length.

A line in a third of all rows is one class: classes come from partial
aggregation of fixed-width hashes, and variants are emitted once per class.

Cases: null text stays null and an empty text stays empty; blank lines are
layout and always stay; lines under ``min_chars`` characters are only compared
as equal; repeated rows of a doc_id share their lines and both stay; rows
without doc_id stay as they are and take no part; a document that loses all
its lines that are not blank goes; further columns pass through untouched; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh_name, settled

SMALL_CLASSES = 2_000_000  # candidate classes (16 bytes each) up to which they are broadcast
SEGMENT = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _lines(docs: DataFrame) -> DataFrame:
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    out = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return out.filter(F.trim(F.col("line"), F.lit(" \t\r\x0b\x0c")) != "") \
              .withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit(7), "line")})


def _half_keys(line: Column, n: Column) -> Column:
    """Keys that any line within one edit of ``line`` shares at least one of."""
    out = []
    for base in (n, n - 1):
        m = F.floor(base / 2).cast("int")
        out += [F.xxhash64(F.lit("P"), base, F.substring(line, F.lit(1), m)),
                F.xxhash64(F.lit("S"), base, F.substring(line, n - (base - m) + 1, base - m))]
    return F.array(*out)


def _hashed(line: str):
    """(codes, power, part): ``part[i]`` is the polynomial hash of the first i characters, ``power[i]`` = base^(i+1)."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    power = np.multiply.accumulate(np.full(len(codes) + 1, _BASE, np.uint64))
    return codes, power, np.concatenate([[np.uint64(0)], np.cumsum(codes * power[:-1], dtype=np.uint64)])


def _bounds(n: int) -> np.ndarray:
    """Edges of the segments of a line of n characters."""
    count = max(1, -(-n // SEGMENT))
    return np.arange(count + 1) * n // count


def _segment_keys(batches):
    """(key, h, longer, segment): hash of all of a line but one segment, as a line of its length and as one a character longer."""
    held, size = [], 0
    for pdf in batches:
        for line, h in zip(pdf["line"], pdf["h"]):
            with np.errstate(over="ignore"):
                _, power, part = _hashed(line)
                inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(power), _INVERSE, np.uint64)])
                n = len(part) - 1
                for longer in (0, 1):
                    edge = _bounds(n - longer)
                    k = len(edge) - 1
                    stop = edge[1:] + longer  # a line one character longer has it inside the segment
                    rest = (part[n] - part[stop]) * inverse[stop]
                    key = _mix(_mix(part[edge[:-1]]) + rest) + np.arange(k, dtype=np.uint64) * _BASE + np.uint64(n - longer)
                    held.append((_mix(key).view(np.int64), np.full(k, h, np.int64), np.full(k, longer, np.int32), np.arange(k, dtype=np.int32)))
                    size += k
            if size > 1 << 18:
                yield _frame(held, ("key", "h", "longer", "segment"))
                held, size = [], 0
    if held:
        yield _frame(held, ("key", "h", "longer", "segment"))


def _variants(batches):
    """(key, kind, h) for the variants inside a line's shared segments: kind 0 same place, 1 shortened line, 2 whole line."""
    held, size = [], 0
    for pdf in batches:
        for line, h, own, longer in zip(pdf["line"], pdf["h"], pdf["own"], pdf["longer"]):
            with np.errstate(over="ignore"):
                _, _, part = _hashed(line)
                n = len(part) - 1
                cut = part[:-1] + (part[-1] - part[1:]) * _INVERSE
                out = []
                if len(own):
                    edge = _bounds(n)
                    at = np.concatenate([np.arange(edge[s], edge[s + 1]) for s in own])
                    out.append((0, _mix(_mix(cut[at]) + at.astype(np.uint64) * _BASE + np.uint64(n))))
                    out.append((2, _mix(part[-1:] ^ np.uint64(n << 1 | 1))))
                if len(longer):
                    edge = _bounds(n - 1)
                    at = np.unique(np.concatenate([np.arange(edge[s], edge[s + 1] + 1) for s in longer]))
                    out.append((1, _mix(np.unique(cut[at]) ^ np.uint64(n - 1 << 1 | 1))))
            for kind, key in out:
                held.append((key.view(np.int64), np.full(len(key), kind, np.int32), np.full(len(key), h, np.int64)))
                size += len(key)
            if size > 1 << 18:
                yield _frame(held, ("key", "kind", "h"))
                held, size = [], 0
    if held:
        yield _frame(held, ("key", "kind", "h"))


def _frame(held: list, names: tuple) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*held)))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) ^ (x >> np.uint64(32))


def near_classes(lines: DataFrame, min_chars: int = 20) -> DataFrame:
    """(h, g) of every class that has an earlier class within one edit."""
    n = F.char_length("line")
    long = lines.filter(n >= min_chars)
    keyed = long.select("h", F.explode(_half_keys(F.col("line"), n)).alias("key"))
    shared = settled(keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a != b").select("key"))
    wanted = settled(keyed.join(shared, "key", "left_semi").select("h").distinct())
    few = F.broadcast(wanted) if wanted.count() <= SMALL_CLASSES else wanted
    classes = settled(long.join(few, "h").groupBy("h", "g", "line")
                          .agg(F.min(F.struct("doc_id", "line_no")).alias("place")))
    slots = classes.sparkSession.sparkContext.defaultParallelism  # few lines make many rows: keep all cores
    dealt = classes.select("line", "h").repartition(2 * slots, "h")
    segments = settled(dealt.mapInPandas(_segment_keys, "key long, h long, longer int, segment int"))
    twice = segments.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a != b").select("key")
    windows = segments.join(twice, "key").groupBy("h").agg(
        F.array_sort(F.collect_set(F.when(F.col("longer") == 0, F.col("segment")))).alias("own"),
        F.array_sort(F.collect_set(F.when(F.col("longer") == 1, F.col("segment")))).alias("longer"))
    framed = classes.select("line", "h").join(windows, "h").select("line", "h", "own", "longer").repartition(2 * slots, "h")
    variants = settled(framed.mapInPandas(_variants, "key long, kind int, h long"))
    met = settled(variants.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("a"), F.max("h").alias("b"))
                          .filter("a != b"))
    members = settled(variants.join(met.filter("n > 2").select("key"), "key"))
    place = classes.select("h", "place")
    # same place: star around the earliest; shortened against whole: star around the whole line
    level = members.filter("kind = 0").join(place, "h")
    first = level.groupBy("key").agg(F.min(F.struct("place", "h")).alias("first")).select("key", F.col("first.h").alias("a"))
    stars = members.filter("kind = 0").join(first, "key").select("a", F.col("h").alias("b"))
    whole = members.filter("kind = 2").select("key", F.col("h").alias("a"))
    cuts = members.filter("kind = 1").join(whole, "key").select("a", F.col("h").alias("b"))
    pairs = met.filter("n = 2").select("a", "b").union(stars).union(cuts).filter("a != b").distinct()
    left = classes.select(F.col("h").alias("a"), F.col("line").alias("la"), F.col("place").alias("pa"))
    right = classes.select(F.col("h").alias("b"), F.col("g").alias("gb"), F.col("line").alias("lb"), F.col("place").alias("pb"))
    both = pairs.union(pairs.select("b", "a"))
    found = both.join(left, "a").join(right, "b").filter((F.col("pa") < F.col("pb")) & (F.levenshtein("la", "lb", 1) == 1))
    return found.select(F.col("b").alias("h"), F.col("gb").alias("g")).distinct()


def _rebuilt(text: pd.Series, gone: pd.Series) -> pd.Series:
    out = []
    for t, g in zip(text, gone):
        if t is None:
            out.append(None)
            continue
        drop, seen, keep, lost, real = set() if g is None else set(g), set(), [], False, False
        for line in t.split("\n"):
            if line.strip(" \t\r\x0b\x0c"):
                h = xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 42)
                h -= (h >> 63) << 64
                if h in drop or h in seen:
                    lost = True
                    continue
                seen.add(h)
                real = True
            keep.append(line)
        out.append(None if lost and not real else "\n".join(keep))
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """``docs`` with only the earliest of equal and nearly equal lines; same columns, same rows but emptied ones."""
    lines = _lines(docs)
    seen = settled(lines.select("h", "g", "doc_id"))
    repeated = seen.groupBy("h", "g").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")) \
                   .filter("first_doc != last_doc")
    later = seen.join(repeated, ["h", "g"]).filter("doc_id != first_doc").select("doc_id", "h")
    near = seen.join(settled(near_classes(lines, min_chars)), ["h", "g"]).select("doc_id", "h")
    gone = later.union(near).groupBy("doc_id").agg(F.collect_set("h").alias("gone"))
    gone_id, gone_lines, new_text = (fresh_name(docs, x) for x in ("gone_id", "gone_lines", "new_text"))
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("gone").alias(gone_lines))
    kept = docs.join(gone, F.col("doc_id") == F.col(gone_id), "left")
    text = F.pandas_udf(_rebuilt, "string")("text", gone_lines)
    kept = kept.withColumn(new_text, F.when(F.col("doc_id").isNull(), F.col("text")).otherwise(text))
    kept = kept.filter(F.col("text").isNull() | F.col(new_text).isNotNull())
    return kept.withColumn("text", F.col(new_text)).select(*docs.columns)


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
                  unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (SELECT line, min(struct_pack(d := doc_id, n := line_no)) AS place, length(line) AS len
      FROM l WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> '' GROUP BY line),
near AS (SELECT DISTINCT y.line FROM c x JOIN c y ON x.len BETWEEN y.len - 1 AND y.len + 1 AND x.place < y.place
  WHERE x.len >= 20 AND y.len >= 20
    AND (x.line[1:x.len // 2 - 1] = y.line[1:x.len // 2 - 1] OR x.line[x.len // 2 + 2 - x.len:] = y.line[x.len // 2 + 2 - x.len:])
    AND levenshtein(x.line, y.line) <= 3
    AND CASE WHEN x.len = y.len THEN len(list_filter(range(1, x.len + 1), lambda i: x.line[i] <> y.line[i])) <= 1
             WHEN x.len < y.len THEN len(list_filter(range(1, y.len + 1), lambda i: y.line[1:i - 1] || y.line[i + 1:] = x.line)) > 0
             ELSE len(list_filter(range(1, x.len + 1), lambda i: x.line[1:i - 1] || x.line[i + 1:] = y.line)) > 0 END),
k AS (SELECT l.*, (c.line IS NULL OR (c.place = struct_pack(d := l.doc_id, n := l.line_no)
                   AND l.line NOT IN (SELECT line FROM near))) AS keep, c.line IS NOT NULL AS real
      FROM l LEFT JOIN c ON l.line = c.line)
SELECT d.doc_id, d.text FROM documents d WHERE d.text IS NULL
UNION ALL
SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) FILTER (keep) AS text FROM k
GROUP BY doc_id HAVING NOT bool_or(NOT keep) OR bool_or(keep AND real)"""
