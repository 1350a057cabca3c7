import random
import re
from collections import Counter

import pytest

from quarry.llm import phrases
from quarry.llm.phrases import mine

SCHEMA = "lang string, text string, prefix string, word string, a long"


def plain(rows, least, percent=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    inside = {}
    for (lang, q), c in f.items():
        if c >= least:
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    inside[lang, q[i:i + m]] = max(c, inside.get((lang, q[i:i + m]), 0))
    out = []
    for (lang, p), a in f.items():
        if a < least or len(p) < 2 or 100 * inside.get((lang, p), 0) >= percent * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    ranked, at = [], Counter()
    for lang, score, a, p, left, right in sorted(out):
        at[lang] += 1
        if at[lang] <= top:
            ranked.append((lang, at[lang], p.decode(), -a, left, right, n[lang], -score))
    return ranked


def texts(rnd, count):
    words = ["New", "York", "stock", "ex-change", "of", "the", "é", "\x00", "a b", " ", "ÀB", "x"]
    for _ in range(count):
        t = ""
        for _ in range(rnd.randrange(0, 60)):
            t += rnd.choice(["New York stock ex-change", "of the", *words]) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"])
        yield (rnd.choice(["en", "fr", "", None]), t)


@pytest.mark.parametrize("least, percent, top", [(8, 100, 2000), (5, 60, 2000), (5, 100, 7)])
def test_equals_brute_force(spark, least, percent, top):
    rows = list(texts(random.Random(least), 150)) + [("en", None), ("en", ""), (None, " .,; "), ("de", "one two")]
    df = spark.createDataFrame([r + ("p", "w", 1) for r in rows], SCHEMA).repartition(6)
    out = mine(df, least, percent, top)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == plain(rows, least, percent, top)


def test_full_filters_and_small_chunks_change_nothing(monkeypatch):
    """The maps in this process: bitmaps that let all pass, chunks of a few bytes, half of the words hot."""
    import numpy as np
    import pyarrow as pa

    rows = list(texts(random.Random(2), 60))
    monkeypatch.setattr(phrases, "CHUNK", 50)
    full = type("B", (), {"value": np.full(phrases.FILTER_BITS // 8, 255, np.uint8)})
    batch = pa.RecordBatch.from_arrays([pa.array(["und" if r[0] is None else r[0] for r in rows]),
                                        pa.array([r[1].encode() for r in rows], pa.binary())], ["lang", "text"])
    every = np.concatenate([phrases._Chunk(lang, parts).hashes for lang, parts in phrases._parts([batch])])
    hot = type("B", (), {"value": np.unique(every >> np.uint64(33 - phrases.WORD_SHARDS.bit_length()))[::2].astype(np.int64)})
    stripes = [r for b in phrases._striper([full] * 3, hot, 16)([batch]) for r in b.to_pylist()]
    assert len({r["part"] for r in stripes}) == 16
    stripes = pa.RecordBatch.from_pylist(sorted(stripes, key=lambda r: (r["part"], r["lang"])))
    entry = Counter()
    for b in phrases._merger(1)([stripes.slice(i, 5) for i in range(0, len(stripes), 5)]):
        for r in b.to_pylist():
            entry[r["lang"], (r["prefix"] + " " + r["word"]) if r["prefix"] else r["word"]] += r["cnt"]
    want = Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update(("und" if lang is None else lang, " ".join(w[i:i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    assert entry == want


def test_packed_sums(monkeypatch):
    """Sums of packed hash counts equal plain sums, above the least total and none below."""
    import pyarrow as pa

    rows = list(texts(random.Random(6), 80))
    monkeypatch.setattr(phrases, "CHUNK", 200)
    batch = pa.RecordBatch.from_arrays([pa.array(["und" if r[0] is None else r[0] for r in rows]),
                                        pa.array([r[1].encode() for r in rows], pa.binary())], ["lang", "text"])
    plain_totals, n = Counter(), Counter()
    for lang, parts in phrases._parts([batch]):
        chunk = phrases._Chunk(lang, parts)
        words = chunk.codes[chunk.codes > 0]
        n[lang] += len(words)
        plain_totals.update((chunk.hashes[words] >> phrases.np.uint64(24)).tolist())
    packed = [r for b in phrases._sketcher([], 256)([batch]) for r in b.to_pylist()]
    packed = pa.RecordBatch.from_pylist(sorted(packed, key=lambda r: r["shard"]))
    got, words = {}, Counter()
    for b in phrases._summed(5)([packed]):
        for r in b.to_pylist():
            if r["h"] is None:
                words[r["lang"]] += r["total"]
            else:
                got[r["h"]] = r["total"]
    assert words == n
    assert got == {h: c for h, c in plain_totals.items() if c >= 5} and got


def test_long_products_and_empty_table(spark):
    """1000 a n and l r beyond 64 bits: the decimal expression itself."""
    row = spark.sql("select cast(4000000000000 * 1000 as decimal(19, 0)) * cast(90000000000000 as decimal(18, 0)) "
                    "div (cast(7000000000000 as decimal(19, 0)) * cast(6000000000001 as decimal(18, 0))) as s").first()
    assert row.s == 1000 * 4000000000000 * 90000000000000 // (7000000000000 * 6000000000001)
    assert mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mine(spark.createDataFrame([(None, None, "", "", 1)], SCHEMA)).count() == 0
