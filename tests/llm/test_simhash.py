import random
import re

import numpy as np
import xxhash

from quarry.llm.components import components
from quarry.llm.simhash import drop_near_copies, fingerprint, fingerprint_links, simhash_groups

SCHEMA = "doc_id long, text string, lang string, fp long"


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def union_find(items, links):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in items}


def plain_groups(rows):
    prints = {r[0]: plain_print(r[1]) for r in rows}
    ids = list(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = union_find(ids, links)
    return {(i, f"{prints[i]:016x}", roots[i]) for i in ids}


def texts(n, seed=1):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "délta", "eps", "zeta", "ÄTA", "theta"]
    out = []
    for i in range(n):
        if out and rnd.random() < 0.4:
            t = rnd.choice(out).split(" ")
            if rnd.random() < 0.6 and t:
                t[rnd.randrange(len(t))] = rnd.choice(words)
            out.append(" ".join(t))
        else:
            out.append(" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 3, 5, 80, 300]))))
    return out


def test_matches_brute_force_with_odd_rows(spark):
    rows = [(i, t, "en", 0) for i, t in enumerate(texts(150))]
    rows += [(1000, None, None, 1), (1001, "", "en", 2), (1002, " \t\n", "en", 3), (1003, "word " * 40000, "en", 4)]
    got = {tuple(r) for r in simhash_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_groups(rows)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d", "x", 1)] * 3, SCHEMA)
    assert len(simhash_groups(df).collect()) == 3
    assert simhash_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drop_keeps_one_of_each_group_and_other_columns(spark):
    rows = [(5, "one two three four", "x", 9), (3, "one two three four", "y", 8), (9, "quite another text here", None, 7)]
    out = drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "fp"]
    assert sorted(r.doc_id for r in out.collect()) == [3, 9]


def test_crowded_cells_lose_no_connection(spark):
    rnd = random.Random(3)
    fps = set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(25):
            fps.add(base ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randrange(3))) & (2 ** 64 - 1))
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    want = union_find(signed, [(a, b) for i, a in enumerate(signed) for b in signed[:i]
                               if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2])
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for crowded in (3, 64):
        edges = fingerprint_links(df, 2, crowded)
        assert all(((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 2 for r in edges.collect())
        got = {r.node: r.component for r in components(edges, "a", "b").collect()}
        assert all(got.get(f, f) == want[f] for f in signed)


def test_exploded_cells_and_variants_are_not_broadcast(spark, monkeypatch):
    """Spark sizes them like the fingerprints alone, which may be small enough."""
    from quarry.llm import simhash

    rnd = random.Random(5)
    fps = [rnd.getrandbits(63) for _ in range(300)] + [1 << i for i in range(30)]
    ran, real = [], simhash.settled
    monkeypatch.setattr(simhash, "settled", lambda df: real(ran.append(df) or df))
    edges = fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long").distinct(), 2, 3)
    assert edges.count() >= 29
    below = []
    for df in [*ran, edges]:
        lines, inside = df._jdf.queryExecution().executedPlan().toString().split("\n"), None
        for line in lines:
            depth = len(line) - len(line.lstrip(" :+-"))
            inside = None if inside is not None and depth <= inside else inside
            inside = depth if inside is None and "BroadcastExchange" in line else inside
            below += [line] * (inside is not None and "Generate" in line)
    assert len(ran) == 2 and not below


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(7, 7), (500, 400)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(80)) and got[500] == 400
    assert components(df.limit(0), "a", "b").count() == 0


def test_one_fingerprint_by_hand():
    assert fingerprint("A b  C") == xxhash.xxh64_intdigest(b"a b c", 42)
    assert fingerprint(None) == fingerprint(" ") == 0
