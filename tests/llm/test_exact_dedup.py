import hashlib
import random

from quarry.llm.exact_dedup import CuckooIndex, digests, exact_groups, live_index, update_index

SCHEMA = "doc_id long, text string, digest string, n int, shared string"


def key(x):
    return hashlib.sha256(str(x).encode()).digest()


def test_index_against_a_dict():
    rnd = random.Random(3)
    index, plain = CuckooIndex(buckets=2), {}
    for step in range(20000):
        x = rnd.randrange(3000)
        if rnd.random() < 0.3:
            assert index.delete(key(x)) == (plain.pop(key(x), None) is not None)
        else:
            keep, n = rnd.randrange(100), rnd.randrange(1, 4)
            index.add(key(x), keep, n)
            old = plain.get(key(x), (-1, 0))
            plain[key(x)] = (max(old[0], keep), old[1] + n)
        if step % 1999 == 0:
            assert len(index) == len(plain)
    assert index.resizes >= 8
    got = {d: (k, n) for b in index.batches(100) for d, k, n in zip(*(c.to_pylist() for c in b.columns))}
    assert got == plain
    assert all(index.find(key(x)) == -1 for x in range(3000) if key(x) not in plain)


def test_equal_prints_are_verified():
    """Digests that share bucket and print (first eight bytes) are told apart by the stored digest, and none is lost."""
    index = CuckooIndex(buckets=1)
    same = [b"\x01" * 8 + bytes([i]) * 24 for i in range(8)]
    for i, d in enumerate(same):
        index.add(d, i, 1)
    assert [index.keep[index.find(d)] for d in same] == list(range(8))
    assert index.find(b"\x01" * 8 + b"\x63" * 24) == -1
    assert index.delete(same[3]) and index.find(same[3]) == -1 and index.find(same[4]) >= 0


def plain(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for d, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, len(groups[t or ""]), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_equal_brute_force(spark):
    rnd = random.Random(4)
    rows = [(d, rnd.choice(["hot", "a b", "a  b", "ü", "x" * 200_000, "", None, f"own {d}"])) for d in range(400)]
    rows += [(5, "own twice"), (5, "own twice"), (None, "hot"), (None, "only here"), (None, "only here"), (None, None)]
    df = spark.createDataFrame([r + ("c", 1, "s") for r in rows], SCHEMA).repartition(7)
    out = exact_groups(df)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows)


def test_update_withdraws_then_inserts(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = live_index(digests(make([(1, "a"), (2, "a"), (3, "b"), (4, "c")])))
    after = update_index(index, make([(9, "b"), (7, "d"), (0, "a")]), make([(2, "a"), (8, "never seen"), (4, "c")]))
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    assert {bytes(r.digest): (r.keep_id, r.n) for r in after.collect()} == {sha("a"): (0, 1), sha("b"): (9, 2), sha("d"): (7, 1)}


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0
