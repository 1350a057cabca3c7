import hashlib
import random
import zlib

from quarry.llm import turn_trie
from quarry.llm.turn_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, n long, shard long"


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r, t.decode()) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), len(leaves),
                    saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some(rnd, ids):
    rows = []
    for c in ids:
        for t in range(rnd.randrange(0, 9)):
            rows.append((c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "bot", None]), rnd.choice(["hi", "hé𝄞", "", None, "ok"])))
    return rows


def result(spark, rows):
    df = spark.createDataFrame([r + ("p", 1, 2) for r in rows], SCHEMA).repartition(5)
    out = conversation_trie(df).drop("path")
    return sorted(map(tuple, out.collect()), key=str)


def test_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    rows = some(rnd, [*range(0, 130), 200, 207, 355, 1200, -3, -150, 10**15, 10**15 + 1])
    rows += rows[:40] + [(None, 1, "user", "lost")]  # repeated turns, and one that belongs nowhere
    assert result(spark, rows) == plain(rows)


def test_small_shards_and_streams_agree(spark, monkeypatch):
    """Shards of few turns, and conversations longer than a shard, give the same trie."""
    rnd = random.Random(9)
    rows = some(rnd, range(0, 60)) + [(c, t, "user", "hi") for c in (61, 62, 63) for t in range(50)]
    rows += [(64, t, "user", "hi" if t < 30 else "x") for t in range(40)]
    want = plain(rows)
    assert result(spark, rows) == want
    for name, value in (("SHARD_TURNS", 12), ("SHARD_CONVS", 3)):
        monkeypatch.setattr(turn_trie, name, value)
    turns = {}
    rebuilt = turn_trie.shared_openings(turn_trie.numbered_turns(
        spark.createDataFrame([r + ("p", 1, 2) for r in rows], SCHEMA))).orderBy("conv_id", "pos").collect()
    for r in rebuilt:
        turns.setdefault(r.conv_id, []).append(r)
    # the shard walk in this process, where the small bounds hold
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rebuilt]) for i in range(4)], ["conv_id", "pos", "turn_key", "chars"])
    nodes = [n for b in turn_trie._nodes([batch.slice(i, 7) for i in range(0, len(rebuilt), 7)]) for n in b.to_pylist()]
    merged = {}
    for n in nodes:
        m = merged.setdefault(n["path"], [n["first"], n["depth"], 0, ""])
        m[0], m[2] = min(m[0], n["first"]), m[2] + n["n"]
        m[3] += ("," if m[3] and n["ends"] else "") + n["ends"]
    assert sorted((a, d, n, hashlib.sha256(e.encode()).hexdigest()) for a, d, n, e in merged.values()) == \
        sorted((w[0], w[1], w[3], w[7]) for w in want)
    assert len(nodes) > len(merged)


def test_turnless_and_empty(spark):
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(500)}
    short = next(c for c in range(101, 200) if h[c] >= 2)  # loses its only turn, and there is no conversation 100
    rows = [(short, 0, "user", "gone")]
    assert result(spark, rows) == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]
    assert result(spark, []) == []
