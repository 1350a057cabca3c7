"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt into shards of consecutive conv_ids.  A shard indexes
(position, turn) to a bitset of its conversations and one bitset per length,
and walks the trie depth first: a node is the bitset of the conversations that
share its turns; the posting of any member's next turn, intersected with the
node, is a child; what is left of the node gives the next child.  A node's
population count, its smallest member and the ids that end there (its bitset
and that of its depth) leave the shard as one row, so a first turn held by a
third of all conversations is one row per shard.  Nodes of all shards meet by
path digest (SHA-256 of the parent's path and the turn).

Sums over subtrees need no pass per level: every node has one owner, the shard
of its smallest member, and every shard that holds an owned node also holds its
ancestors.  A second walk per shard, deepest nodes first, adds what the shard
owns to the ancestors, and the shards' parts add up.

Bounds: a shard holds at most ``SHARD_TURNS`` turns and ``SHARD_CONVS``
conversations in memory; a conversation longer than that is its own shard and
is read as a stream, one turn at a time.  The SHA-256 of a node's end list is a
sequential digest by definition; the shards' pieces of the list (already in
order) are read as a stream, so no list is held.

Cases: null turns come first, equal turns of a conversation are ordered by role
and text; null role or text is empty; repeated rows are turns of their own;
rows without conv_id take no part; further columns take no part; an empty table
gives an empty result (no root).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import settled

SHARD_TURNS, SHARD_CONVS = 100_000, 4_096
_ROOT = hashlib.sha256(b"").digest()
_NODE = "path binary, parent binary, depth long, shard long, first long, n long, chars long, ends string"
_COLUMNS = [("path", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("shard", pa.int64()),
            ("first", pa.int64()), ("n", pa.int64()), ("chars", pa.int64()), ("ends", pa.string())]


# ---------------------------------------------------------------------------
# Rebuilt conversations
# ---------------------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn_key, chars): turns in order, compared by the SHA-256 of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    key = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"),
                       F.unhex(key).alias("turn_key"), F.char_length("text").cast("long").alias("chars"))


def shared_openings(turns: DataFrame, longest: int = 5) -> DataFrame:
    """Turns after conversation c's first h are replaced in front by the first h of c - c % 100.

    h = crc32(decimal c) % 6.  Every conversation keeps at least a row; one
    without turns has a single row with null pos.
    """
    opening = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("pos") <= longest)) \
                   .select(F.col("conv_id").alias("base"), F.col("pos").alias("at"),
                           F.col("turn_key").alias("base_key"), F.col("chars").alias("base_chars"))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    known = sizes.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base_id"))
    lent = known.join(opening, (F.col("base_id") == F.col("base")) & (F.col("at") <= F.col("h")), "left") \
                .select("conv_id", F.col("at").alias("pos"), F.col("base_key").alias("turn_key"), F.col("base_chars").alias("chars"))
    # a conversation's own turns move by as many as it borrowed less those it lost
    base_size = turns.filter(F.col("conv_id") % 100 == 0).filter(F.col("pos") <= longest) \
                     .groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("base_size"))
    shift = known.join(base_size, F.col("base_id") == F.col("base"), "left").select(
        F.col("conv_id").alias("id"), "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("got"))
    own = turns.join(shift, F.col("conv_id") == F.col("id")).filter("pos > h") \
               .select("conv_id", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "turn_key", "chars")
    return lent.union(own)


# ---------------------------------------------------------------------------
# Shards
# ---------------------------------------------------------------------------

def _step(path: bytes, key: bytes) -> bytes:
    return hashlib.sha256(path + key).digest()


def _bits(x: int):
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def walk(ids: list[int], turns: list[list[tuple[bytes, int]]]):
    """Nodes of one shard, depth first: tuples in the order of ``_COLUMNS``."""
    postings: list[dict[bytes, int]] = []
    length: dict[int, int] = {}
    for i, conv in enumerate(turns):
        length[len(conv)] = length.get(len(conv), 0) | 1 << i
        for pos, (key, _) in enumerate(conv):
            if pos == len(postings):
                postings.append({})
            postings[pos][key] = postings[pos].get(key, 0) | 1 << i
    stack = [(_ROOT, None, 0, (1 << len(ids)) - 1, 0)]
    while stack:
        path, parent, depth, node, chars = stack.pop()
        ends = node & length.get(depth, 0)
        low = (node & -node).bit_length() - 1
        yield path, parent, depth, ids[0], ids[low], node.bit_count(), chars, ",".join(str(ids[i]) for i in _bits(ends))
        rest = node & ~ends
        while rest:
            key, size = turns[(rest & -rest).bit_length() - 1][depth]
            child = node & postings[depth][key]
            stack.append((_step(path, key), path, depth + 1, child, size))
            rest &= ~child


def _nodes(batches):
    """Sorted (conv_id, pos, turn_key, chars) rows to the nodes of their shards."""
    out: list[tuple] = []
    ids: list[int] = []
    turns: list[list] = []
    held = 0
    path, long_id, depth, chars = _ROOT, None, 0, 0  # of a conversation that is read as a stream

    def flushed(least):
        nonlocal out
        if len(out) > least:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), _COLUMNS)],
                                             [n for n, _ in _COLUMNS])
            out = []

    def closed():
        nonlocal ids, turns, held
        for node in walk(ids, turns) if ids else ():
            out.append(node)
            yield from flushed(1 << 14)
        ids, turns, held = [], [], 0

    def streamed(key, size):
        nonlocal path, depth, chars
        step = _step(path, key)
        depth, chars = depth + 1, size
        out.append((step, path, depth, long_id, long_id, 1, chars, ""))
        path = step

    def ended():
        nonlocal long_id
        if long_id is not None:
            out[-1] = (*out[-1][:-1], str(long_id))
        long_id = None

    for batch in batches:
        for conv, pos, key, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if conv == long_id:
                yield from flushed(1 << 14)
                streamed(key, size)
                continue
            ended()
            if not ids or ids[-1] != conv:
                if held >= SHARD_TURNS or len(ids) >= SHARD_CONVS:
                    yield from closed()
                ids.append(conv)
                turns.append([])
            if pos is not None:
                turns[-1].append((key, size))
                held += 1
                if len(turns[-1]) > SHARD_TURNS:  # this one alone fills a shard
                    rest = turns.pop()
                    ids.pop()
                    yield from closed()
                    path, long_id, depth = _ROOT, conv, 0
                    out.append((_ROOT, None, 0, conv, conv, 1, 0, ""))
                    for one in rest:
                        yield from flushed(1 << 14)
                        streamed(*one)
    ended()
    yield from closed()
    yield from flushed(0)


def _summed(batches):
    """Rows (shard, depth, path, parent, leaves, chars) by shard, deepest first, to each path's part of its subtree."""
    shard, above, out = None, {}, []
    for batch in batches:
        for s, _, path, parent, leaves, chars in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if s != shard:
                shard, above = s, {}
            got = above.pop(path, (0, 0))
            leaves, chars = leaves + got[0], chars + got[1]
            if parent is not None:
                has = above.get(parent, (0, 0))
                above[parent] = (has[0] + leaves, has[1] + chars)
            out.append((path, leaves, chars))
        if out:
            p, n, c = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.binary()), pa.array(n, pa.int64()), pa.array(c, pa.int64())],
                                             ["at", "leaves", "saved"])
            out = []


def _digested(batches):
    """Rows (path, shard, ends), all of a path together and in order, to (path, SHA-256 of the whole list)."""
    path, state, out = None, None, []
    for batch in batches:
        for p, _, ends in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if p != path:
                if state:
                    out.append((path, state.hexdigest()))
                path, state = p, hashlib.sha256(ends.encode())
            else:
                state.update(b"," + ends.encode())
        if out:
            yield _pairs(out)
            out = []
    if state:
        yield _pairs([(path, state.hexdigest())])


def _pairs(rows):
    p, h = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(p, pa.binary()), pa.array(h, pa.string())], ["ended", "ends_sha256"])


def build_trie(rebuilt: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, pos, turn_key, chars) rows (null pos: no turn)."""
    spark = rebuilt.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rebuilt.select("conv_id", "pos", "turn_key", "chars") \
                   .repartitionByRange(width, "conv_id").sortWithinPartitions("conv_id", "pos")
    parts = settled(dealt.mapInArrow(_nodes, _NODE))
    merged = parts.groupBy("path").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("first").alias("conv_id"),
        F.min(F.struct("first", "shard"))["shard"].alias("owner"), F.sum("n").alias("n_convs"), F.max("chars").alias("chars"))
    children = parts.filter("parent is not null").select("parent", "path").distinct() \
                    .groupBy(F.col("parent").alias("above")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = settled(merged.join(children, F.col("path") == F.col("above"), "left").drop("above")
                          .withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    # what a shard owns: leaves, and the turns saved by sharing
    worth = nodes.select(F.col("path").alias("at"), "owner", (F.col("n_children") == 0).cast("long").alias("leaf"),
                         ((F.col("n_convs") - 1) * F.col("chars")).alias("worth"))
    own = F.col("owner") == F.col("shard")
    owned = parts.join(worth, F.col("path") == F.col("at")).select(
        "shard", "depth", "path", "parent", F.when(own, F.col("leaf")).otherwise(0).alias("leaf"),
        F.when(own, F.col("worth")).otherwise(0).alias("worth"))
    sums = owned.repartition(width, "shard").sortWithinPartitions("shard", F.desc("depth")) \
                .mapInArrow(_summed, "at binary, leaves long, saved long") \
                .groupBy("at").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = parts.filter("ends != ''").select("path", "shard", "ends").repartition(width, "path") \
                .sortWithinPartitions("path", "shard").mapInArrow(_digested, "ended binary, ends_sha256 string")
    parents = nodes.select(F.col("path").alias("of"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(sums, F.col("path") == F.col("at"))
                 .join(ends, F.col("path") == F.col("ended"), "left")
                 .join(parents, F.col("parent") == F.col("of"), "left")
                 .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
                         F.lower(F.hex("path")).alias("path")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations."""
    turns = settled(numbered_turns(conversations))
    return build_trie(shared_openings(turns))


ORACLE_SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
crc_table AS (SELECT list(v ORDER BY b) AS tab FROM (
  WITH RECURSIVE s AS (SELECT b, b::UBIGINT AS v, 0 AS i FROM range(256) r(b)
    UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, i + 1 FROM s WHERE i < 8)
  SELECT b, v FROM s WHERE i = 8)),
ids AS (SELECT DISTINCT conv_id FROM t),
crc AS (
  WITH RECURSIVE c AS (SELECT conv_id, conv_id::VARCHAR AS s, 1 AS i, 4294967295::UBIGINT AS v FROM ids
    UNION ALL SELECT conv_id, s, i + 1, xor(v >> 8, tab[((xor(v, ascii(s[i])::UBIGINT) & 255) + 1)::BIGINT]) FROM c, crc_table WHERE i <= length(s))
  SELECT conv_id, xor(v, 4294967295::UBIGINT) % 6 AS h FROM c WHERE i = length(s) + 1),
lent AS (SELECT c.conv_id, b.pos, b.role, b.text FROM crc c JOIN t b ON b.conv_id = c.conv_id - c.conv_id % 100 AND b.pos <= c.h),
own AS (SELECT t.conv_id, t.pos - c.h + (SELECT count(*) FROM lent l WHERE l.conv_id = t.conv_id) AS pos, t.role, t.text
        FROM t JOIN crc c ON c.conv_id = t.conv_id WHERE t.pos > c.h),
r AS (SELECT conv_id, pos, sha256(length(role)::VARCHAR || ':' || role || text) AS k, length(text) AS chars
      FROM (SELECT * FROM lent UNION ALL SELECT * FROM own)),
spot AS (SELECT conv_id, pos::BIGINT AS depth, chars, string_agg(k, ',') OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM r
       UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
last AS (SELECT conv_id, max(depth) AS depth FROM spot GROUP BY conv_id),
node AS (SELECT path, a.depth AS depth, min(a.conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
                sha256(coalesce(string_agg(a.conv_id::VARCHAR, ',' ORDER BY a.conv_id) FILTER (l.depth = a.depth), '')) AS ends_sha256
         FROM spot a JOIN last l USING (conv_id) GROUP BY path, a.depth),
line AS (SELECT n.path, a.path AS above, a.depth AS above_depth, n.depth, n.n_convs, n.chars
         FROM node n JOIN spot a ON a.conv_id = n.conv_id AND a.depth <= n.depth),
child AS (SELECT above, count(*) AS n_children, min(path) AS any_path FROM line WHERE above_depth = depth - 1 GROUP BY above),
sums AS (SELECT l.above, count(*) FILTER (c.above IS NULL) AS n_leaves, sum((l.n_convs - 1) * l.chars) AS saved_tokens
         FROM line l LEFT JOIN child c ON c.above = l.path GROUP BY l.above)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN sums s ON s.above = n.path LEFT JOIN child c ON c.above = n.path
LEFT JOIN line u ON u.path = n.path AND u.above_depth = n.depth - 1 LEFT JOIN node p ON p.path = u.above"""
