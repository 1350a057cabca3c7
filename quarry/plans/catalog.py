"""Registered queries: Spark callables and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)``, reads the shared tables and returns a
DataFrame; ``ORACLE[name]`` is the equivalent SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import pii, quality
from quarry.plans import sqltext as S
from quarry.session import reliable_checkpoint
from quarry.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# F5 / F6 Gopher quality
# ---------------------------------------------------------------------------

@register("gopher_metrics", f"""
WITH g AS ({S.gopher_cte()})
SELECT doc_id, n_words, n_word_chars, n_lines, n_ellipsis_lines, n_alpha_words,
       reason IS NULL AS passed, reason FROM g""")
def q_gopher_metrics(spark, sf):
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return quality.gopher_metrics(docs).drop("text")


@register("gopher_filter", f"""
WITH g AS ({S.gopher_cte()})
SELECT d.doc_id, d.lang FROM documents d JOIN g USING (doc_id) WHERE g.reason IS NULL""")
def q_gopher_filter(spark, sf):
    docs = tables.documents(spark, sf).select("doc_id", "lang", "text")
    return quality.gopher_filter(docs).select("doc_id", "lang")


@register("gopher_reject_reasons", f"""
WITH g AS ({S.gopher_cte()})
SELECT reason, count(*)::BIGINT AS n_docs FROM g GROUP BY reason""")
def q_gopher_reject_reasons(spark, sf):
    return quality.gopher_reject_reasons(tables.documents(spark, sf).select("text"))


# ---------------------------------------------------------------------------
# P7-P10 PII masking
# ---------------------------------------------------------------------------

_MT, _ME, _MP, _MI = S.mask_chain("text")


@register("mask_pii", f"""
SELECT doc_id, {_MT} AS text, {_ME} AS n_email, {_MP} AS n_phone, {_MI} AS n_ip
FROM documents""")
def q_mask_pii(spark, sf):
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return pii.mask_pii(docs).select("doc_id", "text", "n_email", "n_phone", "n_ip")


@register("pii_counts_by_lang", f"""
SELECT lang, count(*)::BIGINT AS n_docs,
       sum(n_email)::BIGINT AS n_email, sum(n_phone)::BIGINT AS n_phone, sum(n_ip)::BIGINT AS n_ip,
       count_if(n_email + n_phone + n_ip > 0)::BIGINT AS n_docs_masked
FROM (SELECT lang, {_ME} AS n_email, {_MP} AS n_phone, {_MI} AS n_ip FROM documents)
GROUP BY lang""")
def q_pii_counts_by_lang(spark, sf):
    docs = tables.documents(spark, sf).select("lang", "text")
    m = pii.mask_pii(docs)
    return m.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_email").alias("n_email"), F.sum("n_phone").alias("n_phone"),
        F.sum("n_ip").alias("n_ip"),
        F.count_if((F.col("n_email") + F.col("n_phone") + F.col("n_ip")) > 0).alias("n_docs_masked"))


# ---------------------------------------------------------------------------
# Flagship: quality filter -> PII mask -> exact-copy drop -> per-language report
# ---------------------------------------------------------------------------

@register("curation_summary", f"""
WITH g AS ({S.gopher_cte()}),
d AS (
  SELECT d.doc_id, d.lang, d.text, g.n_words, g.reason IS NULL AS passed,
         {_ME} AS n_email, {_MP} AS n_phone, {_MI} AS n_ip, md5({_MT}) AS h
  FROM documents d JOIN g USING (doc_id)),
firsts AS (SELECT h, min(doc_id) AS doc_id FROM d WHERE passed GROUP BY h)
SELECT lang, count(*)::BIGINT AS n_docs,
       count_if(passed)::BIGINT AS n_passed,
       count_if(f.doc_id IS NOT NULL)::BIGINT AS n_kept,
       coalesce(sum(n_words) FILTER (WHERE f.doc_id IS NOT NULL), 0)::BIGINT AS n_words_kept,
       coalesce(sum(n_email) FILTER (WHERE f.doc_id IS NOT NULL), 0)::BIGINT AS n_email,
       coalesce(sum(n_phone) FILTER (WHERE f.doc_id IS NOT NULL), 0)::BIGINT AS n_phone,
       coalesce(sum(n_ip) FILTER (WHERE f.doc_id IS NOT NULL), 0)::BIGINT AS n_ip
FROM d LEFT JOIN firsts f USING (doc_id)
GROUP BY lang""")
def q_curation_summary(spark, sf):
    from quarry.plans.curation import curation_summary
    return curation_summary(tables.documents(spark, sf))


# ---------------------------------------------------------------------------
# A1 A2 J1 exact line dedup
# ---------------------------------------------------------------------------

_LINES_SQL = f"""
  l AS (SELECT doc_id, unnest(range(0, len(lines))) AS pos, unnest(lines) AS line
        FROM (SELECT doc_id, {S.file_lines('text')} AS lines FROM documents)),
  c AS (SELECT md5(line) AS h, count(*) AS c FROM l GROUP BY 1),
  k AS (SELECT l.doc_id, l.pos, l.line FROM l JOIN c ON md5(l.line) = c.h WHERE c.c = 1)"""


@register("line_dedup", f"""
WITH {_LINES_SQL},
  agg AS (SELECT doc_id, string_agg(line || chr(10), '' ORDER BY pos) AS text, count(*) AS n_kept
          FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(agg.text, '') AS text,
       len({S.file_lines('d.text')})::BIGINT AS n_lines, coalesce(agg.n_kept, 0)::BIGINT AS n_kept
FROM documents d LEFT JOIN agg USING (doc_id)""")
def q_line_dedup(spark, sf):
    from quarry.operators.dedup import exact_line_dedup
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return exact_line_dedup(docs).select("doc_id", "text", "n_lines", "n_kept")


@register("line_dedup_stats", f"""
WITH {_LINES_SQL},
  per AS (SELECT d.doc_id, len({S.file_lines('d.text')}) AS n_lines,
                 (SELECT count(*) FROM k WHERE k.doc_id = d.doc_id) AS n_kept
          FROM documents d)
SELECT sum(n_lines)::BIGINT AS n_lines, sum(n_kept)::BIGINT AS n_kept,
       count_if(n_kept = 0)::BIGINT AS n_empty_docs FROM per""")
def q_line_dedup_stats(spark, sf):
    from quarry.operators.dedup import exact_line_dedup
    docs = tables.documents(spark, sf).select("doc_id", "text")
    d = exact_line_dedup(docs)
    return d.agg(F.sum("n_lines").cast("bigint").alias("n_lines"),
                 F.sum("n_kept").cast("bigint").alias("n_kept"),
                 F.count_if(F.col("n_kept") == 0).cast("bigint").alias("n_empty_docs"))


@register("line_frequency_top", f"""
SELECT md5(line) AS line_hash, count(*)::BIGINT AS cnt, min(line) AS line
FROM (SELECT unnest({S.file_lines('text')}) AS line FROM documents)
GROUP BY 1 ORDER BY cnt DESC, line_hash LIMIT 20""")
def q_line_frequency_top(spark, sf):
    from quarry.operators.dedup import frequent_lines
    return frequent_lines(tables.documents(spark, sf).select("text"), 20)


# ---------------------------------------------------------------------------
# P14 A3-A6 J2-J5 W9 MinHash-LSH dedup
# ---------------------------------------------------------------------------

@register("minhash_dedup", f"""
SELECT doc_id FROM documents
WHERE doc_id NOT IN ({S.minhash_removed_sql(20, 5, 5, 0.8)})""")
def q_minhash_dedup(spark, sf):
    from quarry.operators.dedup import minhash_dedup
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return minhash_dedup(docs, 20, 5, 5, 0.8).select("doc_id")


@register("minhash_dedup_loose", f"""
SELECT doc_id FROM documents
WHERE doc_id NOT IN ({S.minhash_removed_sql(20, 10, 3, 0.5)})""")
def q_minhash_dedup_loose(spark, sf):
    from quarry.operators.dedup import minhash_dedup
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return minhash_dedup(docs, 20, 10, 3, 0.5).select("doc_id")


@register("minhash_removed_half", f"""
{S.minhash_removed_sql(20, 5, 5, 0.5)}""")
def q_minhash_removed_half(spark, sf):
    from quarry.operators.dedup import minhash_removed
    docs = tables.documents(spark, sf).select("doc_id", "text")
    return minhash_removed(docs, 20, 5, 5, 0.5)


# ---------------------------------------------------------------------------
# Pre-tokens, pair counts, BPE training
# ---------------------------------------------------------------------------

_PRETOKENS_SQL = f"""
  SELECT unnest({S.pretoken_words('p')}) AS word
  FROM (SELECT unnest(string_split_regex(text, {S.lit(S.SPECIALS_SPLIT)})) AS p FROM documents)"""


@register("pretoken_counts", f"""
SELECT word, count(*)::BIGINT AS cnt FROM ({_PRETOKENS_SQL}) GROUP BY word""")
def q_pretoken_counts(spark, sf):
    from quarry.operators.tokenizer import pretoken_counts
    return pretoken_counts(tables.documents(spark, sf).select("text"))


@register("pair_counts", f"""
WITH w AS (SELECT word, count(*) AS cnt FROM ({_PRETOKENS_SQL}) GROUP BY word),
s AS (SELECT cnt, {S.utf8_bytes('word')} AS seq FROM w)
SELECT l, r, sum(cnt)::BIGINT AS cnt FROM (
  SELECT cnt, unnest(seq[1:len(seq) - 1]) AS l, unnest(seq[2:len(seq)]) AS r FROM s WHERE len(seq) >= 2)
GROUP BY l, r""")
def q_pair_counts(spark, sf):
    from quarry.operators.tokenizer import pair_counts, pretoken_counts, utf8_bytes
    wc = pretoken_counts(tables.documents(spark, sf).select("text"))
    words = wc.select(utf8_bytes("word").alias("seq"), "cnt")
    return pair_counts(words).select(F.col("l").cast("int").alias("l"), F.col("r").cast("int").alias("r"),
                                     F.col("cnt").cast("bigint").alias("cnt"))


_MERGES = 64
_WORD_COUNTS_SQL = f"SELECT word, count(*) AS cnt FROM ({_PRETOKENS_SQL}) GROUP BY word"


def _trained(spark, sf):
    from quarry.operators.tokenizer import pretoken_counts, train_bpe
    wc = pretoken_counts(tables.documents(spark, sf).select("text"))
    return train_bpe(wc, 256 + 3 + _MERGES)


@register("bpe_merges", f"""
WITH {S.bpe_training(_WORD_COUNTS_SQL, _MERGES)}
SELECT rank, left_id, right_id, new_id, l AS "left", r AS "right" FROM ({" UNION ALL ".join(f"SELECT * FROM m{i}" for i in range(_MERGES))})""")
def q_bpe_merges(spark, sf):
    """64 merges trained on the documents; bytes as hex."""
    from quarry.operators.tokenizer import merges_table
    return merges_table(spark, _trained(spark, sf)).withColumns({"left": F.hex("left"), "right": F.hex("right")})


# ---------------------------------------------------------------------------
# Encode, decode, totals, windows, shards (byte-level model,
# so the oracle can state the ids: UTF-8 bytes of the text)
# ---------------------------------------------------------------------------

def _byte_tokens(spark, sf, sentinel=False):
    from quarry.operators.tokenizer import BpeModel, base_vocab, encode
    from quarry.functions import patterns as pt
    docs = tables.documents(spark, sf).select("doc_id", "text", "source")
    if sentinel:
        docs = docs.withColumn("text", F.concat("text", F.lit("\n" + pt.ENDOFTEXT + "\n")))
    model = BpeModel(vocab=base_vocab(pt.SPECIAL_TOKENS), merges=[], specials=list(pt.SPECIAL_TOKENS))
    return docs, model, encode(docs, model)


_UNIX_TEXT = "replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_BYTES_SQL = f"(SELECT doc_id, source, {S.utf8_bytes(_UNIX_TEXT)} AS ids FROM documents)"
_STREAM_SQL = f"""(SELECT doc_id, ids || [10, 256, 10] AS ids FROM {_BYTES_SQL})"""
_FLAT_SQL = f"""(SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, id FROM (
    SELECT doc_id, unnest(range(len(ids))) AS i, unnest(ids) AS id FROM {_STREAM_SQL}))"""


@register("bpe_encode_bytes", f"SELECT doc_id, ids FROM {_BYTES_SQL}")
def q_bpe_encode_bytes(spark, sf):
    _, _, tok = _byte_tokens(spark, sf)
    return tok.select("doc_id", "ids")


@register("bpe_roundtrip", """
SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents""")
def q_bpe_roundtrip(spark, sf):
    from quarry.operators.tokenizer import decode
    _, model, tok = _byte_tokens(spark, sf)
    return decode(tok, model).select("doc_id", "text")


@register("token_totals", f"""
SELECT source, sum(len(ids))::BIGINT AS n_tokens, count(*)::BIGINT AS n_docs
FROM {_BYTES_SQL} GROUP BY ROLLUP (source)""")
def q_token_totals(spark, sf):
    from quarry.operators.tokenizer import encode
    docs, model, _ = _byte_tokens(spark, sf)
    t = encode(docs, model, key="source")  # sums need the source alone beside the ids
    return (t.rollup("source").agg(F.sum(F.size("ids")).cast("bigint").alias("n_tokens"),
                                   F.count(F.lit(1)).cast("bigint").alias("n_docs")))


@register("token_windows", f"""
WITH f AS {_FLAT_SQL}, n AS (SELECT count(*) AS n FROM f)
SELECT w AS window_id, w * 128 AS start,
       list(id ORDER BY pos) FILTER (WHERE pos < w * 128 + 128) AS x,
       list(id ORDER BY pos) FILTER (WHERE pos > w * 128) AS y
FROM (SELECT f.pos, f.id, unnest(CASE WHEN f.pos % 128 = 0 AND f.pos > 0
                                      THEN [f.pos // 128, f.pos // 128 - 1] ELSE [f.pos // 128] END) AS w
      FROM f), n
WHERE w < (n.n - 1) // 128
GROUP BY w""")
def q_token_windows(spark, sf):
    from quarry.operators.windows import doc_windows
    _, _, tok = _byte_tokens(spark, sf, sentinel=True)
    return doc_windows(reliable_checkpoint(tok), 128)


@register("random_windows", f"""
WITH f AS {_FLAT_SQL}, n AS (SELECT count(*) AS n FROM f),
s AS (SELECT k, ('0x' || substr(md5('7:' || k::VARCHAR), 1, 15))::BIGINT % (n.n - 128) AS start
      FROM range(0, 64) r(k), n)
SELECT s.k, s.start, list(f.id ORDER BY f.pos) FILTER (WHERE f.pos < s.start + 128) AS x,
       list(f.id ORDER BY f.pos) FILTER (WHERE f.pos > s.start) AS y
FROM s JOIN f ON f.pos BETWEEN s.start AND s.start + 128
GROUP BY s.k, s.start""")
def q_random_windows(spark, sf):
    from quarry.operators.windows import doc_random_windows
    _, _, tok = _byte_tokens(spark, sf, sentinel=True)
    return doc_random_windows(reliable_checkpoint(tok), 64, 128, seed=7)


@register("rank_shards", f"""
WITH f AS {_FLAT_SQL}, n AS (SELECT count(*) AS n FROM f)
SELECT least(pos // (n.n // 8), 7)::INTEGER AS rank, count(*)::BIGINT AS n_tokens,
       min(pos)::BIGINT AS first_pos, max(pos)::BIGINT AS last_pos
FROM f, n GROUP BY 1""")
def q_rank_shards(spark, sf):
    from quarry.operators.windows import shard_summary
    _, _, tok = _byte_tokens(spark, sf, sentinel=True)
    return shard_summary(reliable_checkpoint(tok), 8)



_RANKS, _BATCH, _WIDTH, _EPOCH = 4, 8, 64, 2


@register("rank_batches", f"""
WITH f AS {_FLAT_SQL}, n AS (SELECT count(*) AS n, count(*) // {_RANKS} AS per FROM f),
s AS (SELECT rank::INTEGER AS rank, k, rank * n.per + ('0x' || substr(md5(':' || (42 + rank + 1000 * {_EPOCH})::VARCHAR || ':' || k::VARCHAR), 1, 15))::BIGINT
             % (CASE WHEN rank = {_RANKS - 1} THEN n.n - n.per * {_RANKS - 1} ELSE n.per END - {_WIDTH}) AS start
      FROM range(0, {_RANKS}) r(rank), range(0, {_BATCH}) b(k), n)
SELECT s.rank, s.k, s.start, list(f.id ORDER BY f.pos) FILTER (WHERE f.pos < s.start + {_WIDTH}) AS x,
       list(f.id ORDER BY f.pos) FILTER (WHERE f.pos > s.start) AS y
FROM s JOIN f ON f.pos BETWEEN s.start AND s.start + {_WIDTH} GROUP BY ALL""")
def q_rank_batches(spark, sf):
    """Every rank's seeded batch of an epoch from its own shard."""
    from quarry.operators.windows import rank_batches
    _, _, tok = _byte_tokens(spark, sf, sentinel=True)
    return rank_batches(reliable_checkpoint(tok), _RANKS, _BATCH, _WIDTH, seed=42, epoch=_EPOCH)


from quarry.plans import catalog_text  # noqa: E402,F401  (registers more queries)


# ---------------------------------------------------------------------------
# O7 weighted dataset mixing: slot -> dataset by md5-uniform draw against the
# cumulative weights, then the slot takes its dataset's next window.
# Datasets: byte-level streams of English (0) and other-language (1) documents.
# ---------------------------------------------------------------------------

_MIX_L = 64
_MIX_SLOTS = 48
_MIX_W = (0.7, 0.3)


def _mix_stream_sql(cond):
    return f"""(SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, id FROM (
      SELECT doc_id, unnest(range(len(ids))) AS i, unnest(ids) AS id FROM (
        SELECT doc_id, {S.utf8_bytes('text')} || [10, 256, 10] AS ids FROM documents WHERE {cond})))"""


_U_SQL = "(('0x' || substr(md5('3:' || id::VARCHAR), 1, 15))::BIGINT % 1073741824) / 1073741824.0"


@register("mix_datasets", f"""
WITH s AS (SELECT id AS slot, CASE WHEN {_U_SQL} < {_MIX_W[0] / sum(_MIX_W)} THEN 0 ELSE 1 END AS dataset
           FROM range(0, {_MIX_SLOTS}) t(id)),
k AS (SELECT slot, dataset, row_number() OVER (PARTITION BY dataset ORDER BY slot) - 1 AS k FROM s),
f0 AS {_mix_stream_sql("lang = 'en'")}, f1 AS {_mix_stream_sql("lang <> 'en'")},
w AS (SELECT 0 AS dataset, pos // {_MIX_L} AS window_id, id, pos FROM f0
      UNION ALL SELECT 1, pos // {_MIX_L}, id, pos FROM f1),
x AS (SELECT dataset, window_id, list(id ORDER BY pos) AS x FROM w GROUP BY 1, 2),
n AS (SELECT dataset, count(*) AS nw FROM x WHERE len(x) = {_MIX_L} GROUP BY 1)
SELECT k.slot, k.dataset, x.window_id, x.x FROM k JOIN n USING (dataset)
JOIN x ON x.dataset = k.dataset AND x.window_id = k.k % n.nw""")
def q_mix_datasets(spark, sf):
    from quarry.operators.tokenizer import utf8_bytes
    from quarry.operators.windows import doc_offsets, mix_slots, windows_at
    from pyspark.sql import Window
    d = tables.documents(spark, sf).select("doc_id", "lang", "text")
    ids = F.concat(utf8_bytes("text"), F.array(F.lit(10), F.lit(256), F.lit(10)))
    slots = mix_slots(_MIX_SLOTS, list(_MIX_W), 2, seed=3, spark=spark)
    # the slot table has _MIX_SLOTS rows (a parameter), so this window is bounded
    k = slots.withColumn("k", F.row_number().over(Window.partitionBy("dataset").orderBy("slot")) - 1)
    parts = []
    for ds, cond in ((0, F.col("lang") == "en"), (1, F.col("lang") != "en")):
        # a slot takes its dataset's next full window of L tokens, around again after the last; only these are built
        tok = d.filter(cond).select("doc_id", ids.alias("ids"))
        off = doc_offsets(tok)
        full = (off.agg(F.sum("n")).first()[0] or 0) // _MIX_L
        mine = k.filter(F.col("dataset") == ds).select(
            "slot", (F.col("k") % F.lit(full)).cast("bigint").alias("window_id")) if full else k.limit(0).select("slot", F.col("k").alias("window_id"))
        starts = mine.withColumn("start", F.col("window_id") * _MIX_L)
        parts.append(windows_at(tok, off, starts, _MIX_L).select("slot", F.lit(ds).alias("dataset"), "window_id", "x"))
    return parts[0].unionByName(parts[1])


@register("vocab_longest", f"""
WITH {S.bpe_training(_WORD_COUNTS_SQL, _MERGES)}
SELECT id::INTEGER AS token_id, hex AS token_hex, (length(hex) // 2)::INTEGER AS n_bytes
FROM v{_MERGES} ORDER BY n_bytes DESC, token_id LIMIT 10""")
def q_vocab_longest(spark, sf):
    """O3 on a 64-merge vocabulary trained on the documents."""
    from quarry.operators.tokenizer import longest_tokens
    return longest_tokens(spark, _trained(spark, sf), 10)


@register("bpe_encode_trained", f"""
WITH {S.bpe_training(_WORD_COUNTS_SQL, _MERGES)},
u AS (SELECT doc_id, flatten(list_transform(regexp_extract_all({_UNIX_TEXT}, '[^\\n]*\\n|[^\\n]+'),
        lambda line: {S.pretoken_words('line')})) AS ws FROM documents),
q AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM u),
d AS (SELECT DISTINCT word FROM q),
e AS (SELECT word, CASE WHEN v.id IS NOT NULL THEN [v.id::INTEGER] ELSE {S.bpe_encoded('word', _MERGES)} END AS ids
      FROM d LEFT JOIN (SELECT hex, max(id) AS id FROM v{_MERGES} GROUP BY hex) v ON v.hex = hex(encode(word))),
f AS (SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM q JOIN e USING (word) GROUP BY doc_id)
SELECT u.doc_id, coalesce(f.ids, []::INTEGER[]) AS ids FROM u LEFT JOIN f USING (doc_id)""")
def q_bpe_encode_trained(spark, sf):
    """Documents encoded with the 64 merges trained on them."""
    from quarry.operators.tokenizer import encode
    return encode(tables.documents(spark, sf).select("doc_id", "text"), _trained(spark, sf))


@register("bpe_roundtrip_trained", """
SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents""")
def q_bpe_roundtrip_trained(spark, sf):
    """What the trained model encodes decodes to the text."""
    from quarry.operators.tokenizer import decode, encode
    model = _trained(spark, sf)
    return decode(encode(tables.documents(spark, sf).select("doc_id", "text"), model), model).select("doc_id", "text")


@register("bpe_first_merge", f"""
WITH w AS (SELECT word, count(*) AS cnt FROM ({_PRETOKENS_SQL}) GROUP BY word),
s AS (SELECT cnt, {S.utf8_bytes('word')} AS seq FROM w),
p AS (SELECT l, r, sum(cnt) AS cnt FROM (
  SELECT cnt, unnest(seq[1:len(seq) - 1]) AS l, unnest(seq[2:len(seq)]) AS r FROM s WHERE len(seq) >= 2)
  GROUP BY l, r)
SELECT 0 AS rank, l::INTEGER AS left_id, r::INTEGER AS right_id, 259 AS new_id
FROM p ORDER BY cnt DESC, l, r LIMIT 1""")
def q_bpe_first_merge(spark, sf):
    """T3 first step (max count, ties to the smallest pair): SQL-checkable slice of training."""
    from quarry.operators.tokenizer import merges_table, pretoken_counts, train_bpe
    wc = pretoken_counts(tables.documents(spark, sf).select("text"))
    m = merges_table(spark, train_bpe(wc, 256 + 3 + 1))
    return m.select("rank", "left_id", "right_id", "new_id")
