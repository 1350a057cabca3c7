"""Registered text-pipeline queries: wiki, HTML, URLs, dialogs, generated
text, scoring, sampling and classifier inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import patterns as pt
from quarry.functions import text as T
from quarry.plans import sqltext as S
from quarry.plans.catalog import register
from quarry.sources import tables

# ---------------------------------------------------------------------------
# P4 P5 F2-F4 A9 article extraction (title = first line of the document)
# ---------------------------------------------------------------------------

_ART_SQL = f"""
WITH a AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, text FROM documents),
c AS (SELECT doc_id, title, CASE WHEN NOT contains(title, ':') THEN {S.clean_article(S.clean_wikitext('text'))} END AS cleaned FROM a),
s AS (SELECT doc_id, title, cleaned,
        CASE WHEN contains(title, ':') THEN 'namespace'
             WHEN length(cleaned) < {pt.ARTICLE_MIN_LENGTH} THEN 'too_short'
             WHEN NOT {S.article_ok('cleaned')} THEN 'filtered' ELSE 'kept' END AS status FROM c)"""


def _articles(spark, sf):
    from quarry.plans.wiki import process_articles
    d = tables.documents(spark, sf).select("doc_id", "text")
    d = d.withColumn("title", F.substring_index("text", "\n", 1))
    return process_articles(d)


@register("article_clean", _ART_SQL + """
SELECT doc_id, status, cleaned FROM s""")
def q_article_clean(spark, sf):
    return _articles(spark, sf).select("doc_id", "status", "cleaned")


@register("article_records", _ART_SQL + """
SELECT doc_id, title || cleaned || chr(10) || '<|endoftext|>' || chr(10) AS out FROM s WHERE status = 'kept'""")
def q_article_records(spark, sf):
    from quarry.functions.plan import materialized
    a = materialized(_articles(spark, sf).select("doc_id", "status", "out"))
    return a.filter(F.col("status") == "kept").select("doc_id", "out")


@register("extraction_counters", _ART_SQL + """
SELECT count(*)::BIGINT AS n_processed, count_if(status = 'kept')::BIGINT AS n_kept,
       count_if(status IN ('too_short', 'filtered'))::BIGINT AS n_skipped FROM s""")
def q_extraction_counters(spark, sf):
    from quarry.plans.wiki import extraction_counters
    return extraction_counters(_articles(spark, sf))


# ---------------------------------------------------------------------------
# P1 HTML -> text, F9 URL predicate, O5 URL sample
# ---------------------------------------------------------------------------

@register("html_text", f"SELECT page_id, {S.html_text('html')} AS text FROM pages")
def q_html_text(spark, sf):
    from quarry.functions.html import html_to_text
    return tables.pages(spark, sf).select("page_id", html_to_text("html").alias("text"))


# References that stand for what the page says anyway: named, decimal, hexadecimal, and an escaped reference.
_REFERENCES = [("é", "&eacute;"), ("ü", "&#252;"), ("ß", "&#xDF;"), ("ä", "&#x000e4;"), ("ñ", "&ntilde;"), (" the ", " &#116;&#104;e&#32;")]


@register("html_references", f"""
SELECT page_id, {S.html_text("html || ' &amp;lt;'")} AS text FROM pages""")
def q_html_references(spark, sf):
    """Pages whose letters are written as character references read like the pages themselves."""
    from quarry.functions.html import html_to_text
    p = tables.pages(spark, sf)
    t = F.col("html")
    for letter, reference in _REFERENCES:
        t = F.replace(t, F.lit(letter), F.lit(reference))
    return p.select("page_id", html_to_text(F.concat(t, F.lit(" &amp;lt;"))).alias("text"))


@register("warc_page_text", f"""
SELECT url, {S.html_text('html')} AS text, len({S.split_ws(S.html_text('html'))}) > 100 AS long
FROM pages""")
def q_warc_page_text(spark, sf):
    """The pages rendered as WARC files in Latin-1 or UTF-8, parsed back to records and to text."""
    from quarry.sources.warc import is_long, pages_as_warc, records_from_files, response_texts
    texts = response_texts(records_from_files(pages_as_warc(tables.pages(spark, sf)), ["response"]))
    return texts.select(F.col("target_uri").alias("url"), "text", is_long("text").alias("long"))


@register("page_quality", f"""
WITH p AS (SELECT page_id, {S.html_text('html')} AS text FROM pages),
g AS ({S.gopher_cte('p', 'text', 'page_id')})
SELECT page_id, n_words, reason IS NULL AS passed FROM g""")
def q_page_quality(spark, sf):
    from quarry.functions.html import html_to_text
    p = tables.pages(spark, sf).select("page_id", html_to_text("html").alias("text"))
    g = T.gopher_metrics("text")
    return p.select("page_id", g["n_words"].alias("n_words"), g["passed"].alias("passed"))


@register("url_filter", """
SELECT page_id, url FROM pages
WHERE starts_with(trim(url), 'http') AND NOT contains(trim(url), ' ') AND length(trim(url)) < 500""")
def q_url_filter(spark, sf):
    p = tables.pages(spark, sf).select("page_id", "url")
    return p.filter(T.valid_url(F.trim("url")))


@register("url_sample", """
SELECT url FROM (SELECT trim(url) AS url FROM pages) WHERE starts_with(url, 'http') AND NOT contains(url, ' ')
AND length(url) < 500 ORDER BY md5('42:' || url), url LIMIT 100""")
def q_url_sample(spark, sf):
    from quarry.operators.sampling import url_sample
    return url_sample(tables.pages(spark, sf), n=100, seed=42)


# ---------------------------------------------------------------------------
# P18 W8 dialogs
# ---------------------------------------------------------------------------

_UTTS = f"list_filter(list_transform(list(text ORDER BY turn), lambda u: {S.py_strip('u')}), lambda u: length(u) > 0)"


@register("dialog_format", f"""
SELECT conv_id, array_to_string(list_transform(u, lambda x, i: CASE WHEN (i - 1) % 2 = 0
         THEN '<|user|>' || chr(10) ELSE '<|assistant|>' || chr(10) END || x || chr(10)), '')
       || '<|endoftext|>' || chr(10) AS text
FROM (SELECT conv_id, {_UTTS} AS u FROM conversations WHERE role <> 'system' GROUP BY conv_id)
WHERE len(u) >= 2""")
def q_dialog_format(spark, sf):
    from quarry.operators.dialog import format_conversations
    return format_conversations(tables.conversations(spark, sf))


@register("dialog_turn_roles", """
SELECT conv_id, count(*)::BIGINT AS n_turns,
       count_if(CASE WHEN idx % 2 = 0 THEN 'user' ELSE 'assistant' END <> role)::BIGINT AS n_mismatch
FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx
      FROM conversations WHERE role <> 'system') GROUP BY conv_id""")
def q_dialog_turn_roles(spark, sf):
    from quarry.operators.dialog import turn_roles
    return turn_roles(tables.conversations(spark, sf))


# ---------------------------------------------------------------------------
# P15-P17 generated-text handling (conversation turns as model output)
# ---------------------------------------------------------------------------

@register("clean_generated", f"SELECT conv_id, turn, {S.clean_generated('text')} AS text FROM conversations")
def q_clean_generated(spark, sf):
    c = tables.conversations(spark, sf)
    return c.select("conv_id", "turn", T.clean_generated("text").alias("text"))


_CHAT = ("'<|user|>' || chr(10) || text || chr(10) || '<|assistant|>' || chr(10)")


@register("chat_prompt", f"SELECT conv_id, turn, {_CHAT} AS prompt FROM conversations WHERE role = 'user'")
def q_chat_prompt(spark, sf):
    c = tables.conversations(spark, sf).filter(F.col("role") == "user")
    return c.select("conv_id", "turn", T.chat_prompt("text").alias("prompt"))


_RESP_IN = "(" + _CHAT + " || text2)"


@register("extract_response", f"""
SELECT conv_id, turn, {S.clean_generated("replace(replace(replace(string_split(ftxt, '<|assistant|>')[-1], '<|endoftext|>', ''), '<|user|>', ''), '<|assistant|>', '')")} AS response
FROM (SELECT u.conv_id, u.turn, '<|user|>' || chr(10) || u.text || chr(10) || '<|assistant|>' || chr(10) || a.text || '<|endoftext|>' AS ftxt
      FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
      WHERE u.role = 'user' AND a.role = 'assistant')""")
def q_extract_response(spark, sf):
    c = tables.conversations(spark, sf)
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("ut"))
    a = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                        F.col("text").alias("at"))
    j = u.join(a, ["conv_id", "turn"])
    full = F.concat(T.chat_prompt("ut"), F.col("at"), F.lit(pt.ENDOFTEXT))
    return j.select("conv_id", "turn", T.extract_response(full).alias("response"))


# ---------------------------------------------------------------------------
# A13 A14 W5 W6 scoring of (logits, target) rows: embeddings as logits
# ---------------------------------------------------------------------------

_Z = "list_transform(embedding, lambda x: x::DOUBLE)"
_M = f"list_max({_Z})"
_LSE = f"ln(list_sum(list_transform({_Z}, lambda x: exp(x - {_M}))))"
_CE = f"(-({_Z}[label + 1] - {_M} - {_LSE}))"


@register("cross_entropy_rows", f"SELECT vec_id, round({_CE}, 6) AS loss FROM embeddings")
def q_cross_entropy_rows(spark, sf):
    from quarry.operators.scoring import cross_entropy
    e = tables.embeddings(spark, sf)
    return e.select("vec_id", F.round(cross_entropy("embedding", "label"), 6).alias("loss"))


@register("cross_entropy", f"""
SELECT round(avg(l), 6) AS mean_loss, round(exp(avg(l)), 6) AS perplexity, count(*)::BIGINT AS n
FROM (SELECT {_CE} AS l FROM embeddings)""")
def q_cross_entropy(spark, sf):
    from quarry.operators.scoring import cross_entropy
    e = tables.embeddings(spark, sf).select(cross_entropy("embedding", "label").alias("l"))
    return e.agg(F.round(F.avg("l"), 6).alias("mean_loss"), F.round(F.exp(F.avg("l")), 6).alias("perplexity"),
                 F.count(F.lit(1)).cast("bigint").alias("n"))


@register("softmax_rows", f"""
SELECT vec_id, (list_position(p, list_max(p)) - 1)::INTEGER AS argmax, round(list_max(p), 6) AS p_max
FROM (SELECT vec_id, list_transform({_Z}, lambda x: exp(x - {_M}) / list_sum(list_transform({_Z}, lambda y: exp(y - {_M})))) AS p
      FROM embeddings)""")
def q_softmax_rows(spark, sf):
    from quarry.operators.scoring import softmax
    e = tables.embeddings(spark, sf).select("vec_id", softmax("embedding").alias("p"))
    return e.select("vec_id", (F.array_position("p", F.array_max("p")) - 1).cast("int").alias("argmax"),
                    F.round(F.array_max("p"), 6).alias("p_max"))


@register("top_p_mass", f"""
WITH p AS (SELECT vec_id, list_transform({_Z}, lambda x: exp(x - {_M}) / list_sum(list_transform({_Z}, lambda y: exp(y - {_M})))) AS p
           FROM embeddings),
e AS (SELECT vec_id, unnest(range(len(p))) AS i, unnest(p) AS pr FROM p),
c AS (SELECT vec_id, i, pr, sum(pr) OVER (PARTITION BY vec_id ORDER BY pr DESC, i
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM e)
SELECT vec_id, count(*)::BIGINT AS n_kept FROM c WHERE cs - pr <= 0.9 GROUP BY vec_id""")
def q_top_p_mass(spark, sf):
    from quarry.operators.scoring import nucleus, softmax
    e = tables.embeddings(spark, sf).select("vec_id", softmax("embedding").alias("p"))
    return nucleus(e, "p", 0.9, ["vec_id"]).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n_kept"))


@register("top_p_nucleus", f"""
WITH p AS (SELECT vec_id, list_transform({_Z}, lambda x: exp(x - {_M}) / list_sum(list_transform({_Z}, lambda y: exp(y - {_M})))) AS p
           FROM embeddings),
e AS (SELECT vec_id, unnest(range(len(p))) AS i, unnest(p) AS pr FROM p),
c AS (SELECT vec_id, i, pr, row_number() OVER (PARTITION BY vec_id ORDER BY pr DESC, i) AS rank,
             sum(pr) OVER (PARTITION BY vec_id ORDER BY pr DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM e)
SELECT vec_id, rank::INTEGER AS rank, i::INTEGER AS i, round(pr / sum(pr) OVER (PARTITION BY vec_id), 6) AS share
FROM c WHERE cs - pr <= 0.9""")
def q_top_p_nucleus(spark, sf):
    """Kept entries with their renormalised probabilities."""
    from quarry.operators.scoring import nucleus, softmax
    e = tables.embeddings(spark, sf).select("vec_id", softmax("embedding").alias("p"))
    return nucleus(e, "p", 0.9, ["vec_id"]).select("vec_id", "rank", "i", F.round("share", 6).alias("share"))


# ---------------------------------------------------------------------------
# W7 repeated n-gram stop on word sequences
# ---------------------------------------------------------------------------

def _repeat_sql(n):
    return (f"list_min(list_filter(range({3 * n}, len(w) + 1), lambda e: "
            f"w[e - {3 * n} + 1 : e - {2 * n}] = w[e - {2 * n} + 1 : e - {n}] AND "
            f"w[e - {2 * n} + 1 : e - {n}] = w[e - {n} + 1 : e]))")


@register("repeat_filter", f"""
WITH w AS (SELECT doc_id, {S.words('text')} AS w FROM documents),
c AS (SELECT doc_id, {', '.join(f'{_repeat_sql(n)} AS e{n}' for n in range(3, 9))} FROM w),
b AS (SELECT doc_id, least({', '.join(f'e{n}' for n in range(3, 9))}) AS e,
      {', '.join(f'e{n}' for n in range(3, 9))} FROM c)
SELECT doc_id, e::INTEGER AS end_pos,
       (CASE {' '.join(f'WHEN e{n} = e THEN {n}' for n in range(3, 9))} END)::INTEGER AS n,
       (e - 2 * (CASE {' '.join(f'WHEN e{n} = e THEN {n}' for n in range(3, 9))} END))::INTEGER AS keep
FROM b""")
def q_repeat_filter(spark, sf):
    from quarry.operators.scoring import repeat_cut
    d = tables.documents(spark, sf).select("doc_id", T.words("text").alias("w"))
    r = d.select("doc_id", repeat_cut(F.col("w")).alias("r"))
    return r.select("doc_id", F.col("r.end").cast("int").alias("end_pos"),
                    F.col("r.n").cast("int").alias("n"), F.col("r.keep").cast("int").alias("keep"))


# ---------------------------------------------------------------------------
# Sampling, balancing, classifier inputs
# ---------------------------------------------------------------------------

@register("balanced_labels", """
WITH c AS (SELECT least(count_if(quality = 1), count_if(quality = 0)) AS n FROM labels)
SELECT doc_id, quality FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) AS rn FROM labels
  WHERE quality IN (0, 1)) , c WHERE rn <= c.n""")
def q_balanced_labels(spark, sf):
    from quarry.operators.sampling import balance_classes
    lab = tables.labels(spark, sf).select("doc_id", "quality")
    return balance_classes(lab, "quality", "doc_id").select("doc_id", "quality")


@register("classifier_training_rows", f"""
WITH j AS (SELECT l.doc_id, CASE WHEN l.quality = 1 THEN 'high_quality' ELSE 'low_quality' END AS label,
                  array_to_string({S.split_ws('d.text')}[1:300], ' ') AS clean
           FROM labels l JOIN documents d USING (doc_id))
SELECT doc_id, '__label__' || label || ' ' || clean AS line FROM j WHERE len({S.split_ws('clean')}) > 30""")
def q_classifier_training_rows(spark, sf):
    from quarry.operators.sampling import fasttext_lines
    lab = tables.labels(spark, sf)
    d = tables.documents(spark, sf).select("doc_id", "text")
    j = lab.join(d, "doc_id").withColumn(
        "label", F.when(F.col("quality") == 1, "high_quality").otherwise("low_quality"))
    return fasttext_lines(j, "label").select("doc_id", "line")


@register("shuffle_order", "SELECT doc_id, md5('42:' || doc_id::VARCHAR) AS shuffle_key FROM documents")
def q_shuffle_order(spark, sf):
    from quarry.operators.sampling import shuffle_keys
    return shuffle_keys(tables.documents(spark, sf).select("doc_id"), "doc_id", seed=42)


@register("first_n_docs", """
SELECT doc_id, lang FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 300""")
def q_first_n_docs(spark, sf):
    from quarry.operators.sampling import first_n
    d = tables.documents(spark, sf).select("doc_id", "lang").filter(F.col("lang") == "en")
    return first_n(d, "doc_id", 300)


@register("corpus_concat", """
SELECT 0 AS src_ord, doc_id AS id, text FROM documents
UNION ALL SELECT 1 AS src_ord, item_id AS id, text FROM benchmark""")
def q_corpus_concat(spark, sf):
    d = tables.documents(spark, sf).select(F.lit(0).alias("src_ord"), F.col("doc_id").alias("id"), "text")
    b = tables.benchmark(spark, sf).select(F.lit(1).alias("src_ord"), F.col("item_id").alias("id"), "text")
    return d.unionByName(b)


@register("doc_snippets", """
SELECT doc_id, substr(text, (('0x' || substr(md5('5:' || doc_id::VARCHAR), 1, 15))::BIGINT
                             % (length(text) - 499) + 1)::INTEGER, 500) AS snippet
FROM documents WHERE length(text) >= 500""")
def q_doc_snippets(spark, sf):
    from quarry.operators.windows import md5_uniform
    d = tables.documents(spark, sf).select("doc_id", "text").filter(F.length("text") >= 500)
    off = F.pmod(md5_uniform(5, F.col("doc_id")), (F.length("text") - 499).cast("bigint"))
    return d.select("doc_id", F.substring("text", (off + 1).cast("int"), 500).alias("snippet"))


# ---------------------------------------------------------------------------
# M1-M7 classifiers
# ---------------------------------------------------------------------------

def _nb_sql(label_col: str) -> str:
    sw = S.split_ws("text")
    return f"""
WITH d AS (SELECT l.doc_id, l.{label_col} AS label, d.text FROM labels l JOIN documents d USING (doc_id)),
wc AS (SELECT word, label, count(*) AS c FROM (SELECT label, unnest({sw}) AS word FROM d) GROUP BY 1, 2),
tot AS (SELECT label, sum(c) AS tot FROM wc GROUP BY 1),
v AS (SELECT count(DISTINCT word) AS v FROM wc),
labs AS (SELECT DISTINCT label FROM d),
logp AS (SELECT g.word, g.label, ln((coalesce(wc.c, 0) + 1) / (tot.tot + v.v)) AS logp
         FROM (SELECT w.word, labs.label FROM (SELECT DISTINCT word FROM wc) w CROSS JOIN labs) g
         LEFT JOIN wc ON wc.word = g.word AND wc.label = g.label JOIN tot ON tot.label = g.label CROSS JOIN v),
prior AS (SELECT label, ln(count(*) / (SELECT count(*) FROM d)) AS lp FROM d GROUP BY 1),
dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({sw}) AS word FROM documents) GROUP BY 1, 2),
s AS (SELECT doc_id, label, sum(n * logp) AS ll FROM dw JOIN logp USING (word) GROUP BY 1, 2),
sc AS (SELECT d.doc_id, labs.label, coalesce(s.ll, 0) + prior.lp AS score
       FROM documents d CROSS JOIN labs LEFT JOIN s ON s.doc_id = d.doc_id AND s.label = labs.label
       JOIN prior ON prior.label = labs.label)
SELECT doc_id, first(label ORDER BY score DESC, label) AS pred, round(1 / sum(exp(score - best)), 5) AS score
FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS best FROM sc) GROUP BY doc_id"""


def _nb_query(spark, sf, label_col):
    from quarry.operators.classify import nb_predict, nb_train
    lab = tables.labels(spark, sf).select("doc_id", F.col(label_col).alias("label"))
    docs = tables.documents(spark, sf).select("doc_id", "text")
    model = nb_train(lab.join(docs, "doc_id"), label="label")
    return nb_predict(docs, model).select("doc_id", "pred", F.round("score", 5).alias("score"))


@register("nb_quality", _nb_sql("quality"))
def q_nb_quality(spark, sf):
    """M5/M6 closed-form twin: quality labels."""
    return _nb_query(spark, sf, "quality")


@register("nb_toxicity", _nb_sql("toxic"))
def q_nb_toxicity(spark, sf):
    """M2/M3: toxicity labels, same operator."""
    return _nb_query(spark, sf, "toxic")


@register("lowrank_quality")
def q_lowrank_quality(spark, sf):
    """M5/M6: fitted on labelled documents outside the held-out quarter, every document scored."""
    from quarry.operators import lowrank
    docs = tables.documents(spark, sf).select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 0
    lab = tables.labels(spark, sf).filter(~held_out).select("doc_id", F.when(F.col("quality") == 1, "high_quality").otherwise("low_quality").alias("label"))
    model = lowrank.train(lab.join(docs, "doc_id"))
    return lowrank.predict(docs, model).withColumn("held_out", held_out)


@register("lr_quality_metrics")
def q_lr_quality_metrics(spark, sf):
    """M4 -> M5 -> M6 -> A12 with MLlib (rows-only: no SQL twin)."""
    from quarry.operators.classify import evaluate, predict_labels, quality_pipeline
    lab = tables.labels(spark, sf).select(
        "doc_id", F.when(F.col("quality") == 1, "high_quality").otherwise("low_quality").alias("label"))
    d = lab.join(tables.documents(spark, sf).select("doc_id", "text"), "doc_id")
    model = quality_pipeline().fit(d)
    return evaluate(predict_labels(model, d), "label")


@register("lang_id")
def q_lang_id(spark, sf):
    """M1 language identification (label, score) with MLlib NB on char trigrams."""
    from quarry.operators.classify import language_pipeline, predict_labels
    d = tables.documents(spark, sf).select("doc_id", "text", "lang")
    model = language_pipeline().fit(d)
    p = predict_labels(model, d)
    return p.select("doc_id", "lang", F.col("pred.label").alias("pred"), F.col("pred.score").alias("score"))


# Temperature 0.8, ids 0 and 1 banned, then nucleus 0.9 (embedding = logits)
_ZM = (f"list_transform({_Z}, lambda x, i: CASE WHEN i - 1 IN (0, 1) THEN -1e9 ELSE x / 0.8 END)")
_MM = f"list_max({_ZM})"


@register("top_p_masked", f"""
WITH p AS (SELECT vec_id, list_transform({_ZM}, lambda x: exp(x - {_MM}) / list_sum(list_transform({_ZM}, lambda y: exp(y - {_MM})))) AS p
           FROM embeddings),
e AS (SELECT vec_id, unnest(range(len(p))) AS i, unnest(p) AS pr FROM p),
c AS (SELECT vec_id, i, pr, sum(pr) OVER (PARTITION BY vec_id ORDER BY pr DESC, i
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM e)
SELECT vec_id, count(*)::BIGINT AS n_kept, min(i)::INTEGER AS min_id FROM c WHERE cs - pr <= 0.9 GROUP BY vec_id""")
def q_top_p_masked(spark, sf):
    from quarry.operators.scoring import masked_logits, nucleus, softmax
    e = tables.embeddings(spark, sf).select("vec_id", masked_logits("embedding", 0.8, banned=[0, 1]).alias("z"))
    kept = nucleus(e.select("vec_id", softmax("z").alias("p")), "p", 0.9, ["vec_id"])
    return kept.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n_kept"), F.min("i").alias("min_id"))
