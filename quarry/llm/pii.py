"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Everything runs on DataFrame functions.  One pass over the texts marks the
matches of six patterns (four exact kinds and two loose ones: spelled-out
e-mail addresses and phone numbers without a country code) and keeps a narrow
row per match; later steps only read those rows.

Labelers look at the match itself (pattern), at fixed word lists (gazetteer)
and at the words around it (context); each votes for, against or not at all.
Votes are counted per kind and pattern of votes (at most 3^5 patterns a kind),
and expectation-maximisation estimates each labeler's reliability from these
counts.  The posteriors then train a naive Bayes span classifier over the
match's shape and the word before it.  Exact matches always stay; loose ones
are added where the classifier says so and no exact match overlaps.

Cases: null text counts as empty; repeated rows get equal results; rows
without doc_id get results as well; an empty table gives an empty result; a
text of any length is searched whole in linear time; offsets are code points.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import fresh_name, settled

# The kinds in output order and the exact patterns, written so that Java's
# matcher starts once per run of characters and never backtracks over one.
KINDS = ("email", "ip", "card", "phone")
_WORD = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_WORD})){_WORD}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_words": r"(?i)(?<![A-Za-z0-9._-])[a-z0-9][a-z0-9._-]{0,63}+\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[a-z0-9-]{1,63}+"
                   r"(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[a-z0-9-]{2,63}+){1,4}+",
    "phone_local": r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])",
}
CUES = {"email": "mail|contact|write|kontakt|correo|courriel", "ip": "ip|host|server|address|addr|serveur|servidor",
        "card": "card|visa|karte|carte|tarjeta|pay", "phone": "phone|tel|call|fax|mobile|cell|anruf|tfno|appel"}
AGAINST = "order|invoice|isbn|version|id|no|nr|part|serial|page|chapter|section|commande|pedido"
TOP_DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|example|test"
LABELERS = 5
_MARK = "\x01"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string is a multiple of ten."""
    n = F.char_length(digits)
    each = F.transform(F.split(digits, ""), lambda d, i: F.when(
        (n - i) % 2 == 1, F.try_to_number(d, F.lit("9")).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.try_to_number(d, F.lit("9")).cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _exact(pattern: Column, match: Column) -> Column:
    """Whether a marked match passes the checks of its exact kind."""
    d = _digits(match)
    size = F.char_length(d)
    parts = F.split(match, r"\.")
    return (F.when(pattern == "email", F.lit(True))
             .when(pattern == "ip", F.forall(parts, lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))
             .when(pattern == "card", F.when(size.between(16, 19), _luhn(d)).otherwise(F.lit(False)))
             .when(pattern == "phone", size.between(8, 15)).otherwise(F.lit(False)))


def matches(docs: DataFrame) -> DataFrame:
    """One row per marked match: doc_id, th (hash of the text), pattern, start, end, hit, left, right, exact."""
    text = F.translate(F.coalesce("text", F.lit("")), _MARK, "\x02")
    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), text.alias("text"))
    marked = [F.struct(F.lit(k).alias("pattern"), F.split(F.regexp_replace("text", p, f"{_MARK}$0{_MARK}"), _MARK).alias("parts"))
              for k, p in PATTERNS.items()]
    rows = base.select("doc_id", "th", F.explode(F.array(*marked)).alias("m")).select("doc_id", "th", "m.*").filter(F.size("parts") > 1)
    at = F.transform(F.sequence(F.lit(2), F.size("parts") - 1, F.lit(2)), lambda i: F.struct(
        i.alias("i"), F.element_at("parts", i).alias("hit"), F.char_length(F.element_at("parts", i - 1)).alias("gap"),
        F.right(F.element_at("parts", i - 1), F.lit(32)).alias("left"), F.left(F.element_at("parts", i + 1), F.lit(16)).alias("right")))
    rows = rows.select("doc_id", "th", "pattern", F.explode(at).alias("x")).select("doc_id", "th", "pattern", "x.*")
    rows = rows.dropDuplicates(["doc_id", "th", "pattern", "i"])  # repeated rows
    size = F.char_length("hit")
    order = Window.partitionBy("doc_id", "th", "pattern").orderBy("i")
    end = F.sum(F.col("gap") + size).over(order)
    out = rows.select("doc_id", "th", "pattern", (end - size).alias("start"), end.alias("end"), "hit", "left", "right")
    loose = F.col("pattern").isin("email_words", "phone_local")
    return out.withColumn("exact", _exact(F.col("pattern"), F.col("hit"))).filter(F.col("exact") | loose)


def votes(found: DataFrame) -> DataFrame:
    """Adds kind, shape, word (the one before) and the labelers' votes v0..v4 (1, 0 abstain, -1)."""
    kind = F.regexp_extract("pattern", "^[a-z]+", 0)
    left, right = F.lower("left"), F.lower("right")
    d = F.char_length(_digits(F.col("hit")))
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = cue | ((F.col("kind") == k) & left.rlike(rf"\b(?:{words})"))
    gazetteer = F.when(F.col("kind") == "email", F.when(F.lower("hit").rlike(rf"(?:{TOP_DOMAINS})$"), 1).otherwise(0)) \
                 .when(F.col("kind") == "phone", F.when(F.col("hit").rlike(r"^(?:\+[1-9]|\(|0|555)"), 1).otherwise(0)) \
                 .when(F.col("kind") == "ip", F.when(F.col("hit").rlike(r"^(?:10|127|172|192)\."), 1).otherwise(0)) \
                 .otherwise(F.when(F.col("hit").rlike("^[3-6]"), 1).otherwise(-1))
    even = F.when(F.col("kind") == "email", F.when(F.char_length("hit") <= 64, 1).otherwise(-1)) \
            .when(F.col("kind") == "phone", F.when(d.between(9, 13), 1).otherwise(-1)) \
            .otherwise(F.when(right.rlike("^[0-9]"), -1).otherwise(1))
    shape = F.substring(F.regexp_replace(F.regexp_replace(F.regexp_replace("hit", "[A-Za-z]+", "a"), "[0-9]+", "9"), "(a9|9a)[a9]*", "w"), 1, 12)
    word = F.regexp_extract(left, r"([^\s]+)\s*$", 1)
    return (found.withColumn("kind", kind).withColumn("shape", F.pmod(F.xxhash64(shape), F.lit(64)))
                 .withColumn("word", F.pmod(F.xxhash64(word), F.lit(64)))
                 .withColumns({"v0": F.when(F.col("exact"), 1).otherwise(0), "v1": gazetteer,
                               "v2": F.when(cue, 1).otherwise(0),
                               "v3": F.when(left.rlike(rf"\b(?:{AGAINST})[\s.:#]*$"), -1).otherwise(0), "v4": even}))


def reliabilities(counts: list, rounds: int = 50) -> dict:
    """EM over (kind, votes) counts: pattern -> probability that a span is personal data.

    Each labeler has, per kind and truth, its rates of voting 1, 0 and -1 (smoothed towards
    labelers that are right); the share of true spans is estimated per kind.
    """
    out = {}
    for kind in {r["kind"] for r in counts}:
        rows = [(tuple(r[f"v{i}"] for i in range(LABELERS)), r["n"]) for r in counts if r["kind"] == kind]
        share, rate = 0.5, [{(v, t): {(1, 1): 0.6, (-1, 1): 0.05, (1, 0): 0.1, (-1, 0): 0.5}.get((v, t), 0.35)
                             for v in (-1, 0, 1) for t in (0, 1)} for _ in range(LABELERS)]
        post = {}
        for _ in range(rounds):
            for v, _ in rows:
                a = math.log(share) + sum(math.log(rate[i][x, 1]) for i, x in enumerate(v))
                b = math.log(1 - share) + sum(math.log(rate[i][x, 0]) for i, x in enumerate(v))
                post[v] = 1 / (1 + math.exp(max(-50.0, min(50.0, b - a))))
            mass = {t: sum(n * (post[v] if t else 1 - post[v]) for v, n in rows) for t in (0, 1)}
            share = (mass[1] + 1) / (mass[0] + mass[1] + 2)
            for i in range(LABELERS):
                for t in (0, 1):
                    for x in (-1, 0, 1):
                        prior = 2.0 * (x == (1 if t else -1)) + 0.5
                        got = sum(n * (post[v] if t else 1 - post[v]) for v, n in rows if v[i] == x)
                        rate[i][x, t] = (got + prior) / (mass[t] + 3.5)
        out.update({f"{kind}:" + ",".join(map(str, v)): p for v, p in post.items()})
    return out


def _lookup(table: dict, key: Column, default: float) -> Column:
    if not table:
        return F.lit(default)
    pairs = chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in sorted(table.items()))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def classified(docs: DataFrame) -> DataFrame:
    """Every span kept: doc_id, th, kind, start, end, exact, probability."""
    found = settled(votes(matches(docs)).select("doc_id", "th", "kind", "start", "end", "exact", "shape", "word",
                                                F.concat_ws(",", *[f"v{i}" for i in range(LABELERS)]).alias("votes")))
    counts = [{"kind": r.kind, "n": r.n} | {f"v{i}": int(v) for i, v in enumerate(r.votes.split(","))}
              for r in found.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()]
    post = _lookup(reliabilities(counts), F.concat_ws(":", "kind", "votes"), 0.5)
    soft = found.withColumn("p", post)
    odds = {}
    for feature in ("shape", "word"):  # at most 64 buckets a kind
        sums = soft.groupBy("kind", feature).agg(F.sum("p").alias("a"), F.sum(1 - F.col("p")).alias("b")).collect()
        total = {k: (sum(r.a for r in sums if r.kind == k), sum(r.b for r in sums if r.kind == k)) for k in KINDS}
        odds[feature] = {f"{r.kind}:{r[feature]}": math.log((r.a + 1) / (total[r.kind][0] + 64)) - math.log((r.b + 1) / (total[r.kind][1] + 64))
                         for r in sums}
    logit = F.log(F.col("p") + 1e-6) - F.log(1 - F.col("p") + 1e-6)
    for feature, table in odds.items():
        logit = logit + _lookup(table, F.concat_ws(":", "kind", feature), 0.0)
    soft = soft.withColumn("probability", 1 / (1 + F.exp(-logit)))
    doc = Window.partitionBy("doc_id", "th").orderBy("start", "end")
    before = F.max(F.when(F.col("exact"), F.col("end"))).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("exact"), F.col("start"))).over(doc.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    return (soft.withColumn("free", free).filter(F.col("exact") | (F.col("free") & (F.col("probability") >= 0.5)))
                .select("doc_id", "th", "kind", "start", "end", "exact", "probability"))


def _joined(spans: str, only_exact: bool) -> Column:
    kept = F.filter(spans, lambda s: s["exact"]) if only_exact else F.col(spans)
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", F.element_at(names, s["k"]), s["start"], s["end"])), ",")


def _count(number: int) -> Column:
    return F.size(F.filter("all", lambda s: s["exact"] & (s["k"] == number))).cast("long")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    per_doc = classified(docs).groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_set(F.struct(number.alias("k"), "start", "end", "exact"))).alias("all")) \
        .select(F.col("doc_id").alias("_d"), F.col("th").alias("_th"), "all")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    out = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_th")), "left")
    spans = F.coalesce("all", F.array().cast("array<struct<k:int,start:bigint,end:bigint,exact:boolean>>"))
    out = out.withColumn("all", spans)
    counts = [_count(i).alias(f"n_{k}") for i, k in enumerate(KINDS, 1)]
    return out.select("doc_id", *counts, F.sha2(_joined("all", True), 256).alias("base_sha256"), _joined("all", False).alias("spans"))


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with every span found replaced by its kind in brackets; same rows and columns.

    Spans that overlap are replaced as one, named after the first.
    """
    doc = Window.partitionBy("doc_id", "th")
    by_start = doc.orderBy("start", "end", "kind")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    groups = (classified(docs).withColumn("new", F.when(F.coalesce(reach, F.lit(0)) <= F.col("start"), 1).otherwise(0))
                              .withColumn("group", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0))))
    merged = groups.groupBy("doc_id", "th", "group").agg(F.min(F.struct("start", "end", "kind")).alias("first"), F.max("end").alias("end"))
    merged = merged.withColumn("start", F.col("first.start")) \
                   .withColumn("from", F.coalesce(F.lag("end").over(doc.orderBy("start")), F.lit(0)))
    spans, last, doc_key, text_key = (fresh_name(docs, x) for x in ("spans", "last_end", "doc_key", "text_key"))
    per_doc = merged.groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "from", F.col("first.kind").alias("kind")))).alias(spans),
        F.max("end").alias(last)).select(F.col("doc_id").alias(doc_key), F.col("th").alias(text_key), spans, last)
    cond = docs["doc_id"].eqNullSafe(F.col(doc_key)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(text_key))
    rows = docs.join(per_doc, cond, "left")
    pieces = F.transform(spans, lambda s: F.concat(
        F.substring("text", (s["from"] + 1).cast("int"), (s["start"] - s["from"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    text = F.concat(F.array_join(pieces, ""), F.substring(F.col("text"), (F.col(last) + 1).cast("int"), F.char_length("text")))
    return rows.withColumn("text", F.when(F.col(last).isNull(), F.col("text")).otherwise(text)).select(*docs.columns)
