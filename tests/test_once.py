"""Text metrics make each regex pass once; results as Python states them."""

import re

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import sampling
from quarry.operators.pii import mask_pii
from quarry.plans.wiki import process_articles

ODD = ["", " ", "\n", "word", " a\tb\x1c c\x85d e ", "\r\nx\r\n", "it's _ - 12 中文...\n...  \nz...", "a​b", None]


def passes(df, pattern):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(pattern, plan))


def test_every_count_is_made_once(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id int, text string")
    metrics = docs.select(T.gopher_metrics("text").alias("g")).select("g.*")
    assert passes(metrics, r"regexp_(?:replace|extract_all)\(") == 5
    lines = sampling.fasttext_lines(docs.withColumn("label", F.lit("x")), "label").select("line")
    assert passes(lines, r"regexp_replace\(") == 1
    ok = docs.select(T.filter_article("text").alias("ok"))
    assert passes(ok, r"regexp_extract\(") == 1 and passes(ok, r"regexp_replace\(") == 2
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_masks_are_made_once(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    text = "mail a.b@c.dd or 555-123-4567 from 10.0.0.1 $1"
    masked = mask_pii(spark.createDataFrame([(text,), ("plain",), (None,)], "text string"))
    assert passes(masked, r"regexp_(?:replace|extract_all)\(") == 6
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert [tuple(r) for r in masked.select("text", "n_email", "n_phone", "n_ip").collect()] == \
        [("mail |||EMAIL_ADDRESS||| or |||PHONE_NUMBER||| from |||IP_ADDRESS||| $1", 1, 1, 1), ("plain", 0, 0, 0), (None, None, None, None)]


def test_whitespace_as_python(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    got = docs.select("i", T.split_whitespace("t").alias("w"), T.py_strip("t").alias("s"), T.collapse_whitespace("t").alias("c"))
    for r in got.collect():
        t = ODD[r.i]
        assert (r.w, r.s, r.c) == ((None,) * 3 if t is None else (t.split(), t.strip(), " ".join(t.split())))


def test_masks_find_adjoining_addresses(spark):
    cases = {"a@b.cc_x@dd.ee": "||||||", "%a@b.cc@dd.ee": None, "x" * 50 + "@ab": None, "p.q@r.st..u@v.wx": None}
    pattern = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
    docs = spark.createDataFrame([(c,) for c in cases], "t string")
    for r in docs.select("t", T.mask_email("t").alias("m")).collect():
        assert (r.m.text, r.m.n) == re.subn(pattern, "|||EMAIL_ADDRESS|||", r.t)


def test_article_steps_pass_over_texts_without_markup(spark):
    text = "T\nAbc.\n12) one  two == head == {{x}} [[a|b]] ''q'' (中) (PINYIN: z)\n\n\n\nend\nNotes\nlost"
    got = process_articles(spark.createDataFrame([(text, "T"), (None, None)], "text string, title string"), min_length=1)
    assert [(r.cleaned, r.status) for r in got.orderBy(F.desc("title")).collect()] == \
        [("T\n\none two head b q \n\nend", "filtered"), ("", "too_short")]
