"""Corpus readers and sinks on files written by the test (S6-S10, S12, K2, K3, K7, K8) and small text columns."""

import gzip
import json
import os

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.sources import corpus, sinks


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def test_news_cap_opens_few_files(spark, tmp_path):
    """A cap of 10 on 200 files of 4 rows: four files are enough; files after them are not opened at all."""
    for i in range(200):
        rows = "".join(json.dumps({"text": f"{i:03d}-{k}"}) + "\n" for k in range(4))
        _write(f"{tmp_path}/n{i:03d}.json", rows)
    got = corpus.read_news(spark, str(tmp_path), limit=10)
    assert sorted(r.text for r in got.collect()) == [f"{i:03d}-{k}" for i in range(3) for k in range(4)][:10]
    assert len(got.inputFiles()) <= 4
    assert corpus.read_news(spark, str(tmp_path)).count() == 800
    assert corpus.read_news(spark, str(tmp_path), limit=5000).count() == 800
    assert corpus.read_news(spark, str(tmp_path), limit=0).count() == 0


def test_whole_files_and_lines(spark, tmp_path):
    _write(f"{tmp_path}/b.txt", "two\r\nlines")
    _write(f"{tmp_path}/a.txt", "one\n\nlast\n")
    _write(f"{tmp_path}/c.txt", "")
    files = {r.doc_id: (r.path.rsplit("/", 1)[1], r.text) for r in corpus.read_whole_files(spark, str(tmp_path)).collect()}
    assert files == {0: ("a.txt", "one\n\nlast\n"), 1: ("b.txt", "two\r\nlines")}  # an empty file gives no row
    lines = sorted((r.doc_id, r.line_no, r.line) for r in corpus.read_lines(spark, str(tmp_path)).collect())
    assert lines == [(0, 0, "one"), (0, 1, ""), (0, 2, "last"), (1, 0, "two"), (1, 1, "lines")]


def test_url_list(spark, tmp_path):
    with gzip.open(f"{tmp_path}/urls.txt.gz", "wt") as f:
        f.write(" http://a.org/x \nftp://b.org\nhttp://with blank.org\n\nhttps://c.org\n" + "http://" + "x" * 500 + "\n")
    assert sorted(r.url for r in corpus.read_url_list(spark, f"{tmp_path}/urls.txt.gz").collect()) == ["http://a.org/x", "https://c.org"]


def test_dialog_layouts(spark, tmp_path):
    for layout, split in zip(corpus.DIALOG_LAYOUTS, ("train", "validation", "test")):
        _write(f"{tmp_path}/one/{layout.format(split=split)}", f"{split} a __eou__ b __eou__\n")
    got = corpus.read_dialog_splits(spark, [f"{tmp_path}/none", f"{tmp_path}/one"])
    assert {r.split: r.line for r in got.collect()} == {s: f"{s} a __eou__ b __eou__" for s in ("train", "validation", "test")}
    _write(f"{tmp_path}/one/train/dialogues_train.txt", "second choice\n")
    assert corpus.read_dialog_splits(spark, [f"{tmp_path}/one"], ("train",)).first().line.startswith("train a")
    assert corpus.read_dialog_splits(spark, [f"{tmp_path}/none"]).count() == 0


def test_token_tables_from_several_folders(spark, tmp_path):
    a = spark.createDataFrame([(1, [1, 2])], "doc_id long, ids array<int>")
    sinks.write_tokens(a, f"{tmp_path}/a", uint16=True)
    sinks.write_tokens(a.withColumn("doc_id", F.lit(2).cast("long")), f"{tmp_path}/b")
    both = corpus.read_tokens(spark, f"{tmp_path}/a,{tmp_path}/b")
    assert sorted((r.doc_id, r.ids) for r in both.collect()) == [(1, [1, 2]), (2, [1, 2])]


def test_per_source_and_labelled_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "web"), (2, "y", "books/a"), (3, "z", "web")], "doc_id long, text string, source string")
    sinks.write_per_source(df, f"{tmp_path}/per")
    back = spark.read.parquet(f"{tmp_path}/per")
    assert sorted((r.doc_id, r.source) for r in back.collect()) == [(1, "web"), (2, "books/a"), (3, "web")]
    assert back.filter("source = 'web'").count() == 2
    lines = spark.createDataFrame([(f"__label__{i % 2} text {i}",) for i in range(20)], "line string")
    sinks.write_labelled(lines, f"{tmp_path}/one", shuffle_seed=3)
    sinks.write_labelled(lines.repartition(5), f"{tmp_path}/two", shuffle_seed=3)
    one, two = ([r.value for r in spark.read.text(f"{tmp_path}/{n}").collect()] for n in ("one", "two"))
    assert sorted(one) == sorted(r.line for r in lines.collect()) and sorted(one) == sorted(two)
    assert one != sorted(one)


def test_concat_and_preview(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    b = spark.createDataFrame([("c", 3)], "text string, doc_id long")
    out = sinks.concat_corpora(a, b)
    assert sorted((r.src_ord, r.doc_id, r.text) for r in out.collect()) == [(0, 1, "a"), (0, 2, "b"), (1, 3, "c")]
    assert [r.doc_id for r in sinks.preview(out, "doc_id", 2).collect()] == [1, 2]


def test_small_text_columns(spark):
    df = spark.createDataFrame([(1, "a\nb\r\nc"), (2, " \t\n"), (3, ""), (4, "x" * 600)], "k long, t string")
    got = {r.k: r for r in df.select("k", T.newline_to_space("t").alias("flat"), T.non_blank("t").alias("full"),
                                     T.snippet("t", "k", size=500).alias("cut")).collect()}
    assert got[1].flat == "a b\r c" and [got[k].full for k in (1, 2, 3, 4)] == [True, False, False, True]
    assert got[1].cut is None and got[4].cut == "x" * 500


def test_clean_generated_keeps_any_character(spark):
    cases = {"one. two\u0000three.\u0000 four ! five": "One. Two\u0000three.\u0000 four! Five.", "a\u0000b": "A\u0000b.",
             "I ' m here . ok ?": "I'm here. Ok?", "": "", "élan. été": "Élan. été."}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in df.select("t", T.clean_generated("t").alias("c")).collect()} == cases
