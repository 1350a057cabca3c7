"""Results that must not depend on partition, batch or file sizes."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.operators import sampling, tokenizer, windows
from quarry.operators.scoring import softmax
from quarry.sources import corpus, sinks


@pytest.fixture()
def tiny_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield spark
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ranks_offsets_and_caps_beyond_a_batch(tiny_batches):
    df = tiny_batches.range(60000).select(F.col("id").alias("doc_id"), F.array(F.lit(1), F.lit(2), F.lit(3)).alias("ids"))
    off = windows.doc_offsets(df, partitions=3)
    assert off.filter("offset != 3 * doc_id").count() == 0 and off.count() == 60000
    ranked = sampling.global_rank(df.select("doc_id"), "doc_id", partitions=3)
    assert ranked.filter("_rank != doc_id").count() == 0
    first = sampling.first_n(df, "doc_id", 1000)
    assert first.agg(F.count(F.lit(1)), F.max("doc_id")).first() == (1000, 999)
    assert sampling.first_n(df, "doc_id", 0).count() == 0
    two = df.withColumn("y", (F.col("doc_id") % 12 == 0).cast("int"))
    assert {r.y: r["count"] for r in sampling.balance_classes(two, "y", "doc_id").groupBy("y").count().collect()} == {0: 5000, 1: 5000}


def test_scan_order_follows_file_names_not_sizes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text": "first"}\n{"text": "second"}\n')
    (tmp_path / "b.json").write_text('{"text": "%s"}\n' % ("long " * 2000) * 3)
    got = corpus.read_news(spark, str(tmp_path), limit=2)
    assert [r.text for r in got.orderBy("ord").collect()] == ["first", "second"]
    assert corpus.read_news(spark, str(tmp_path)).count() == 5


def test_finished_wants_the_success_marker(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "part-0.parquet").write_text("broken")
    sinks.write_once(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3
    sinks.write_once(spark.range(9), out)
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(PySparkException):
        sinks.write_tokens(spark.createDataFrame([([1, 70000],)], "ids array<int>"), str(tmp_path / "tokens"), uint16=True)


def test_words_merge_by_rank(spark):
    rnd = random.Random(1)
    vocab = {bytes([b]): b for b in range(97, 101)}
    ranks = {}
    while len(ranks) < 25:
        a, b = rnd.choice(list(vocab)), rnd.choice(list(vocab))
        if len(a + b) < 6 and (a, b) not in ranks:
            ranks[a, b] = len(ranks)
            vocab.setdefault(a + b, 200 + len(vocab))

    def slow(word):
        if word in vocab:
            return [vocab[word]]
        parts = [word[i:i + 1] for i in range(len(word))]
        for _ in word:
            found = sorted((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks)
            if found:
                i = found[0][1]
                parts = parts[:i] + [parts[i] + parts[i + 1]] + parts[i + 2:]
        return [vocab[p] for p in parts]
    for _ in range(400):
        w = bytes(rnd.choice(b"abcd") for _ in range(rnd.randrange(1, 30)))
        assert tokenizer._bpe_word(w, ranks, vocab) == slow(w)


def test_unknown_ids_raise_and_softmax_is_linear(spark):
    model = tokenizer.BpeModel(vocab={104: b"h", 105: b"i"}, merges=[], specials=[], merge_ids=[])
    with pytest.raises(PySparkException):
        tokenizer.decode(spark.createDataFrame([(1, [104, 9999])], "doc_id long, ids array<int>"), model).collect()
    rows = spark.range(40).select(F.transform(F.sequence(F.lit(1), F.lit(16000)), lambda i: i / 16000.0).alias("z"))
    total = rows.select(F.aggregate(softmax("z"), F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(total[0] - 1) < 1e-9 and abs(total[1] - 1) < 1e-9
