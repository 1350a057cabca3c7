"""M5: the low-rank text classifier against dense formulas, the MLlib pipeline and odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import lowrank
from tests.conftest import SF001


def test_gradients_equal_the_derivative_of_the_dense_loss(spark):
    buckets, dim = 64, 5
    texts = [("a", "red green red"), ("b", "blue"), ("a", ""), ("c", "green blue blue red sky"), ("b", None), ("b", "blue")]
    df = spark.createDataFrame([(t, y) for y, t in texts], "text string, label string")
    rows = df.select((F.ascii("label") - ord("a")).cast("int").alias("y"), lowrank.feature_buckets("text", buckets).alias("x"))
    got = rows.collect()
    assert [len(r.x) for r in got] == [5, 1, 0, 9, 0, 1]      # words and the pairs between them
    x, y = np.zeros((len(got), buckets)), np.array([r.y for r in got])
    for i, r in enumerate(got):
        for b in r.x:
            x[i, b] += 1 / len(r.x)
    rng = np.random.default_rng(1)
    e, w = rng.standard_normal((buckets, dim)), rng.standard_normal((dim, 3))

    def loss(e, w):
        z = x @ e @ w
        return (np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]).sum()

    sums, total = lowrank.gradient_sums(rows, e @ w)
    assert abs(total - loss(e, w)) < 1e-9
    by_e, by_w, h = sums @ w.T, e.T @ sums, 1e-6
    for b, d in [(got[0].x[0], 0), (got[1].x[0], 3), (got[3].x[4], 4)]:
        up = e.copy()
        up[b, d] += h
        assert abs((loss(up, w) - loss(e, w)) / h - by_e[b, d]) < 1e-4
    for d, k in [(0, 0), (4, 2)]:
        up = w.copy()
        up[d, k] += h
        assert abs((loss(e, up) - loss(e, w)) / h - by_w[d, k]) < 1e-4


def test_held_out_accuracy_is_that_of_the_mllib_pipeline_at_least(spark):
    from quarry.operators.classify import predict_labels, quality_pipeline
    from quarry.sources import tables
    lab = tables.labels(spark, SF001.replace("0.001", "0.01")).select("doc_id", F.col("quality").cast("string").alias("label"))
    d = lab.join(tables.documents(spark, SF001.replace("0.001", "0.01")).select("doc_id", "text"), "doc_id")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 0
    fit, test = d.filter(~held).cache(), d.filter(held).cache()
    model = lowrank.train(fit)
    assert model.losses[-1] < 0.5 * model.losses[0]
    ours = lowrank.predict(test, model).join(test, "doc_id").agg(F.avg((F.col("pred") == F.col("label")).cast("int"))).first()[0]
    theirs = predict_labels(quality_pipeline().fit(fit), test).agg(F.avg((F.col("pred.label") == F.col("label")).cast("int"))).first()[0]
    assert ours >= theirs - 1e-12, (ours, theirs)


def test_order_of_words_is_seen(spark):
    """Two classes with the same words in another order differ by their bigrams alone."""
    rows = [(i, "up", f"w{i % 7} big small") for i in range(60)] + [(100 + i, "down", f"w{i % 7} small big") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, label string, text string")
    model = lowrank.train(df, dim=8, buckets=1 << 12)
    got = lowrank.predict(df, model).join(df, "doc_id")
    assert got.filter("pred = label and score > 0.8").count() == 120


def test_odd_rows(spark):
    rows = [(1, "b", "yes yes"), (2, "a", "no"), (3, None, "no no"), (4, "b", None), (5, "a", ""), (6, "a", "no"), (6, "a", "no")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, label string, text string, y int, x string")
    model = lowrank.train(df, dim=4, buckets=256, rounds=30)
    assert model.labels == ["a", "b"]
    long = spark.createDataFrame([(7, "yes " * 400_000, 0, "")], "doc_id long, text string, y int, x string")
    got = {r.doc_id: r for r in lowrank.predict(df.drop("label").unionByName(long), model).collect()}
    assert got[4].pred == got[5].pred == "a" and got[4].score == got[5].score == 0.5
    assert (got[1].pred, got[2].pred, got[7].pred) == ("b", "a", "b")
    assert lowrank.predict(df.limit(0), model).count() == 0
    only = lowrank.train(df.filter("label = 'a'"), dim=4, buckets=256, rounds=2)
    assert {r.score for r in lowrank.predict(df, only).collect()} == {1.0}
    with pytest.raises(ValueError):
        lowrank.train(df.limit(0))


def test_blocks_hold_every_row_and_feature(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(3)), [int(b) for b in rng.integers(0, 300, n)]) for n in [0, 0, 5, 40, 0, 7, 8, 9, 100, 1, 0]]
    df = spark.createDataFrame(rows, "y int, x array<int>").coalesce(1)
    table = rng.standard_normal((300, 3))
    want = lowrank.gradient_sums(df, table)
    blocks = lowrank.packed(df, 300)
    assert blocks.columns == ["y", "size", "x"] and blocks.count() == 1       # bytes, no array a text
    flat, size = np.concatenate([x for _, x in rows]).astype(int), np.array([len(x) for _, x in rows])
    monkeypatch.setattr(lowrank, "BLOCK", 10)
    cut = [*lowrank._blocks(flat, size)]
    assert len(cut) > 3
    assert np.concatenate([np.arange(len(size))[r] for r, _ in cut]).tolist() == list(range(len(size)))
    assert np.concatenate([flat[f] for _, f in cut]).tolist() == flat.tolist()
    assert [size[r].sum() for r, _ in cut] == [len(flat[f]) for _, f in cut]
    wide = np.vstack([table, np.zeros((70_000, 3))])                          # more buckets than two bytes name
    got = lowrank.gradient_sums(lowrank.packed(df, len(wide)), wide)
    assert np.allclose(got[0][:300], want[0], atol=1e-12) and not got[0][300:].any() and abs(got[1] - want[1]) < 1e-9
    assert lowrank.packed(df.limit(0), 300).count() == 0
