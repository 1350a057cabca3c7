import random

import numpy as np
import pytest

from quarry.llm import toxicity as X

SCHEMA = "doc_id long, text string, score double"
BAD, GOOD = ["idiot", "moron", "stupid"], ["garden", "window", "little", "yellow", "house", "summer"]


def corpus(n=200, seed=2):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(GOOD) for _ in range(30)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[7] = rnd.choice(BAD)
        rows.append((i, " ".join(words), None))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = corpus()
    extra = {900: "you 1d10t of a house", 901: "what a 5tup1d garden", 902: "window m o r o n summer",
             903: "iiiidiooot house", 904: "a little yellow house in summer", 905: None, 906: "",
             907: "garden " * 30000 + "stupid", 908: "12345 !!! 007", 909: "m.o.r.o.n!"}
    rows += [(k, v, 0.5) for k, v in extra.items()] + [(904, extra[904], 0.5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = X.toxicity(docs, spark.createDataFrame(labels + [(1, None), (77777, 1)], "doc_id long, toxic int"))
    return out.toPandas()


def test_restores_hidden_words_and_leaves_clean_ones(scored):
    by = scored.drop_duplicates("doc_id").set_index("doc_id").predicted
    assert all(by[[900, 901, 902, 903, 907, 909]] == 1)
    assert all(by[[904, 905, 906, 908]] == 0)
    assert len(scored) == 211 and scored.score.between(0, 1).all()
    held = scored[scored.held_out & (scored.doc_id < 200)]
    assert len(held) > 20 and (held.predicted == (held.doc_id % 4 == 0)).all()


def test_viterbi_equals_all_readings():
    rnd = np.random.default_rng(1)
    model = np.log(rnd.dirichlet(np.ones(28), (28, 28, 28))).astype(np.float32)

    def total(readings, costs):
        s, t = (0, 0, 0), sum(costs)
        for ch in "".join(readings) + " ":
            x = X._symbol_of(ch)
            if x or s[2] or ch == " ":
                t += model[s + (x,)]
                s = s[1:] + (x,)
        return t
    import itertools
    for token in ("1d10t", "a$$", "b00k!", "loooser"):
        ways = X._lattice(token, False)
        best = max(itertools.product(*ways), key=lambda p: total([o for o, _ in p], [c for _, c in p]))
        got = X.decode(token, model)
        options = [p for p in itertools.product(*ways) if "".join(o for o, _ in p) == got]
        assert max(total([o for o, _ in p], [c for _, c in p]) for p in options) == pytest.approx(
            total([o for o, _ in best], [c for _, c in best]), abs=1e-3)


def test_one_class_empty_table_and_pipeline_form(spark):
    docs = spark.createDataFrame([(1, "a b", 1.0), (2, None, None)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.toxicity(docs, none).count() == 2
    assert X.toxicity(docs.limit(0), none).count() == 0
    rows, labels = corpus()
    kept = X.drop_toxic(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == ["doc_id", "text", "score"]
    assert {r.doc_id for r in kept.collect()} == {i for i in range(200) if i % 4}


def test_spaced_letters_and_long_tokens_are_read_whole():
    texts = ["the garden of a little yellow house", "you idiot"] * 50
    into = np.zeros(X.SYMBOLS ** X.ORDER, np.int64)
    X._gram_counts(texts, into)
    c = into.reshape((X.SYMBOLS,) * X.ORDER) + 1e-3
    model = np.log(c / c.sum(-1, keepdims=True)).astype(np.float32)
    restore = X.Restorer(model)
    spaced = " ".join("thegardenofalittleyellowhouse" * 300 + "youidiot")
    assert "idiot" in restore.words(spaced)
    long = ",".join(["garden"] * 20 + ["1d10t"] + ["house"] * 20)
    assert "idiot" in restore.words(long) and "1d10t" not in restore.text(long)
    flush, X._FLUSH = X._FLUSH, 10**9
    try:
        assert restore.text(spaced) == X.decode(spaced, model, True)
        plain = X.decode(spaced, model, True)
    finally:
        X._FLUSH = flush
    X._FLUSH = 16
    try:
        assert X.decode(spaced, model, True) == plain
    finally:
        X._FLUSH = flush


def test_every_significant_word_is_known(spark):
    rnd = random.Random(5)
    names = ["".join(rnd.choice("bcdfghklmnprstvz") + rnd.choice("aeiou") for _ in range(4)) for _ in range(400)]
    names = sorted(set(names))[:300]
    rows, labels = [], []
    for i in range(3000):
        toxic = int(i % 2 == 0)
        words = [rnd.choice(GOOD) for _ in range(12)] + ([names[i // 2 % 300]] if toxic else [])
        rows.append((i, " ".join(words), None))
        labels.append((i, toxic))
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    for fit_rows in (10_000, 200):  # every word in the fitted rows; most words outside them
        trained = X.train(docs, known, fit_rows=fit_rows, least_g2=3.0)
        words = trained["words"]
        assert len(set(names) & set(words)) == len(names) and all(words[w] > 0 for w in names)


def test_sparse_fit_equals_newton_on_the_dense_matrix():
    rng = np.random.default_rng(3)
    x = (rng.random((80, 6)) < 0.3).astype(float)
    y = (rng.random(80) < 0.2 + 0.6 * x[:, 0]).astype(float)
    times = rng.integers(1, 4, 80).astype(float)
    w = X._fit(*np.nonzero(x), 6, y, times)
    full = np.hstack([x, np.ones((80, 1))])
    p = 1 / (1 + np.exp(-full @ w))
    assert np.abs(full.T @ ((p - y) * times) + np.r_[np.full(6, 0.02), 1e-6] * w).max() < 1e-5
