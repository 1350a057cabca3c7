"""Naive Bayes against its formula, broadcast and joined by word."""

import math
import re

from quarry.operators import classify


def test_naive_bayes_scores_repeated_and_wordless_rows(spark, monkeypatch):
    train = spark.createDataFrame([(1, "a a b", 0), (2, "b c", 1), (3, "", 1)], "doc_id int, text string, label int")
    docs = spark.createDataFrame([(1, "a a z"), (2, "c"), (2, "b"), (3, None), (4, " "), (None, "a a a")], "doc_id int, text string")
    lp = {0: {"a": 3 / 6, "b": 2 / 6, "c": 1 / 6}, 1: {"a": 1 / 5, "b": 2 / 5, "c": 2 / 5}}
    prior = {0: 1 / 3, 1: 2 / 3}

    def share(words, rows):
        each = {k: prior[k] * math.prod(lp[k].get(w, 1.0) for w in words) for k in (0, 1)}
        best = max(each, key=each.get)
        return best, round(each[best] / sum(each.values()) / rows, 9)
    want = {1: share("aaz", 1), 2: share("cb", 2), 3: share("", 1), 4: share("", 1), None: share("", 1)}
    for most in (classify.NB_BROADCAST_BYTES, 0):
        monkeypatch.setattr(classify, "NB_BROADCAST_BYTES", most)
        scored = classify.nb_predict(docs, classify.nb_train(train))
        assert {r.doc_id: (r.pred, round(r.score, 9)) for r in scored.collect()} == want
        if most:  # one shuffle of the scored documents: a row a document and task
            plan = scored._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(doc_id" in plan and not re.search(r"hashpartitioning\(doc_id#\d+, word", plan)
