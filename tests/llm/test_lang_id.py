import random

import numpy as np

from quarry.llm import lang_id as L

SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy_and_odd_texts(spark):
    rnd = random.Random(1)
    words = {"aa": ["der", "und", "schön", "nicht"], "bb": ["the", "and", "with", "this"], "cc": ["que", "los", "año", "para"]}
    rows = [(i, " ".join(rnd.choice(words[k]) for _ in range(12)), k, "") for i in range(240) for k in [rnd.choice(sorted(words))]]
    rows += [(900, None, "aa", ""), (901, "", None, ""), (902, "123 ...", "bb", ""), (903, "the " * 400000, None, ""), (None, "und der", None, ""),
             (5, rows[5][1], rows[5][2], "again")]
    got = L.identify(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    by = got.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by.lang_pred[900] == by.lang_pred[901] == by.lang_pred[902] == "und" and by.lang_pred[903] == "bb"
    held = [r for r in rows[:240] if by.held_out[r[0]]]
    assert len(held) > 30 and np.mean([by.lang_pred[r[0]] == r[2] for r in held]) == 1
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0


def test_filter_returns_every_language_of_a_gram(spark):
    rows = [(i, t, k, "") for i, (t, k) in enumerate([("abc abd", "x"), ("abc xyz", "y"), ("qqq", "z")] * 5)]
    m = L.train(spark.createDataFrame(rows, SCHEMA), slots=4096)
    for text, want in (("abc", {"x", "y"}), ("qqq", {"z"}), ("xyz", {"y"})):
        g = L.trigrams(text)[1:2]
        mask = np.bitwise_and.reduce([m["table"][s, 0] for s in L._slots(g, 4096, 3)])
        assert want <= {l for i, l in enumerate(m["langs"]) if mask[0] >> i & 1}
