import hashlib
import itertools
import random
import re

import numpy as np

from quarry.llm import secret_scan as S

SCHEMA = "doc_id long, text string, found string, h long"


def plain(t):
    out = []
    pat = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [("assign", m.start(), m.end()) for m in re.finditer(pat, t) if len(m.group(2)) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


def made(n=300, seed=6):
    rnd = random.Random(seed)
    bits = ["password: hunter22", "API_KEY='abc/def=='", "token=abc", "ſecret=abcdef", "AKIA" + "Q7" * 8, "AKIAX", "é",
            "0123456789abcdef" * 2, "deadbeef", "word", "The words", "2024-01-01", "10.0.0.1", "x1y2z3", "apikey = \"k9\"", "secret:", "=", "\n"]
    return [" ".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 14))) for _ in range(n)]


def test_base_spans_and_additions(spark):
    texts = dict(enumerate(made()))
    texts.update({900: None, 901: "", 902: "a" * 300000, 903: "password:" + " " * 50000 + "x" * 9, 904: "x1y2z3 " * 20000})
    rows = [(i, t, "", 1) for i, t in texts.items()] + [(3, texts[3], "again", 1), (None, "AKIA" + "Z" * 20, "", 0)]
    got = S.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    order = (*S.KINDS, S.ADDED)
    for r in got:
        want = plain(texts[r.doc_id] or "") if r.doc_id is not None else [("access", 0, 24)]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w[0] == k for w in want) for k in S.KINDS]
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(want) <= set(spans) and spans == sorted(spans, key=lambda s: (s[1], order.index(s[0])))
        for k, a, b in spans:
            assert k != S.ADDED or not any(x < b and y > a for _, x, y in want)
    assert S.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_viterbi_is_the_best_of_all_taggings_and_the_fit_learns():
    rnd = np.random.default_rng(0)
    model = {"w": rnd.normal(size=(S.BUCKETS, 3)), "t": rnd.normal(size=(3, 3))}
    feats = rnd.integers(0, S.BUCKETS, (5, 4)).tolist()
    e = S._scores(model["w"], feats)

    def total(tags):
        return S.START[tags[0]] + sum(e[i, x] for i, x in enumerate(tags)) + sum(model["t"][a, b] for a, b in zip(tags, tags[1:]))
    assert tuple(S.viterbi(model, feats)) == max(itertools.product(range(3), repeat=5), key=total)
    data = [([[1, 2], [3, 4]], [1, 2]), ([[5, 6]], [0]), ([[1, 6]], [1])] * 30
    fitted = S.fit(data)
    assert all(S.viterbi(fitted, f) == t for f, t in data)


def test_training_takes_rare_matches_and_bounded_pieces(spark):
    rows = [(i, f"note {i} 10.0.0.{i} word", "", 1) for i in range(400)] + [(999, "password: hunter22 " + "x1y2z3 " * 5000, "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert S.train(df, fit_runs=2) is not None  # a share of 1 in 25 of the documents
    pieces = list(S._pieces("x1y2z3 " * 5000, True))
    assert sum(len(f) for f, _ in pieces) == 5000 and max(len(f) for f, _ in pieces) <= 2 * S._PIECE


def test_words_beside_a_cue_and_far_keywords_reach_the_field():
    def tokens(text):
        return [text[a:b] for run in S._runs(text) for a, b in run]
    assert tokens("pwd: CorrectHorse and words") == ["CorrectHorse"]
    assert tokens("pwd=CorrectHorse x1y2z3 pin 'abc'") == ["CorrectHorse", "x1y2z3", "abc"]
    assert tokens("id=x1y2z3 the words.") == ["id=x1y2z3"]
    assert S._file("x" * (1 << 20) + " password", [])[0] == "fkeyTrue"
    long = "ab1" * 200
    assert S._features(long, 0, 600, ()) != S._features(long[:300] + "Z" * 300, 0, 600, ())
