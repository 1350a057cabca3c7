"""Line dedup and MinHash dedup on small fixtures with expected values written by hand."""

from quarry.operators import dedup


def test_line_dedup_fixture(spark):
    docs = [(1, "a\n\n\nb\nshared\n"), (2, "shared\nc\r\nd\re"), (3, ""), (4, "\n"), (5, "x\ny\nx")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in dedup.exact_line_dedup(df).collect()}
    # seen twice or more over all documents: "", "shared", "x"
    assert got == {1: "a\nb\n", 2: "c\nd\ne\n", 3: "", 4: "", 5: "y\n"}


def near_dup_fixture():
    base = "the quick brown fox jumps over the lazy dog while the cat sleeps on the warm mat today"
    a = base
    b = base.replace("today", "tonight")
    c = b.replace("warm", "cold").replace("quick", "slow")
    return [(0, a), (1, b), (2, c), (3, "Café, déjà vu!"), (4, "café deja vu"), (5, "tiny"), (6, "tiny"),
            (7, a), (8, "totally different words appear in this sentence for sure now")]


def test_minhash_removed_documents(spark):
    # 7 copies 0; 5 and 6 have no shingle and count as equal; 0 and 1 share 14 of 16 three-word
    # shingles (0.875), 1 and 2 share 11 of 19 (0.58); 3 and 4 keep their accents and differ.
    expected = {(20, 5, 3, 0.5): {1, 6, 7},      # 1 and 2 meet in no band of four rows
                (20, 20, 3, 0.5): {1, 2, 6, 7},  # but in one of single rows
                (20, 10, 2, 0.3): {1, 2, 6, 7},
                (12, 4, 3, 0.8): {1, 6, 7},
                (20, 5, 3, 0.0): {1, 6, 7}}
    df = spark.createDataFrame(near_dup_fixture(), "doc_id long, text string")
    for args, removed in expected.items():
        assert {r["doc_id"] for r in dedup.minhash_removed(df, *args).collect()} == removed, args


def test_minhash_parameter_errors(spark):
    import pytest
    df = spark.createDataFrame([(0, "a b c")], "doc_id long, text string")
    with pytest.raises(ValueError):
        dedup.minhash_removed(df, 4, 5, 2, 0.5)
    with pytest.raises(ValueError):
        dedup.minhash_removed(df, 4, 0, 2, 0.5)


def brute_removed(docs, k, bands, n, t):
    import hashlib
    sets, keys = {}, {}
    for d, text in docs:
        w = dedup.normalized_words(text.lower())
        grams = {" ".join(w[i:i + n]) for i in range(len(w) - n + 1)}
        sig = [min((hashlib.md5(f"{i}{g}".encode()).hexdigest() for g in grams), default="inf") for i in range(k)]
        r = k // bands
        sets[d], keys[d] = grams, [tuple(sig[b * r:b * r + r]) for b in range(bands)]
    out = set()
    for j in sets:
        for i in sets:
            if i < j and any(a == b for a, b in zip(keys[i], keys[j])):
                union = sets[i] | sets[j]
                if (len(sets[i] & sets[j]) / len(union) if union else 1.0) >= t:
                    out.add(j)
    return out


def test_residual_pass_equals_brute_force(spark):
    """Loose bands of single rows put many unlike documents into a bucket; chains and clusters hang off others than its leader."""
    import random
    rnd = random.Random(12)
    docs = []
    for d in range(160):
        if docs and rnd.random() < 0.5:
            w = rnd.choice(docs)[1].split()
            for _ in range(rnd.randrange(0, 4)):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(60)}"
        else:
            w = ["common"] + [f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(3, 16))]
        docs.append((d, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for args in ((2, 2, 1, 0.6), (6, 6, 2, 0.5), (3, 3, 1, 0.8), (4, 2, 1, 0.3)):
        want = brute_removed(docs, *args)
        assert len(want) > 10
        assert {r["doc_id"] for r in dedup.minhash_removed(df, *args).collect()} == want, args


def test_hot_bucket_of_unlike_documents_makes_no_pairs(spark):
    """400 documents of equal size share a bucket through one word; its prefixes are rare shingles only."""
    docs = [(d, " ".join(["common"] + [f"own{d}x{i}" for i in range(9)])) for d in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets = dedup.shingle_sets(df, 1)
    assert dedup.prefixes(sets, 0.8).count() == 0
    # with one like document per tenth of them: rows in proportion to documents, not to their square
    like = docs + [(400 + d, docs[d][1].replace(f"own{d}x0", "other")) for d in range(0, 400, 10)]
    df = spark.createDataFrame(like, "doc_id long, text string")
    assert dedup.prefixes(dedup.shingle_sets(df, 1), 0.8).count() <= 3 * 80
    assert {r["doc_id"] for r in dedup.minhash_removed(df, 12, 12, 1, 0.8).collect()} == {400 + d for d in range(0, 400, 10)}


def test_normalized_words():
    assert dedup.normalized_words("café, déjà «vu»! a_b c-d\x1ce\xa0f $3") == [
        "café", "déjà", "vu", "ab", "cd", "e", "f", "$3"]
    assert dedup.shingles(["a", "b", "a", "b"], 2) == [b"a b", b"b a"]
    assert dedup.shingles(["a"], 2) == []
