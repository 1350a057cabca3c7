"""M1: trigram vectors and the language pipeline against MLlib's own chain of tokenizer, n-grams and hashing."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, StringIndexer

from quarry.functions import trigrams
from quarry.operators.classify import TrigramCounts, language_pipeline, predict_labels


def chain(n):
    return [RegexTokenizer(inputCol="text", outputCol="_chars", pattern="", gaps=True, toLowercase=True),
            NGram(n=3, inputCol="_chars", outputCol="_tri"), HashingTF(inputCol="_tri", outputCol="_x", numFeatures=n)]


def texts():
    odd = ["", "a", "ab", "abc", " \t\n ", "The THE the", "a\0b\0c", "ÀÉÎ ß ŒUVRE", "ΟΔΟΣ ΣΑΣ", "α\"Σ 1Σ α:Σ ΑΣª", "İstanbul", "日本語 テキスト", "a日b", "x😀y😀😀", "😀", "é", "éa", "aé日é",
           "\ud7ff\ue000\uffff\u07ff\u0800", "the " * 3000, "né " * 3000]
    return odd + ["".join(chr(32 + (i * j * j + 7 * j) % 900) for j in range(i)) for i in range(120)]


@pytest.mark.parametrize("n", [1 << 16, 1000])
def test_vectors_equal_those_of_the_chain(spark, n):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts())], "doc_id long, text string").coalesce(1)
    theirs = {r.doc_id: r["_x"] for r in Pipeline(stages=chain(n)).fit(df).transform(df).collect()}
    ours = {r.doc_id: r["_x"] for r in TrigramCounts(inputCol="text", outputCol="_x", numFeatures=n).transform(df).collect()}
    assert ours == theirs and max(len(v.indices) for v in ours.values()) > 50


def test_pieces_and_long_texts(spark, monkeypatch):
    import pyarrow as pa
    batch = pa.array([x.lower() for x in texts()])
    whole = trigrams.trigram_vectors(batch, 1 << 16)
    monkeypatch.setattr(trigrams, "TEXT_STEP", 5)
    alone = pa.concat_arrays([trigrams.trigram_vectors(batch.slice(i, 1), 1 << 16) for i in range(len(batch))])
    assert whole.equals(alone) and len(trigrams.trigram_vectors(batch.slice(0, 0), 8)) == 0


def test_language_pipeline_makes_no_string_a_character_and_keeps_its_scores(spark, tmp_path):
    rows = [(i, ("en", "fr", "de")[i % 3], ("the cat and that hat ", "le chat était là ", "der Hund und das Täfelchen ")[i % 3] * (1 + i % 5) + "x" * i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    slow = Pipeline(stages=[StringIndexer(inputCol="lang", outputCol="_y", stringOrderType="alphabetAsc"), *chain(1 << 16),
                            NaiveBayes(featuresCol="_x", labelCol="_y", modelType="multinomial")])
    model = language_pipeline().fit(df)
    assert "_chars" not in model.transform(df).columns and "_tri" not in model.transform(df).columns
    theirs = {r.doc_id: r.pred for r in predict_labels(slow.fit(df), df).collect()}
    ours = {r.doc_id: r.pred for r in predict_labels(model, df).collect()}
    assert len(ours) == 60 and all(ours[i].label == theirs[i].label and abs(ours[i].score - theirs[i].score) < 1e-12 for i in ours)
    with pytest.raises(Exception, match="null"):
        language_pipeline().fit(df.unionByName(spark.createDataFrame([(99, "en", None)], df.schema)))
    with pytest.raises(Exception, match="NULL"):
        language_pipeline().fit(df.unionByName(spark.createDataFrame([(99, None, "a")], df.schema)))
