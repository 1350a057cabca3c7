"""M1-M7 classifiers: a closed-form multinomial Naive Bayes written as Spark
aggregations and joins (SQL-checkable), and MLlib pipelines for the
fastText-style supervised models (language id, quality, toxicity).

The reference ships pretrained fastText models; those cannot be reproduced,
so the operators match the label/score surface and the training recipe.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasNumFeatures, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import patterns as pt
from quarry.functions import text as T
from quarry.functions.trigrams import trigram_vectors
from quarry.session import reliable_checkpoint

# Broadcast the NB model only below this many bytes (words and a number per label); Spark decides beyond.
NB_BROADCAST_BYTES = 64 << 20


def nb_train(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label") -> dict:
    """Multinomial NB with add-one smoothing.

    Returns {"logp": (word, label, logp), "prior": (label, logprior),
    "labels": [...]}.  The label set is collected (bounded by the number of
    classes); the word table stays distributed.
    """
    labels = sorted(r[0] for r in df.select(label).distinct().collect())
    n_docs = df.groupBy(label).agg(F.count(F.lit(1)).alias("nd"))
    total = df.count()
    prior = n_docs.select(label, F.log(F.col("nd") / F.lit(total)).alias("logprior"))
    words = df.select(label, F.explode(T.split_whitespace(text)).alias("word"))
    wc = reliable_checkpoint(words.groupBy("word", label).agg(F.count(F.lit(1)).alias("c")))  # read four times
    class_tot = wc.groupBy(label).agg(F.sum("c").alias("tot"))
    vocab = wc.select("word").distinct()
    v, letters = vocab.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    grid = vocab.select("word", F.explode(F.array(*[F.lit(x) for x in labels])).alias(label))
    logp = (grid.join(wc, ["word", label], "left").join(F.broadcast(class_tot), label)
                .select("word", label,
                        F.log((F.coalesce(F.col("c"), F.lit(0)) + 1) / (F.col("tot") + F.lit(v))).alias("logp")))
    return {"logp": logp, "prior": prior, "labels": labels, "label": label, "bytes": (letters + 32 * v) * len(labels)}


def nb_predict(df: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pred, score): argmax class (ties to the smaller label), softmax prob.

    Words outside the training vocabulary are ignored.  A model of less than
    ``NB_BROADCAST_BYTES`` is broadcast, a row a word with a number per label:
    the words of a text then meet it in the scan's own tasks, and only a row a
    document and task is shuffled.  A larger one is joined by word, after the
    words were counted in each document.

    Rows that share a key are one text, whose share is divided by their
    number; a null key holds no words.
    """
    label, labels = model["label"], model["labels"]
    if not labels:
        return df.select(key, F.lit(None).cast(model["logp"].schema[label].dataType).alias("pred"), F.lit(0.0).alias("score")).limit(0)

    def by_label(value: str, name: str) -> list:
        return [F.max(F.when(F.col(label) == F.lit(x), F.col(value))).alias(f"{name}{i}") for i, x in enumerate(labels)]

    logp = model["logp"].groupBy("word").agg(*by_label("logp", "_lp"))
    words = df.select(F.col(key), F.posexplode_outer(T.split_whitespace(text)).alias("_pos", "word"))
    first = F.coalesce(F.col("_pos"), F.lit(0)) == 0  # once a row of df
    if model["bytes"] <= NB_BROADCAST_BYTES:
        logp = F.broadcast(logp)
        words = words.select(key, "word", F.lit(1).alias("_n"), first.cast("int").alias("_rows"))
    else:
        words = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("_n"), F.count_if(first).alias("_rows"))
    found = (words.join(logp, "word", "left").groupBy(key)
                  .agg(F.sum("_rows").alias("_rows"), *[F.sum(F.col("_n") * F.col(f"_lp{i}")).alias(f"_ll{i}") for i in range(len(labels))]))
    prior = model["prior"].agg(*by_label("logprior", "_p"))  # one row
    scores = F.array(*[F.when(F.col(key).isNotNull(), F.coalesce(F.col(f"_ll{i}"), F.lit(0.0))).otherwise(0.0) + F.col(f"_p{i}")
                       for i in range(len(labels))])
    g = found.crossJoin(F.broadcast(prior)).select(key, "_rows", scores.alias("all")).withColumn("best", F.array_max("all"))
    pred = F.element_at(F.array(*[F.lit(x) for x in labels]), F.array_position("all", F.col("best")).cast("int"))
    total = F.aggregate("all", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    return g.select(key, pred.alias("pred"), (F.lit(1.0) / (total * F.col("_rows"))).alias("score"))


# ---------------------------------------------------------------------------
# MLlib pipelines
# ---------------------------------------------------------------------------

def _tokenizer(text: str) -> RegexTokenizer:
    return RegexTokenizer(inputCol=text, outputCol="_tok", pattern=f"[{pt.PY_WS}]+", gaps=True,
                          toLowercase=False)


def quality_pipeline(text: str = "text", label: str = "label", num_features: int = 1 << 14,
                     max_iter: int = 25) -> Pipeline:
    """M5: words + word bigrams -> hashed counts -> multinomial logistic regression
    (the fastText recipe: supervised, wordNgrams=2, softmax loss)."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc"),
        _tokenizer(text),
        NGram(n=2, inputCol="_tok", outputCol="_bi"),
        HashingTF(inputCol="_tok", outputCol="_f1", numFeatures=num_features),
        HashingTF(inputCol="_bi", outputCol="_f2", numFeatures=num_features),
        VectorAssembler(inputCols=["_f1", "_f2"], outputCol="_x"),
        LogisticRegression(featuresCol="_x", labelCol="_y", family="multinomial", maxIter=max_iter,
                           regParam=1e-4),
    ])


class TrigramCounts(Transformer, HasInputCol, HasOutputCol, HasNumFeatures, DefaultParamsReadable, DefaultParamsWritable):
    """Hashed counts of the character trigrams of lower-cased texts: the vectors of RegexTokenizer (pattern ""),
    NGram(3) and HashingTF, without an array of strings a text.  A null text is an error, as it is there."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, numFeatures: int = 1 << 18):
        super().__init__()
        self._setDefault(numFeatures=1 << 18)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        n = self.getNumFeatures()
        vectors = F.arrow_udf(lambda texts: trigram_vectors(texts, n), VectorUDT())
        text = F.col(self.getInputCol())
        # Java's lower case, as the tokenizer's; F.lower has another rule for a sigma beside signs and digits.
        lower = F.when(text.isNotNull(), F.java_method(F.lit("org.apache.commons.lang3.StringUtils"), F.lit("lowerCase"), text))
        return df.withColumn(self.getOutputCol(), vectors(lower).alias(self.getOutputCol(), metadata={"ml_attr": {"num_attrs": n}}))


def language_pipeline(text: str = "text", label: str = "lang", num_features: int = 1 << 16) -> Pipeline:
    """M1: character trigram counts -> multinomial Naive Bayes."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc"),
        TrigramCounts(inputCol=text, outputCol="_x", numFeatures=num_features),
        NaiveBayes(featuresCol="_x", labelCol="_y", modelType="multinomial"),
    ])


def predict_labels(model: PipelineModel, df: DataFrame, prefix: str = "") -> DataFrame:
    """M6 ``classify_string``: top-1 label and its probability as struct<label, score>.

    Text is whitespace-collapsed first (P11), as the reference does before
    predicting.
    """
    indexer = model.stages[0]
    labels = list(indexer.labels)
    text_col = model.stages[1].getInputCol()
    scored = model.transform(df.withColumn(text_col, T.collapse_whitespace(text_col)))
    probs = vector_to_array("probability")
    best = F.array_position(probs, F.array_max(probs)) - 1
    lab = F.element_at(F.array(*[F.lit(x) for x in labels]), (best + 1).cast("int"))
    cols = [c for c in df.columns]
    return scored.select(*cols, F.struct(lab.alias("label"), F.array_max(probs).alias("score")).alias(prefix + "pred"))


def evaluate(pred: DataFrame, label: str, pred_col: str = "pred") -> DataFrame:
    """N, precision@1 and recall@1 (single label per row: both = accuracy)."""
    hit = (F.col(f"{pred_col}.label") == F.col(label).cast("string")).cast("double")
    return pred.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                    F.avg(hit).alias("precision_at_1"), F.avg(hit).alias("recall_at_1"))
