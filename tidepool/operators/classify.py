"""Text classifier (Spark ML) and its evaluation metrics.

Pipeline: word tokens -> stop words -> top-100 term counts -> smooth IDF weights
ln((1 + n) / (1 + df)) + 1 -> L2 norm -> decision tree (depth 10, seed 42). Vocabulary and document
frequencies are the ``tfidf`` query's, over all labelled rows (before the split); they come back as
at most 100 rows. The tree bins continuous features, so the model agrees with
the reference's statistically (accuracy), not split by split.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer, RegexTokenizer,
                                StopWordsRemover)
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions.text import WORD_TOKEN
from tidepool.operators import features


def featurizer(corpus: DataFrame, text_col: str = "text") -> PipelineModel:
    """Text -> ``features``: L2-normalised TF-IDF over the corpus' most frequent terms."""
    rows = corpus.select(F.monotonically_increasing_id().alias("doc_id"), F.col(text_col).alias("text"))
    vocab = [r["term"] for r in features.vocabulary(rows).collect()]
    found = {r["term"]: r["df"] for r in features.document_frequency(rows, vocab).collect()}
    n = corpus.count()
    idf = Vectors.dense([math.log((1.0 + n) / (1.0 + found[t])) + 1.0 for t in vocab])
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=WORD_TOKEN, gaps=False,
                         toLowercase=True, minTokenLength=2)
    stop = StopWordsRemover(inputCol="_tokens", outputCol="_terms",
                            stopWords=list(features.stop_words()))
    count = CountVectorizerModel.from_vocabulary(vocab, inputCol="_terms", outputCol="_tf")
    weigh = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
    return PipelineModel(stages=[tok, stop, count, weigh, norm])


def fit(train: DataFrame, text_col: str = "text", label_col: str = "label_code",
        corpus: DataFrame | None = None) -> PipelineModel:
    """Tree on ``train``; features from ``corpus`` (all labelled rows; default: ``train``). The
    text is tokenised once, into a cached 100-wide vector per row."""
    front = featurizer(train if corpus is None else corpus, text_col)
    ready = front.transform(train).select("features", label_col).persist()
    try:
        tree = DecisionTreeClassifier(featuresCol="features", labelCol=label_col,
                                      maxDepth=config.TREE_DEPTH, seed=config.SPLIT_SEED,
                                      impurity="gini").fit(ready)
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*front.stages, tree])


def feature_rows(front: PipelineModel, docs: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """(doc_id, term, weight) of the non-zero features the tree sees."""
    vocab = F.array(*[F.lit(t) for t in front.stages[2].vocabulary])
    flat = front.transform(docs).select(doc_col, F.posexplode(vector_to_array("features")).alias("i", "w"))
    return flat.where(F.col("w") != 0).select(
        F.col(doc_col).alias("doc_id"), F.element_at(vocab, F.col("i") + 1).alias("term"),
        F.round("w", 6).alias("weight"))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds predicted_label (name) and confidence (probability of the chosen class)."""
    out = model.transform(df)
    return (out.withColumn("predicted_label", features.label_name(F.col("prediction").cast("int")))
            .withColumn("confidence", F.array_max(vector_to_array(F.col("probability"))))
            .drop("_tokens", "_terms", "_tf", "_tfidf", "features", "rawPrediction",
                  "probability", "prediction"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "predicted_label",
             by: str | None = "split") -> DataFrame:
    keys = [by] if by else []
    hit = F.coalesce((F.col(label) == F.col(prediction)).cast("double"), F.lit(0.0))
    return pred.groupBy(*keys).agg(F.round(F.avg(hit), 6).alias("accuracy"),
                                   F.count(F.lit(1)).alias("support"))


def classification_report(pred: DataFrame, label: str = "label",
                          prediction: str = "predicted_label") -> DataFrame:
    """Per class precision / recall / F1 / support, plus accuracy, macro and weighted averages."""
    classes = list(config.LABEL_CODES)
    conf = pred.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    per = conf.groupBy().agg(*[
        agg for c in classes for agg in (
            F.sum(F.when((F.col("y") == c) & (F.col("p") == c), F.col("n")).otherwise(0)).alias(f"tp_{c}"),
            F.sum(F.when(F.col("p") == c, F.col("n")).otherwise(0)).alias(f"pp_{c}"),
            F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)).alias(f"sup_{c}"))
    ], F.sum("n").alias("total"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n"))
                                       .otherwise(0)).alias("correct"))
    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    one = per.select("*", *[col for c in classes for col in (
        ratio(F.col(f"tp_{c}"), F.col(f"pp_{c}")).alias(f"prec_{c}"),
        ratio(F.col(f"tp_{c}"), F.col(f"sup_{c}")).alias(f"rec_{c}"))])
    one = one.select("*", *[ratio(F.lit(2.0) * F.col(f"prec_{c}") * F.col(f"rec_{c}"),
                                  F.col(f"prec_{c}") + F.col(f"rec_{c}")).alias(f"f1_{c}") for c in classes])
    total = " + ".join(f"sup_{c}" for c in classes)
    mean = {m: f"({' + '.join(f'{m}_{c}' for c in classes)}) / {len(classes)}" for m in ("prec", "rec", "f1")}
    wide = {m: f"({' + '.join(f'{m}_{c} * sup_{c}' for c in classes)}) / nullif({total}, 0)" for m in mean}
    items = [f"'{c}', prec_{c}, rec_{c}, f1_{c}, double(sup_{c})" for c in classes]
    items += ["'accuracy', double(null), double(null), double(correct) / total, double(total)",
              f"'macro avg', {mean['prec']}, {mean['rec']}, {mean['f1']}, double({total})",
              f"'weighted avg', {wide['prec']}, {wide['rec']}, {wide['f1']}, double({total})"]
    out = one.selectExpr(f"stack({len(items)}, {', '.join(items)}) as (class, precision, recall, f1, support)")
    return out.select("class", *[F.round(F.col(c), 6).alias(c)
                                 for c in ("precision", "recall", "f1", "support")])
