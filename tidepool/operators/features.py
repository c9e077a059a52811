"""TF-IDF in set form, term statistics, label encoding and the reproducible split.

TF-IDF follows the smooth-idf, L2-normalised definition: vocabulary = the ``k`` most frequent
non-stop-word terms of the corpus (ties: term order), idf = ln((1 + n) / (1 + df)) + 1,
weight = tf * idf / ||tf * idf||_2 per document.

Plan: one pass counts corpus term totals with partial aggregation and keeps the top ``k``
(TakeOrderedAndProject, bounded); a second pass keeps only vocabulary tokens (left-semi join
against the broadcast k-row vocabulary) before grouping by (doc, term), so the big shuffle only
moves vocabulary hits. Document frequencies (k rows) are broadcast back; the per-document L2 norm
is a window over at most k rows per document.
"""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing, text


@lru_cache(maxsize=1)
def stop_words() -> tuple[str, ...]:
    """Spark ML's default English stop-word list (saved copy, so SQL oracles can share it)."""
    path = os.path.join(os.path.dirname(text.__file__), "stopwords_english.txt")
    with open(path, encoding="utf-8") as fh:
        return tuple(w for w in fh.read().split("\n") if w)


def tokens(docs: DataFrame, doc: str = "doc_id", body: str = "text") -> DataFrame:
    """(doc, term) per word token, stop words removed."""
    t = docs.select(F.col(doc).alias("doc_id"), F.explode(text.word_tokens(F.col(body))).alias("term"))
    return t.filter(~F.col("term").isin(*stop_words()))


def term_stats(docs: DataFrame, doc: str = "doc_id", body: str = "text") -> DataFrame:
    """Per term: corpus occurrences and number of documents (rows) containing it.

    A row holds all tokens of its document, so its distinct terms are found inside the row: occurrences
    and documents are counted in one aggregation by term, and what is shuffled is a partial count per
    distinct term and task instead of a row per (document, term)."""
    rows = docs.select(text.word_tokens(F.col(body)).alias("words"))
    marked = F.array(F.struct(F.col("words").alias("terms"), F.lit(0).alias("first")),
                     F.struct(F.array_distinct("words").alias("terms"), F.lit(1).alias("first")))
    found = rows.select(F.explode(marked).alias("m")).select(F.explode("m.terms").alias("term"), F.col("m.first").alias("first"))
    return found.where(~F.col("term").isin(*stop_words())).groupBy("term").agg(
        F.count_if(F.col("first") == 0).alias("term_count"), F.count_if(F.col("first") == 1).alias("doc_freq"))


def vocabulary(docs: DataFrame, k: int = config.TFIDF_TERMS, doc: str = "doc_id",
               body: str = "text") -> DataFrame:
    """The k most frequent terms (ties broken by term)."""
    totals = tokens(docs, doc, body).groupBy("term").agg(F.count(F.lit(1)).alias("term_count"))
    top = totals.orderBy(F.col("term_count").desc(), F.col("term")).limit(k)
    return top


def document_frequency(docs: DataFrame, terms: list[str], doc: str = "doc_id",
                       body: str = "text") -> DataFrame:
    """(term, df) of the given terms (a bounded list)."""
    hits = tokens(docs, doc, body).where(F.col("term").isin(terms)).distinct()
    return hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf(docs: DataFrame, k: int = config.TFIDF_TERMS, doc: str = "doc_id",
          body: str = "text") -> DataFrame:
    """Long form (doc_id, term, weight) for documents with at least one vocabulary term."""
    vocab = F.broadcast(vocabulary(docs, k, doc, body).select("term"))  # at most k rows
    hits = tokens(docs, doc, body).join(vocab, "term", "left_semi")
    tf = hits.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df_.select("term", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df")))
                              + F.lit(1.0)).alias("idf"))
    w = tf.join(F.broadcast(idf), "term").select("doc_id", "term",
                                                 (F.col("tf") * F.col("idf")).alias("w"))
    # A document has at most k vocabulary rows, so a window per document is bounded.
    l2 = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", F.round(F.col("w") / l2, 6).alias("weight"))


def label_code(label) -> F.Column:
    expr = None
    for name, code in config.LABEL_CODES.items():
        expr = F.when(label == F.lit(name), F.lit(code)) if expr is None \
            else expr.when(label == F.lit(name), F.lit(code))
    return expr


def label_name(code) -> F.Column:
    expr = None
    for name, c in config.LABEL_CODES.items():
        expr = F.when(code == F.lit(c), F.lit(name)) if expr is None \
            else expr.when(code == F.lit(c), F.lit(name))
    return expr


def split_column(key, seed: int = config.SPLIT_SEED,
                 train_percent: int = config.TRAIN_PERCENT) -> F.Column:
    """'train' / 'test' from a keyed hash: independent of partitioning and row order."""
    bucket = hashing.md5_mod(F.concat(F.lit(f"{seed}:"), key.cast("string")), 100)
    return F.when(bucket < F.lit(train_percent), F.lit("train")).otherwise(F.lit("test"))
