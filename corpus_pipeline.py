"""Corpus pipeline: toxicity filter, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. A stage's result is written as Parquet and read again by the next; when a
stage starts on such files, the scratch tables of the stage before it are removed, so scratch space
does not add up over the stages. (A result that is still to be read lazily must be handed to the
next stage itself, or be written first.)
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import curriculum, exact_dedup, packing, simhash, toxicity
from tidepool.llm.common import WORD, materialize, table
from tidepool.llm.queries import tokenizer_path
from tidepool.plans.joins import delete_paths, scratch_paths

#: Scratch tables of the last stage that ran, by Spark application and thread (of one run).
_LAST: dict[tuple[str, int], list[str]] = {}


def _run_key(spark: SparkSession) -> tuple[str, int]:
    return spark.sparkContext.applicationId, threading.get_ident()


def stage(fn):
    """Run a stage, removing the scratch of the one before unless ``docs`` still reads it."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = _run_key(spark)
        old, names = _LAST.get(key, []), [p.rsplit("/", 1)[-1] for p in _LAST.get(key, [])]
        reads = docs.inputFiles() if old else []
        still = any(f"/{n}/" in f for f in reads for n in names)
        if not still:
            delete_paths(spark, old)
        with scratch_paths() as paths:
            out = fn(spark, docs, sf_dir)
        _LAST[key] = paths + (old if still else [])
        return out
    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, carry=docs.columns, with_passages=False)
    return scored.where(F.col("predicted") == 0).select(*docs.columns)


@stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest id of each group of equal texts."""
    return exact_dedup.exact_dedup(docs).where("kept").select(*docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, at most 2 differing bits)."""
    return simhash.simhash_components(docs, words=3, limit=2).where("kept").select(*docs.columns)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per use of a document in the mix, in training order. The last use of a source may
    be cut to its first words."""
    uses = curriculum.training_order(curriculum.place(docs, carry=docs.columns))
    text = F.col("row.text")
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.col("use.words").cast("int"))
    cut = F.when(F.col("use.words") < F.col("size"), F.array_join(words, " ")).otherwise(text)
    out = uses.select("row", cut.alias("_text"))
    new = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("bigint")}
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


@stage
def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token documents with their ids and their place in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048, with_ids=True,
                        added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_documents),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _LAST.pop(_run_key(spark), None)  # an earlier run's result may still be read
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = materialize(step(spark, docs, sf_dir))
    packed = STAGES[-1][1](spark, docs, sf_dir)
    _LAST.pop(_run_key(spark), None)
    return packed
