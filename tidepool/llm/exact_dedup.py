"""Exact dedup by composable polynomial fingerprints.

A text (white-space runs made one space) is cut into byte chunks; every chunk gets two polynomial
hashes modulo 31-bit primes and the factor by which a hash to its left must be multiplied. Chunk
hashes of one document then combine by length-shifted arithmetic,
``H(xy) = H(x) * base^|y| + H(y)``, as a fold in the JVM, so the chunks of a huge document are
hashed by different tasks. Rows with equal fingerprint and length are compared with the row that
would stay, chunk by chunk, in a join; rows that differ (a hash collision) go to a further round.

Edge cases: a null text counts as empty, and all empty texts are one group; null ids sort last, so
a group with any id keeps the smallest one; of repeated rows exactly one is kept; an empty table
gives an empty result; further columns are carried unchanged.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import SPACE_RUN, materialize, packed_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 16
#: Texts of more bytes than this have their chunks dealt over all tasks before hashing.
SPREAD_BYTES = 1 << 22
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_019)

_HASH = "h1 bigint, h2 bigint, s1 bigint, s2 bigint"


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) <= n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n + 1]


def chunk_hash(data: bytes, tables) -> tuple[int, int, int, int]:
    """(hash, hash, shift, shift) of one chunk under the two moduli."""
    values = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(values)
    h = [int((values * t[n - 1::-1][:n]).sum() % p) if n else 0 for t, p in zip(tables, PRIMES)]
    return h[0], h[1], int(tables[0][n]), int(tables[1][n])


@lru_cache(maxsize=None)
def _chunk_hash_udf(chunk_bytes: int):
    @F.pandas_udf(_HASH)
    def hashed(chunks: pd.Series) -> pd.DataFrame:
        tables = [powers(b, p, chunk_bytes) for b, p in zip(BASES, PRIMES)]
        rows = [chunk_hash(c, tables) for c in chunks]
        return pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 4),
                            columns=["h1", "h2", "s1", "s2"])
    return hashed


def _normal(col: str):
    return F.regexp_replace(F.coalesce(F.col(col), F.lit("")), SPACE_RUN, " ")


def chunks(rows: DataFrame, text: str, uid: str, keep: Sequence[str], chunk_bytes: int) -> DataFrame:
    """One row per chunk of every normalised text (an empty text has one empty chunk)."""
    staged = rows.select(uid, *keep, F.encode(_normal(text), "UTF-8").alias("_b")) \
        .withColumn("_n", F.octet_length("_b").cast("bigint"))
    last = F.greatest(F.floor((F.col("_n") - 1) / chunk_bytes), F.lit(0))
    return staged.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"), last))) \
        .withColumn("_chunk", F.expr(f"substring(_b, int(_c * {chunk_bytes} + 1), {chunk_bytes})"))


def _fold(h: str, s: str, prime: int):
    return F.aggregate(F.col("_parts"), F.lit(0).cast("bigint"),
                       lambda acc, c: (acc * c[s] + c[h]) % F.lit(prime))


def fingerprints(rows: DataFrame, text: str, uid: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(uid, f1, f2, n_bytes, sha256) of every row's normalised text."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    sha = F.sha2(_normal(text), 256)
    small = rows.where(size <= SPREAD_BYTES).withColumn("_sha", sha)
    large = rows.where(size > SPREAD_BYTES).withColumn("_sha", sha)
    hashed = _chunk_hash_udf(chunk_bytes)(F.col("_chunk"))
    cols = [uid, "_sha", "_n", "_c"]
    parts = chunks(small, text, uid, ["_sha"], chunk_bytes).select(*cols, hashed.alias("_h"))
    spread = chunks(large, text, uid, ["_sha"], chunk_bytes).select(*cols, "_chunk") \
        .repartition(F.col(uid), F.col("_c")).select(*cols, hashed.alias("_h"))
    listed = parts.unionByName(spread).groupBy(uid, "_sha", "_n").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_c"), F.col("_h.*")))).alias("_parts"))
    return listed.select(uid, _fold("h1", "s1", PRIMES[0]).alias("f1"),
                         _fold("h2", "s2", PRIMES[1]).alias("f2"),
                         F.col("_n").alias("n_bytes"), F.col("_sha").alias("text_sha256"))


def unequal(rows: DataFrame, pairs: DataFrame, text: str, uid: str, chunk_bytes: int) -> DataFrame:
    """uids of ``pairs`` (uid, rep_uid) whose normalised text differs from the representative's."""
    own = chunks(rows.join(pairs, uid, "inner"), text, uid, ["rep_uid"], chunk_bytes) \
        .select(uid, "rep_uid", "_c", "_chunk")
    reps = pairs.select(F.col("rep_uid").alias(uid)).distinct()
    other = chunks(rows.join(reps, uid, "inner"), text, uid, [], chunk_bytes) \
        .select(F.col(uid).alias("rep_uid"), "_c", F.col("_chunk").alias("_rep_chunk"))
    return own.join(other, ["rep_uid", "_c"], "inner") \
        .where(F.col("_chunk") != F.col("_rep_chunk")).select(uid)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                carry: Sequence[str] | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``carry`` columns of every row (default: all) with ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256`` (of the normalised text). Carried columns called like these four, in any case,
    are replaced by them. See the module docstring for edge cases."""
    carry = list(docs.columns if carry is None else carry)
    # The operator's own columns live in a struct-free frame of fixed names, so clashing names
    # of further columns cannot reach them.
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("_uid"),
                                   F.col(doc_id).alias("_id"), F.col(text).alias("_text"),
                                   packed_row(c for c in carry if c != text)))
    source = rows.select("_uid", "_text")
    prints = fingerprints(source, "_text", "_uid", chunk_bytes)
    todo = materialize(prints.join(rows.select("_uid", "_id"), "_uid"))
    key = ["f1", "f2", "n_bytes"]
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_uid"))
    done = []
    while True:
        groups = materialize(todo.groupBy(*key).agg(F.min(first).alias("_keep"),
                                                    F.count(F.lit(1)).alias("_n_rows")))
        again = groups.where(F.col("_n_rows") > 1).select(*key, F.col("_keep._uid").alias("rep_uid"))
        pairs = materialize(todo.join(again, key, "inner")
                            .where(F.col("_uid") != F.col("rep_uid")).select("_uid", "rep_uid"))
        differ = materialize(unequal(source, pairs, "_text", "_uid", chunk_bytes).distinct())
        clean = differ.isEmpty()
        if clean:
            done.append(todo.join(groups, key, "inner"))
            break
        lost = differ.join(todo, "_uid", "inner")
        less = lost.groupBy(*key).agg(F.count(F.lit(1)).alias("_lost"))
        sized = groups.join(less, key, "left").withColumn(
            "_n_rows", F.col("_n_rows") - F.coalesce("_lost", F.lit(0))).drop("_lost")
        done.append(todo.join(differ, "_uid", "left_anti").join(sized, key, "inner"))
        todo = materialize(lost)
    verdict = done[0]
    for more in done[1:]:
        verdict = verdict.unionByName(more)
    verdict = verdict.select("_uid", F.col("_keep._id").alias("keep_id"),
                             F.col("_n_rows").alias("group_size"),
                             (F.col("_uid") == F.col("_keep._uid")).alias("kept"), "text_sha256")
    wanted = [F.col("_text").alias(c) if c == text else F.col("_row").getField(c).alias(c)
              for c in carry if c.lower() not in verdict.columns]
    return rows.join(verdict, "_uid", "inner").select(
        *wanted, "keep_id", "group_size", "kept", "text_sha256")
