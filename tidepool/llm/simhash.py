"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints: word shingles, XXH64 with seed 42, one majority vote per bit. Distinct fingerprints
are range-partitioned by Gray rank into blocks of neighbours. Codes of one node share bits: the
node keeps the shared mask and pattern, an inner node only the bits its parent does not have yet.
A search adds up the differing shared bits on the way down and drops a node, with all codes below
it, once the sum exceeds the distance. The upper index (one node per block) routes every code to
the blocks it can have a partner in; each block is then searched by one task, which returns a
spanning forest of its links, so a dense group costs a row per code, never a row per pair.

Edge cases: a null text counts as empty; texts without words have fingerprint zero, linked like
any other; texts shorter than a shingle are one shingle; null ids are ignored as component ids
unless a component has no other (then null); an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import components, materialize, packed_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
HASH_SEED = 42
#: Codes aimed at per block of the index, and the fewest and most blocks. The upper index is
#: collected: one pattern, mask and number per block; beyond the most, blocks grow.
BLOCK_CODES = 1 << 16
MIN_BLOCKS = 64
MAX_BLOCKS = 1 << 17
FANOUT = 4
#: Shingles hashed, and (query, node) pairs held, at a time.
HASH_STEP = 1 << 16
QUERY_STEP = 2048


# ---------------------------------------------------------------- fingerprints

def simhash(text: bytes | None, words: int) -> int:
    """64-bit fingerprint of a UTF-8 text (A-Z lower-cased, words split at ASCII white space)."""
    from xxhash import xxh64_intdigest
    tokens = text.lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    n = max(1, len(tokens) - words + 1)
    starts = (ends - np.fromiter(map(len, tokens), np.int64, len(tokens)) - 1)[:n]
    stops = ends[min(words, len(tokens)) - 1:][:n] - 1
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASH_STEP):
        cut = map(slice, starts[at:at + HASH_STEP].tolist(), stops[at:at + HASH_STEP].tolist())
        m = min(HASH_STEP, n - at)
        codes = np.fromiter((xxh64_intdigest(joined[s], HASH_SEED) for s in cut), np.uint64, m)
        bits = np.unpackbits(codes.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(2 * votes > n, bitorder="little")
    return int(ones.view(np.int64)[0])


@lru_cache(maxsize=None)
def _simhash_udf(words: int):
    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, words) for t in texts], dtype="int64")
    return fingerprint


def fingerprint_col(text: str, words: int = SHINGLE_WORDS) -> Column:
    return _simhash_udf(words)(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))


def hex_col(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def gray_rank(fp: Column) -> Column:
    """Rank of a 64-bit code in Gray order, as a signed BIGINT of the same order."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-2**63).cast("bigint"))


# ---------------------------------------------------------------- the hierarchical index

def gray_order(codes: np.ndarray) -> np.ndarray:
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return np.argsort(rank, kind="stable")


def build_levels(pattern: np.ndarray, mask: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the given nodes (last) up to one root (first): (pattern, bits of its own)."""
    levels = [(pattern, mask)]
    while len(levels[0][0]) > 1:
        pat, msk = levels[0]
        at = np.arange(0, len(pat), FANOUT)
        all_and = np.bitwise_and.reduceat(pat & msk, at)
        all_or = np.bitwise_or.reduceat(pat & msk, at)
        shared = np.bitwise_and.reduceat(msk, at) & ~(all_and ^ all_or)
        levels.insert(0, (all_and & shared, shared))
    out = [levels[0]]
    for (_, above), (pat, msk) in zip(levels, levels[1:]):
        parent = np.repeat(above, FANOUT)[:len(pat)]
        out.append((pat, msk & ~parent))
    return out


def search(levels, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query index, node of the last level) pairs whose accumulated difference is within limit."""
    for at in range(0, len(queries), QUERY_STEP):
        q = queries[at:at + QUERY_STEP]
        qi, node = np.arange(len(q)), np.zeros(len(q), dtype=np.int64)
        diff = np.zeros(len(q), dtype=np.int64)
        for depth, (pattern, own) in enumerate(levels):
            if depth:
                child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                inside = child < len(pattern)
                qi, diff = np.repeat(qi, FANOUT)[inside], np.repeat(diff, FANOUT)[inside]
                node = child[inside]
            diff = diff + np.bitwise_count((q[qi] ^ pattern[node]) & own[node])
            keep = diff <= limit
            qi, node, diff = qi[keep], node[keep], diff[keep]
        yield qi + at, node


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least index connected to each of n nodes by the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if np.array_equal(before, label):
            return label
    return label


def _route(batches: Iterator[pa.RecordBatch], nodes, limit: int) -> Iterator[pa.RecordBatch]:
    """Send each code to every block at or after its own that can hold a partner."""
    number, pattern, mask = nodes
    levels = build_levels(pattern, mask)
    for batch in batches:
        codes = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        own = batch.column("block").to_numpy(zero_copy_only=False)
        for qi, node in search(levels, codes, limit):
            block = number[node]
            keep = block >= own[qi]
            qi, block = qi[keep], block[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(codes[qi].view(np.int64)), pa.array(block == own[qi])],
                ["block", "fp", "indexed"])


def _search_block(part: pd.DataFrame, limit: int) -> pd.DataFrame:
    """Links between the queries of one block and its codes, as a spanning forest."""
    fp = part["fp"].to_numpy().view(np.uint64)
    codes = fp[part["indexed"].to_numpy()]
    codes = codes[gray_order(codes)]
    levels = build_levels(codes, np.full(len(codes), ~np.uint64(0)))
    nodes, where = np.unique(fp, return_inverse=True)
    place = np.searchsorted(nodes, codes)
    label = np.arange(len(nodes))
    for qi, hit in search(levels, fp, limit):
        a, b = label[where[qi]], label[place[hit]]
        linked = a != b
        if linked.any():
            label = forest(a[linked], b[linked], len(nodes))[label]
    moved = label != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[moved].view(np.int64), "b": nodes[label[moved]].view(np.int64)})


def near_links(codes: DataFrame, limit: int = MAX_DISTANCE, block_codes: int = BLOCK_CODES) -> DataFrame:
    """Pairs (a, b) that connect exactly the distinct codes (column ``fp``) reachable from each
    other by steps of at most ``limit`` bits."""
    n = codes.count()
    blocks = min(MAX_BLOCKS, max(MIN_BLOCKS, -(-n // block_codes)))
    placed = materialize(codes.select("fp")
                         .repartitionByRange(blocks, gray_rank(F.col("fp")))
                         .select("fp", F.spark_partition_id().alias("block")))
    upper = placed.groupBy("block").agg(F.expr("bit_and(fp)").alias("all_and"),
                                        F.expr("bit_or(fp)").alias("all_or")).orderBy("block").collect()
    if not upper:
        return codes.sparkSession.createDataFrame([], "a bigint, b bigint")
    number = np.array([r.block for r in upper], dtype=np.int32)
    all_and = np.array([r.all_and for r in upper], dtype=np.int64).view(np.uint64)
    all_or = np.array([r.all_or for r in upper], dtype=np.int64).view(np.uint64)
    nodes = (number, all_and, ~(all_and ^ all_or))
    routed = placed.mapInArrow(partial(_route, nodes=nodes, limit=limit),
                               "block int, fp bigint, indexed boolean")
    return routed.groupBy("block").applyInPandas(partial(_search_block, limit=limit),
                                                 "a bigint, b bigint")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       carry: Sequence[str] | None = None, words: int = SHINGLE_WORDS,
                       limit: int = MAX_DISTANCE) -> DataFrame:
    """``carry`` columns of every row (default: all) with ``fingerprint`` (hex), ``component_id``
    (smallest id reachable) and ``kept`` (one row of each component: its smallest id's first). Carried
    columns called like these three, in any case, are replaced by them."""
    carry = list(docs.columns if carry is None else carry)
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("_uid"),
                                   F.col(doc_id).alias("_id"), fingerprint_col(text, words).alias("fp"),
                                   packed_row(carry)))
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id"), F.col("_uid"))
    codes = materialize(rows.groupBy("fp").agg(F.min(first).alias("_first")))
    roots = components(near_links(codes, limit))
    joined = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("_first").alias("_keep"))
    verdict = joined.select("fp", "root").join(least, "root", "inner").select("fp", "_keep")
    wanted = [F.col("_row").getField(c).alias(c) for c in carry
              if c.lower() not in ("fingerprint", "component_id", "kept")]
    return rows.join(verdict, "fp", "inner").select(
        *wanted, hex_col("fp").alias("fingerprint"), F.col("_keep._id").alias("component_id"),
        (F.col("_uid") == F.col("_keep._uid")).alias("kept"))
