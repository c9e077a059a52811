"""Best-fit-decreasing packing of token documents into sequences of a fixed capacity.

Documents longer than the capacity are cut into full pieces (the first takes the remainder);
everything shorter stays whole. Best-fit decreasing only looks at lengths, so it runs on the
histogram of piece lengths (at most one count per length, whatever the input): lengths from long
to short, a segment tree over the remaining capacities finds the tightest open bin that fits, and
bins with the same remainder are moved together. The result is the packing the document-by-
document algorithm gives for the whole corpus. It is stated as spans of ranks, and each piece
finds its place from its rank among the pieces of its length; ranks come from prefix sums over
the parts in which the pieces were made, so no length, however common, meets in one task.

Edge cases: null and empty texts are documents of the end id alone; repeated rows are packed each;
null ids are kept; an empty table gives an empty result; further columns can be carried.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import tokens
from tidepool.llm.common import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048
#: Rows per Arrow batch of the encoding step.
OUT_ROWS = 2048


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which have an open bin."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open = [False] * (2 * self.size)

    def set(self, r: int, is_open: bool) -> None:
        i = r + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """Least open remainder >= need, in logarithmic time."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Spans (length, first rank, pieces, pieces per bin, first bin, offset) of the packing."""
    tree, bins, spans, made = CapacityTree(capacity), {}, [], 0

    def put(r: int, lo: int, n: int) -> None:
        if n and r:
            bins.setdefault(r, []).append((lo, n))
            tree.set(r, True)

    for length in sorted((k for k in counts if k > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            r = tree.tightest(length)
            if r is None:
                r, per = capacity, capacity // length
                lo, n = made, -(-left // per)
                made += n
            else:
                per = r // length
                lo, n = bins[r].pop()
                if not bins[r]:
                    tree.set(r, False)
            full = min(n, left // per)
            if full:
                spans.append((length, rank, full * per, per, lo, capacity - r))
                put(r - per * length, lo, full)
                left, rank = left - full * per, rank + full * per
            rest = min(left, per - 1) if full < n else 0
            if rest:
                spans.append((length, rank, rest, rest, lo + full, capacity - r))
                put(r - rest * length, lo + full, 1)
                left, rank, full = left - rest, rank + rest, full + 1
            put(r, lo + full, n - full)
    return spans


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int,
            carry: Sequence[str], with_ids: bool, added_tokens: bool) -> Iterator[pa.RecordBatch]:
    """Encode and cut; number the pieces of each length within this part. Ids are kept only if wanted."""
    part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
    for batch in batches:
        enc = tokens.encoder(tokenizer, added_tokens)
        end, w = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        for at, texts in tokens.text_steps(batch.column("text")):
            row, piece, start, length, data, crc, nth = [], [], [], [], [], [], []
            for i, ids in enumerate(enc.encode(texts)):
                ids += end
                n = len(ids) // w
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    cut = ids[a * w:b * w]
                    row.append(at + i)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    if with_ids:
                        data.append(cut)
                    crc.append(tokens.crc_u32(np.frombuffer(cut, enc.dtype)))
                    nth.append(seen[b - a])
                    seen[b - a] += 1
            made = len(row)
            picked = batch.select(list(carry)).take(pa.array(row, pa.int64()))
            held = {"piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array([part] * made, pa.int32()), "nth": pa.array(nth, pa.int64())}
            if with_ids:
                held |= {"ids": pa.array(data, pa.binary()), "id_bytes": pa.array([w] * made, pa.int32())}
            whole = pa.RecordBatch.from_arrays([*picked.columns, *held.values()], [*picked.schema.names, *held])
            for a in range(0, made, OUT_ROWS):
                yield whole.slice(a, OUT_ROWS)


def _place(batches: Iterator[pa.RecordBatch], spans: np.ndarray, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of each piece from its rank among the pieces of its length."""
    lengths, ranks = spans[:, 0], spans[:, 1]
    order = np.lexsort((ranks, lengths))
    table, lengths, ranks = spans[order], lengths[order], ranks[order]
    first = np.searchsorted(lengths, np.arange(lengths.max() + 2)) if len(lengths) else None
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        at = np.empty(len(length), dtype=np.int64)
        for n in np.unique(length):
            here = length == n
            lo, hi = first[n], first[n + 1]
            at[here] = lo + np.searchsorted(ranks[lo:hi], rank[here], side="right") - 1
        span = table[at]
        step = rank - span[:, 1]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(span[:, 4] + step // span[:, 3]),
             pa.array(span[:, 5] + step % span[:, 3] * length)],
            [*names, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, with_ids: bool = True, added_tokens: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if
    wanted, ``ids`` (little-endian unsigned integers of ``id_bytes`` bytes). With ``added_tokens``
    their strings in a text become their ids, else special ones are ordinary text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = materialize(rows.mapInArrow(
        partial(_pieces, tokenizer=tokenizer, end_id=end_id, capacity=capacity, carry=["doc_id"],
                with_ids=with_ids, added_tokens=added_tokens),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
        + (", ids binary, id_bytes int" if with_ids else "")))
    by_part = materialize(made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
              by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    spans = np.array(best_fit(counts, capacity), dtype=np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids", "id_bytes"] if with_ids else [])
    ranked = made.join(base, ["length", "part"], "inner") \
        .withColumn("rank", F.col("base") + F.col("nth")).select(*names, "rank")
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(partial(_place, spans=spans, names=names), schema)
