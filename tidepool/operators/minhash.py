"""Near-duplicates by MinHash banding with verified Jaccard similarity.

The flag of ``dedup.near_flags`` compares five token counts and misses real near copies. Here texts
are sets of five-word shingles; ``BANDS`` bands of ``ROWS`` MinHash entries choose candidates, and a
candidate pair is a link if the Jaccard similarity of the whole sets is at least ``SIMILARITY``. A pair at
similarity s meets in some band with probability 1 - (1 - s^rows)^bands: 0.99966 at 0.8, more above.

Texts with equal sets are one set (the links among them need no comparison). Then, so that a
bucket of thousands never becomes a list of pairs:

1. every set is compared with the least set of each of its buckets; what links is contracted;
2. in each bucket only sets of different components are compared. A bucket's sets are dealt into cells
   of about ``CELL`` sets, whole components first; every two cells meet in one task, but not cells of one and the
   same component. A task joins what it links at once and skips pairs that are joined already, or that an
   earlier band handles; it returns the links it used.

No link between different texts is lost by this: only comparisons whose outcome cannot change the classes are
left out. Texts without words link with nothing, not even each other.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import minhash
from tidepool.functions.text import normalize
from tidepool.plans.graph import components
from tidepool.plans.joins import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
#: Sets per cell of a bucket.
CELL = 256
#: Sets taken out of an Arrow batch together.
BATCH_SETS = 256
#: Shares of a set's look-up key, so that a set that is the least of very many is not one join key.
SALTS = 16


def sketches(docs: DataFrame, seq: str = "seq", message: str = "message", words: int = SHINGLE_WORDS,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(seq, set_id, ids, bands) of every text; a null text counts as empty."""
    norm = normalize(F.coalesce(F.col(message), F.lit("")))
    sketch = minhash.sketch_col(norm, words, bands, rows)
    return docs.select(F.col(seq).alias("seq"), sketch.alias("s")).select("seq", "s.*")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays without repeats."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def bucket_rows(sets: DataFrame) -> DataFrame:
    """(band, key, rep) of the buckets that hold more than one set."""
    entries = materialize(sets.select("rep", F.posexplode("bands").alias("band", "key")))
    full = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("least")).where("n > 1")
    return entries.join(full, ["band", "key"], "inner")


def least_links(sets: DataFrame, buckets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between sets and the least set of their buckets."""
    pairs = buckets.where(F.col("rep") != F.col("least")).select(F.col("least").alias("a"), F.col("rep").alias("b")) \
        .distinct().withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    ids = sets.select("rep", "ids")
    hubs = pairs.select(F.col("a").alias("rep"), "salt").distinct().join(ids, "rep", "inner") \
        .select(F.col("rep").alias("a"), "salt", F.col("ids").alias("ids_a"))
    return pairs.join(hubs, ["a", "salt"], "inner").join(ids.select(F.col("rep").alias("b"), F.col("ids").alias("ids_b")), "b") \
        .where(jaccard(F.col("ids_a"), F.col("ids_b")) >= similarity).select("a", "b")


def cell_members(buckets: DataFrame, roots: DataFrame, cell: int) -> DataFrame:
    """(band, key, left, right, side, rep, root): the sets of each pair of a bucket's cells."""
    key = ["band", "key"]
    placed = buckets.select(*key, "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("root", F.coalesce("root", "rep"))
    placed = materialize(placed)
    parts = placed.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("n_root"))
    sizes = parts.groupBy(*key).agg(F.sum("n_root").alias("n"), F.count(F.lit(1)).alias("n_roots")).where("n_roots > 1") \
        .withColumn("slices", F.ceil(F.col("n") / F.lit(cell)).cast("bigint"))
    sliced = parts.join(sizes.select(*key, "slices"), key, "inner") \
        .withColumn("slice", F.pmod(F.xxhash64("root", "key"), F.col("slices")))
    # a slice holds whole components and is cut further into cells of about the wanted size
    slices = sliced.groupBy(*key, "slice").agg(F.sum("n_root").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")) \
        .withColumn("cuts", F.ceil(F.col("n") / F.lit(cell)).cast("bigint"))
    cells = slices.select(*key, "slice", "low", "high", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cuts") - 1)).alias("cut"))
    one, two = cells.alias("x"), cells.alias("y")
    same = (F.col("x.slice") == F.col("y.slice")) & (F.col("x.low") == F.col("x.high"))
    ordered = F.struct("x.slice", "x.cut") <= F.struct("y.slice", "y.cut")
    meetings = one.join(two, [F.col("x.band") == F.col("y.band"), F.col("x.key") == F.col("y.key")], "inner") \
        .where(ordered & ~same).select(F.col("x.band").alias("band"), F.col("x.key").alias("key"),
                                       F.struct("x.slice", "x.cut").alias("left"), F.struct("y.slice", "y.cut").alias("right"))
    seats = meetings.select(*key, "left", "right", F.explode(F.when(F.col("left") == F.col("right"), F.array("left"))
                                                             .otherwise(F.array("left", "right"))).alias("cell"))
    members = placed.join(sliced.select(*key, "root", "slice"), [*key, "root"], "inner") \
        .join(slices.select(*key, "slice", "cuts"), [*key, "slice"], "inner") \
        .withColumn("cell", F.struct("slice", F.pmod(F.xxhash64("rep", "band"), F.col("cuts")).alias("cut")))
    return members.join(seats, [*key, "cell"], "inner").select(
        *key, "left", "right", (F.col("cell") == F.col("left")).alias("first"), "rep", "root")


def meeting_links(band: int, rows: list, similarity: float) -> list[tuple[int, int]]:
    """Links that join different components, among the sets (first, rep, root, ids, bands) of two cells
    (or of one, then all are first)."""
    lone = all(r[0] for r in rows)
    left = [r for r in rows if r[0]]
    right = left if lone else [r for r in rows if not r[0]]
    up: dict[int, int] = {r[2]: r[2] for r in rows}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    links = []
    for i, (_, rep_a, root_a, ids_a, bands_a) in enumerate(left):
        for _, rep_b, root_b, ids_b, bands_b in right[i + 1:] if lone else right:
            x, y = find(root_a), find(root_b)
            if x == y or min(len(ids_a), len(ids_b)) < similarity * max(len(ids_a), len(ids_b)):
                continue
            if band and (bands_a[:band] == bands_b[:band]).any():
                continue  # an earlier band's task compares the two
            both = len(np.intersect1d(ids_a, ids_b, assume_unique=True))
            if both / (len(ids_a) + len(ids_b) - both) >= similarity:
                up[max(x, y)] = min(x, y)
                links.append((rep_a, rep_b))
    return links


def _meetings(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Compare the cells of every meeting of a partition sorted by meeting."""
    def emit(found):
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])
    meeting, rows = None, []
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH_SETS):
            batch, out = whole.slice(at, BATCH_SETS), []
            arrays = {}
            for name in ("ids", "bands"):
                column = batch.column(name)
                start, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
                arrays[name] = [values[a:b].copy() for a, b in zip(start, start[1:])]
            narrow = zip(*(batch.column(name).to_pylist() for name in ("band", "meeting", "first", "rep", "root")),
                         arrays["ids"], arrays["bands"])
            for row in narrow:
                if row[:2] != meeting:
                    if rows:
                        out += meeting_links(meeting[0], rows, similarity)
                    meeting, rows = row[:2], []
                rows.append(row[2:])
            yield emit(out)
    if rows:
        yield emit(meeting_links(meeting[0], rows, similarity))


def cell_links(sets: DataFrame, buckets: DataFrame, roots: DataFrame, similarity: float, cell: int) -> DataFrame:
    members = cell_members(buckets, roots, cell).withColumn(
        "meeting", F.to_json(F.struct("key", "left", "right"))).select("band", "meeting", "first", "rep", "root")
    whole = members.join(sets.select("rep", "ids", "bands"), "rep", "inner")
    return whole.repartition("band", "meeting").sortWithinPartitions("band", "meeting") \
        .mapInArrow(partial(_meetings, similarity=similarity), "a bigint, b bigint")


def near_classes(docs: DataFrame, seq: str = "seq", message: str = "message", words: int = SHINGLE_WORDS,
                 similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, cell: int = CELL) -> DataFrame:
    """Per text: ``seq``, ``class_id`` (least ``seq`` reachable by links), ``class_size`` and ``is_near_copy``
    (of an earlier text). Rows without ``seq`` are left out; classes are known by their least ``seq``, so where
    ids repeat, two of the same least one are counted together."""
    found = materialize(sketches(docs.where(F.col(seq).isNotNull()), seq, message, words, bands, rows))
    worded = F.size("ids") > 0
    # one row per distinct set, numbered: ids of texts may repeat
    sets = materialize(found.where(worded).groupBy("set_id").agg(
        F.min("seq").alias("low"), F.first("ids").alias("ids"), F.first("bands").alias("bands"))
        .withColumn("rep", F.monotonically_increasing_id()))
    buckets = materialize(bucket_rows(sets))
    first = materialize(least_links(sets, buckets, similarity))
    roots = components(first)
    links = first.unionByName(materialize(cell_links(sets, buckets, roots, similarity, cell)))
    classes = components(links).withColumnRenamed("node", "rep")
    named = sets.select("set_id", "rep", "low").join(classes, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    low = named.groupBy("root").agg(F.min("low").alias("class_id"))
    named = named.join(low, "root").select("set_id", "class_id")
    placed = found.where(worded).select("seq", "set_id").join(named, "set_id", "inner").select("seq", "class_id")
    placed = materialize(placed.unionByName(found.where(~worded).select("seq", F.col("seq").alias("class_id"))))
    sizes = placed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size"))
    return placed.join(sizes, "class_id", "inner").select(
        "seq", "class_id", "class_size", (F.col("seq") != F.col("class_id")).alias("is_near_copy"))
