"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Every source has a weight schedule over training time 0..1 (piecewise linear knots). Its integral
is the source's weight. Targets share ``total`` times all words by weight; a source stops at
``max_repeats`` times its size and the excess is shared again by weight (water filling in closed
form: sources sorted by cap / weight, running sums). A source's documents, in hash order, form a
token stream that repeats; the tokens before its target are taken. The source's cumulative demand
is the normalised integral of its schedule; inverting it at a document's middle token gives the
document's training position, and the documents are range-sorted by position.

Edge cases: a null or wordless text has size 0, takes nothing and has no position; null is a
source of its own, last; with no words at all every target is 0; repeated rows are rows of their
own; ties in the hash order are broken by id, size and a text hash, so only identical rows are
interchangeable; an empty table gives an empty result; further columns are carried unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, bucket_count, materialize, packed_row, running_before

Knots = Sequence[tuple[float, float]]

#: Schedules dealt to the sources in order, repeating: steady 3, rising to mean 1, falling to mean 2.
SCHEDULES: tuple[Knots, ...] = (((0.0, 3.0), (1.0, 3.0)), ((0.0, 0.0), (1.0, 2.0)),
                                ((0.0, 3.0), (1.0, 1.0)))
TOTAL_SHARE = 1.5
MAX_REPEATS = 2


def integral(knots: Knots) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def segments(knots: Knots) -> Column:
    """The schedule's linear pieces with the share of its integral before and after each."""
    whole, done, out = integral(knots), 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        fields = {"t0": t0, "w0": w0 / whole, "slope": (w1 - w0) / (t1 - t0) / whole,
                  "c0": done / whole, "c1": (done + area) / whole}
        out.append(F.struct(*[F.lit(float(v)).alias(k) for k, v in fields.items()]))
        done += area
    return F.array(*out)


def position(share: Column, pieces: Column) -> Column:
    """Training time at which a schedule has met ``share`` of its demand (the inverse integral)."""
    inside = F.filter(pieces, lambda p: p["c1"] >= share)
    p = F.coalesce(F.get(inside, F.lit(0)), F.element_at(pieces, -1))
    rest = F.greatest(share - p["c0"], F.lit(0.0))
    root = F.sqrt(F.greatest(p["w0"] * p["w0"] + 2 * p["slope"] * rest, F.lit(0.0)))
    return F.least(F.lit(1.0), p["t0"] + F.when(rest > 0, 2 * rest / (p["w0"] + root))
                   .otherwise(F.lit(0.0)))


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, schedules: Sequence[Knots] = SCHEDULES,
                   total: float = TOTAL_SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source (column ``source`` and its total ``source_size``): ``target`` and ``pieces``.

    One row per source goes through the windows (the distinct sources, not their documents)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(schedules)
    turn = sizes.withColumn("_turn", (F.row_number().over(by_name) - 1) % n)
    pick = lambda values: F.element_at(F.array(*values), F.col("_turn") + 1)
    weighted = turn.select(
        "source", "source_size", pick([F.lit(integral(k)) for k in schedules]).alias("_w"),
        pick([segments(k) for k in schedules]).alias("pieces"))
    capped = weighted.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) * F.lit(float(total))
              - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
             / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))))
    ranked = capped.withColumn("_level", level) \
        .withColumn("_open", F.col("_level") <= F.col("_cap") / F.col("_w")) \
        .withColumn("_place", F.row_number().over(order))
    water = F.min_by(F.when(F.col("_open"), F.col("_level")),
                     F.when(F.col("_open"), F.col("_place"))).over(every)
    return ranked.withColumn("target", F.least("_cap", F.coalesce(water, F.lit(0.0)) * F.col("_w"))) \
        .select("source", "source_size", "target", "pieces")


def place(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        carry: Sequence[str] = (), schedules: Sequence[Knots] = SCHEDULES,
        total: float = TOTAL_SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document, in no order: ``doc_id, source, size, source_size, target, taken,
    position`` (of its first use, null if unused), ``uses`` (array of epoch, words, position) and
    ``row``, a struct of the ``carry`` columns. Windows run on narrow rows; carried columns are
    joined to them once, by a row number."""
    name = F.col(source).cast("string")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), name.alias("source"), word_count(text).alias("size"),
        # never null: a null source gets a key no other source has
        F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), name)).alias("_source"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("_hash"),
        F.xxhash64(text).alias("_tie"), packed_row(carry), F.monotonically_increasing_id().alias("_uid"))
    rows = materialize(rows)
    digits = 1
    while 16 ** digits < bucket_count(rows.count()):
        digits += 1
    sizes = rows.groupBy("_source", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), schedules, total, max_repeats) \
        .withColumn("_source", F.when(F.col("source").isNull(), F.lit("-"))
                    .otherwise(F.concat(F.lit("+"), F.col("source")))).drop("source")
    narrow = rows.drop("_row").withColumn("_bucket", F.substring("_hash", 1, digits))
    placed = running_before(narrow, ["_source"], "_bucket",
                            [F.col("_hash"), F.col("doc_id"), F.col("size"), F.col("_tie")],
                            F.col("size"), "_before")
    joined = placed.join(materialize(targets), "_source", "inner")
    goal = F.floor(F.col("target") + 0.5)

    def use(epoch: Column) -> Column:
        start = epoch * F.col("source_size") + F.col("_before")
        words = F.greatest(F.lit(0), F.least(F.col("size"), goal - start))
        at = position((start + words / 2) / F.greatest(goal, F.lit(1)), F.col("pieces"))
        return F.struct(epoch.cast("int").alias("epoch"), words.cast("bigint").alias("words"),
                        at.alias("position"))
    uses = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), use),
                    lambda u: u["words"] > 0)
    taken = F.aggregate("uses", F.lit(0).cast("bigint"), lambda acc, u: acc + u["words"])
    out = joined.withColumn("uses", uses).withColumn("taken", taken) \
        .withColumn("position", F.get("uses", F.lit(0))["position"])
    cols = ["doc_id", "source", "size", "source_size", "target", "taken", "position", "uses"]
    if not carry:
        return out.select(*cols, "_hash", F.struct(F.lit(0).alias("_none")).alias("row"))
    return out.select(*cols, "_hash", "_uid").join(rows.select("_uid", "_row"), "_uid", "inner") \
        .select(*cols, "_hash", F.col("_row").alias("row"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``place``, range-sorted by position (unused documents last)."""
    return place(docs, **options).orderBy(F.col("position").asc_nulls_last(), "_hash").drop("_hash")


def training_order(placed: DataFrame) -> DataFrame:
    """One row per use of a document (of ``place`` or ``mix``), range-sorted by training position."""
    return placed.withColumn("use", F.explode("uses")) \
        .orderBy("use.position", "doc_id", "use.epoch")
