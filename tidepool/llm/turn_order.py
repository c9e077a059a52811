"""Places of turns in their conversations, for conversations of any length (DataFrame functions).

Turns are ordered by turn number (null first); rows of one turn number by the MD5 of role and text,
so only identical rows are interchangeable. A conversation may hold any share of all rows: turn
numbers are summed in ranges of ``TURN_RANGE``, and rows of one turn number by hash and input
partition, so no window holds a whole conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import materialize, running_before

TURN_RANGE = 1024


def conversation_key(conv_id: str) -> Column:
    """A string that is never null: rows without an id form a conversation of their own."""
    return F.when(F.col(conv_id).isNull(), F.lit("-")) \
        .otherwise(F.concat(F.lit("+"), F.col(conv_id).cast("string")))


def turn_digest(role: Column, text: Column) -> Column:
    """MD5 of a turn; the length of the role keeps role and text apart."""
    return F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))


def number_rows(rows: DataFrame) -> DataFrame:
    """``rows`` written once, with ``_uid``."""
    return materialize(rows.withColumn("_uid", F.monotonically_increasing_id()))


def sums_before(rows: DataFrame, size: Column, out: str) -> DataFrame:
    """``_uid`` and ``out``: the sum of ``size`` over the earlier turns of the same conversation.

    ``rows`` has ``_key``, ``_turn`` (bigint or null), ``_md5`` and ``_uid``, all else is left out.
    """
    narrow = rows.select("_key", "_uid", "_md5", size.alias("_size"),
                         F.coalesce(F.col("_turn"), F.lit(0)).alias("_t"),
                         F.when(F.col("_turn").isNull(), 0).otherwise(1).alias("_known"))
    turns = narrow.groupBy("_key", "_known", "_t").agg(F.sum("_size").alias("_size")).withColumn(
        "_range", F.struct("_known", F.floor(F.col("_t") / F.lit(TURN_RANGE)).alias("_r")))
    base = running_before(turns, ["_key"], "_range", [F.col("_t")], F.col("_size"), "_turns_before")
    same = narrow.withColumn("_part", F.struct("_md5", F.shiftright("_uid", 33).alias("_p")))
    tied = running_before(same, ["_key", "_known", "_t"], "_part", [F.col("_uid")], F.col("_size"), "_tied_before")
    return tied.join(base.select("_key", "_known", "_t", "_turns_before"), ["_key", "_known", "_t"], "inner") \
        .select("_uid", (F.col("_turns_before") + F.col("_tied_before")).cast("bigint").alias(out))


def running_per_range(rows: DataFrame, keys: list[str], at: str, span: int, sums: dict[str, Column]) -> DataFrame:
    """``rows`` with each of ``sums`` (a name and an aggregate function of a running value) taken
    over the rows of the same ``keys`` up to and including the row, in order of ``at`` (a BIGINT
    place, unique within ``keys``). Windows hold at most ``span`` places; one row per range of places is
    windowed per key.

    ``sums`` maps the output to ("sum" or "bit_xor", column).
    """
    ranged = rows.withColumn("_range", F.floor(F.col(at) / F.lit(span)))
    whole = ranged.groupBy(*keys, "_range").agg(
        *[F.expr(f"{fn}({col})").alias(f"_w_{out}") for out, (fn, col) in sums.items()])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = whole.select(*keys, "_range", *[
        F.coalesce(F.expr(f"{fn}(_w_{out})").over(before), F.lit(0).cast("bigint")).alias(f"_b_{out}")
        for out, (fn, _) in sums.items()])
    inside = Window.partitionBy(*keys, "_range").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    staged = ranged.select("*", *[F.expr(f"{fn}({col})").over(inside).alias(f"_i_{out}")
                                  for out, (fn, col) in sums.items()])
    joined = staged.join(base, [*keys, "_range"], "inner")
    total = {out: F.col(f"_b_{out}").bitwiseXOR(F.col(f"_i_{out}")) if fn == "bit_xor"
             else F.col(f"_b_{out}") + F.col(f"_i_{out}") for out, (fn, _) in sums.items()}
    return joined.select(*rows.columns, *[c.alias(out) for out, c in total.items()])
