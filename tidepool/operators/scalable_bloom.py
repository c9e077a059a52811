"""Bloom filter that grows: generations of doubled capacity under one bound on the error.

A filter of fixed size answers "seen" for almost everything once it is overfull (the fixed filter of
``dedup.bloom_flags`` reaches 86 % false hits at 100,000 messages). Here the r-th distinct message goes
to generation g, where generation g holds ``capacity * 2^g`` messages at a false-hit rate of at most
``error / 2^(g + 1)``; these rates sum to less than ``error`` over any number of generations, so the bound
holds whatever the number of messages. A message is a hit if all its bits of some generation
were set by earlier rows.

Closed form, no walk in order: a message's generation follows from the rank of its first arrival among
first arrivals, each bit's first setter from one aggregation, and only first arrivals need
probing, for a later arrival finds its own bits set. A message is probed in every generation up to its own, a few
bits at a time, and drops out of a generation at its first missing bit. Ranks are counted per range of arrival numbers
(one row per range in the only unpartitioned window). Bit i of generation g is
``(h1 + i * h2) mod size`` with h1, h2 the first two 60-bit pieces of the message's MD5 salted with g.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators import dedup
from tidepool.plans.joins import materialize

CAPACITY, ERROR = 10_000, 0.01
#: Arrival numbers per range when first arrivals are ranked.
RANK_RANGE = 1 << 16
#: Above every generation's number of bits.
KEY_SPACE = 1 << 48


@dataclass(frozen=True)
class Generation:
    number: int
    start: int  # rank of its first message
    capacity: int
    size: int  # bits
    hashes: int


def generations(messages: int, capacity: int = CAPACITY, error: float = ERROR) -> list[Generation]:
    """The generations that ``messages`` distinct messages fill (one at least)."""
    out, start = [], 0
    while not out or start < messages:
        g = len(out)
        share = error / 2 ** (g + 1)
        n = capacity * 2 ** g
        out.append(Generation(g, start, n, math.ceil(n * math.log(1 / share) / math.log(2) ** 2),
                              max(1, round(math.log2(1 / share)))))
        start += n
    return out


def _pieces(msg_id: Column, g: int) -> tuple[Column, Column]:
    salted = F.md5(F.concat(msg_id, F.lit(f":{g}")))
    piece = lambda at: F.conv(F.substring(salted, at, 15), 16, 10).cast("bigint")
    return piece(1), piece(16)


def bits(msg_id: Column, gen: Generation) -> Column:
    """Array of the message's bit numbers in one generation (a number may repeat)."""
    h1, h2 = _pieces(msg_id, gen.number)
    a, b = h1 % gen.size, h2 % gen.size
    return F.transform(F.sequence(F.lit(0), F.lit(gen.hashes - 1)), lambda i: (a + i * b) % gen.size)


def first_arrivals(keyed: DataFrame, seq: str = "seq") -> DataFrame:
    """(msg_id, first_seq, rank) of the distinct messages; ranks from 0 in order of first arrival."""
    firsts = materialize(dedup.message_firsts(keyed, seq=seq)
                         .withColumn("range", F.floor(F.col("first_seq") / F.lit(RANK_RANGE))))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = firsts.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("first_seq", "msg_id")) - 1
    return firsts.withColumn("inside", inside).join(base, "range", "inner") \
        .select("msg_id", "first_seq", (F.col("base") + F.col("inside")).cast("bigint").alias("rank"))


def with_generation(firsts: DataFrame, gens: Sequence[Generation]) -> DataFrame:
    g = F.lit(0)
    for gen in gens[1:]:
        g = F.when(F.col("rank") >= gen.start, F.lit(gen.number)).otherwise(g)
    return firsts.withColumn("generation", g.cast("int"))


def _key(generation: Column, bit: Column) -> Column:
    """A generation's bit as one long."""
    return generation.cast("bigint") * F.lit(KEY_SPACE) + bit


def first_setters(firsts: DataFrame, gens: Sequence[Generation]) -> DataFrame:
    """(key, set_by): the first arrival that set each bit, every message in its own generation."""
    own = F.coalesce(*[F.when(F.col("generation") == gen.number, bits(F.col("msg_id"), gen)) for gen in gens])
    return firsts.select("first_seq", "generation", F.explode(own).alias("bit")) \
        .groupBy(_key(F.col("generation"), F.col("bit")).alias("key")).agg(F.min("first_seq").alias("set_by"))


def probe_rows(firsts: DataFrame, gens: Sequence[Generation]) -> DataFrame:
    """(rank, first_seq, g, a, b): a row per message and generation up to its own, with the start and the
    step of its bits there."""
    def walk(gen: Generation) -> Column:
        h1, h2 = _pieces(F.col("msg_id"), gen.number)
        return F.struct(F.lit(gen.number).alias("g"), (h1 % gen.size).alias("a"), (h2 % gen.size).alias("b"))
    each = F.array_compact(F.array(*[F.when(F.col("generation") >= gen.number, walk(gen)) for gen in gens]))
    return firsts.select("rank", "first_seq", F.explode(each).alias("e")).select("rank", "first_seq", "e.*")


def filled_probes(probes: DataFrame, fill: DataFrame, gens: Sequence[Generation]) -> DataFrame:
    """The rows of ``probes`` of which every bit was set before ``first_seq``.

    Bits are looked up in rounds of 1, 1, 2, 4, ... of them, and only rows without a missing bit go on. A
    generation fills at most half its bits, so half of the rows or fewer pass each bit: about two look-ups per
    row that misses, instead of one per bit."""
    size, hashes = (F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col("g") + 1)
                    for values in ([gen.size for gen in gens], [gen.hashes for gen in gens]))
    id_cols = ["rank", "first_seq", "g", "a", "b"]
    start, most = 0, max(gen.hashes for gen in gens)
    while start < most:
        end = min(max(start * 2, 1), most)
        place = F.explode(F.sequence(F.lit(start).cast("bigint"), F.least(F.lit(end), hashes) - 1))
        done, open_rows = probes.where(hashes <= start), probes.where(hashes > start)
        asked = open_rows.select("*", place.alias("i")) \
            .withColumn("key", _key(F.col("g"), (F.col("a") + F.col("i") * F.col("b")) % size))
        found = asked.join(fill, "key", "inner").where(F.col("set_by") < F.col("first_seq"))
        if end - start > 1:
            found = found.groupBy(*id_cols).agg(F.count(F.lit(1)).alias("n")) \
                .where(F.col("n") == F.least(F.lit(end), hashes) - start)
        probes = materialize(found.select(*id_cols).unionByName(done.select(*id_cols)))
        start = end
    return probes


def flags(messages: DataFrame, message: str = "message", seq: str = "seq", capacity: int = CAPACITY,
          error: float = ERROR) -> DataFrame:
    """(seq, msg_id, generation, is_duplicate, is_false_hit) per row: flagged as seen before, and whether
    wrongly. ``generation`` is where the message is held."""
    keyed = dedup.key_rows(messages, message=message, seq=seq)
    ranked = materialize(first_arrivals(keyed, seq))
    gens = generations(ranked.count(), capacity, error)
    firsts = materialize(with_generation(ranked, gens))
    fill = materialize(first_setters(firsts, gens))
    hits = materialize(filled_probes(probe_rows(firsts, gens), fill, gens).select("rank").distinct())
    held = firsts.join(hits.withColumn("hit", F.lit(True)), "rank", "left") \
        .select("msg_id", "first_seq", "generation", F.coalesce("hit", F.lit(False)).alias("hit"))
    later = F.col(seq) > F.col("first_seq")
    return keyed.join(held, "msg_id", "inner").select(
        F.col(seq), "msg_id", "generation", (later | F.col("hit")).alias("is_duplicate"),
        (~later & F.col("hit")).alias("is_false_hit"))
