"""Sharding by balanced label propagation (DataFrame functions only).

Documents of equal text are linked. The documents of one group are interchangeable, so the state
of the iteration is one row per (group, shard) with a count, at most ``shards`` rows a group and
never a link list. Each round joins a group's counts: documents in a shard wish to move to their
group's fuller shard; per pair of shards as many moves are granted as cycles of wishes and free
places of the quotas allow (a flow over shards x shards totals); those of most gain are granted.
Law ``rows``: shard quotas differ by at most one row, linked documents never exceed them, and
documents without links fill the rest exactly.

Edge cases: null texts are linked with each other, not with empty ones; size of null is 1; a
group larger than a quota fills whole shards; repeated rows are rows of their own; with fewer rows
than shards the last shards are empty; an empty table gives an empty result; further columns are
carried unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import bucket_count, materialize, packed_row, running_before

SHARDS = 16
MAX_ROUNDS = 24
#: Ranks per join key when ranks are matched with a group's shard intervals (splits hot groups).
RANK_STEP = 512
GAIN_STEP = 1024


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def grants(wishes: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """Moves granted per (from, to), at most as many as wished, such that no shard gains more
    than it loses plus its free places: shortest closed walks over the wished moves, where a walk
    may also end in a free place and start anywhere."""
    left, room, out = dict(wishes), list(free), dict.fromkeys(wishes, 0)
    shards = range(len(free))

    def walk(start: int) -> list[tuple[int, int]] | None:
        """Shortest chain of wished moves from ``start`` to a free place or back to ``start``."""
        came, queue = {start: None}, [start]
        for i in queue:
            for j in shards:
                if left.get((i, j), 0) <= 0 or j in came and j != start:
                    continue
                if room[j] > 0 or j == start:
                    chain = [(i, j)]
                    while came[i] is not None:
                        chain.append((came[i], i))
                        i = came[i]
                    return chain
                came[j] = i
                queue.append(j)
        return None

    for start in shards:
        while chain := walk(start):
            end = chain[0][1]
            n = min(left[m] for m in chain)
            if end != start:
                n = min(n, room[end])
                room[end] -= n
                room[start] += n
            for m in chain:
                left[m] -= n
                out[m] += n
    return out


def _pairs_map(values: dict[tuple[int, int], int], shards: int) -> Column:
    """Lookup of at most shards^2 numbers by (from, to)."""
    flat = [F.lit(values.get((i, j), 0)).cast("bigint") for i in range(shards) for j in range(shards)]
    return F.element_at(F.array(*flat), (F.col("from") * shards + F.col("to") + 1).cast("int"))


def _wishes(state: DataFrame, free: list[int]) -> DataFrame:
    """(gid, from, to, n, gain) of every group part that would rather be with a larger part."""
    is_open = F.element_at(F.array(*[F.lit(f > 0) for f in free]), (F.col("shard") + 1).cast("int"))
    part = F.struct(F.col("n"), F.xxhash64("gid", "shard").alias("tie"), F.col("shard"),
                    is_open.alias("open"))
    lists = state.groupBy("gid").agg(F.collect_list(part).alias("parts"))  # at most one per shard
    each = lists.withColumn("own", F.explode("parts"))
    better = F.filter("parts", lambda p: (p["n"] > F.col("own.n"))
                      | ((p["n"] == F.col("own.n")) & (p["tie"] > F.col("own.tie"))))
    best = F.coalesce(F.array_max(F.filter(better, lambda p: p["open"])), F.array_max(better))
    return each.withColumn("best", best).where(F.col("best").isNotNull()).select(
        "gid", F.col("own.shard").alias("from"), F.col("best.shard").alias("to"),
        F.col("own.n").alias("n"), (F.col("best.n") - F.col("own.n")).alias("gain"))


def propagate(groups: DataFrame, quota: list[int], max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(gid, shard, n): where the ``n`` documents of each linked group go, within the quotas."""
    shards = len(quota)
    buckets = bucket_count(groups.count())
    spread = running_before(
        groups.withColumn("_all", F.lit(0)).withColumn("_b", F.pmod(F.xxhash64("gid"), F.lit(buckets))),
        ["_all"], "_b", [F.col("gid")], F.col("n"), "at")
    # Round robin: of the places at .. at + n - 1, those that leave remainder j go to shard j.
    upto = lambda end, j: F.floor((end - j + (shards - 1)) / shards)
    here = lambda j: upto(F.col("at") + F.col("n"), j) - upto(F.col("at"), j)
    start = spread.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    state = materialize(start.select("gid", "shard", here(F.col("shard")).cast("bigint").alias("n"))
                        .where(F.col("n") > 0))
    for _ in range(max_rounds):
        load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = [q - load.get(j, 0) for j, q in enumerate(quota)]
        wishes = materialize(_wishes(state, free))
        asked = {(r["from"], r["to"]): r["n"] for r in
                 wishes.groupBy("from", "to").agg(F.sum("n").alias("n")).collect()}
        granted = grants(asked, free)
        if not any(granted.values()):
            break
        rank = running_before(
            wishes.withColumn("_b", -F.col("gain") * GAIN_STEP
                              + F.pmod(F.xxhash64("gid"), F.lit(GAIN_STEP))),
            ["from", "to"], "_b", [F.col("gid")], F.col("n"), "before")
        moved = rank.withColumn("m", F.greatest(F.lit(0), F.least(
            F.col("n"), _pairs_map(granted, shards) - F.col("before")))).where(F.col("m") > 0)
        steps = moved.select("gid", F.explode(F.array(
            F.struct(F.col("from").alias("shard"), (-F.col("m")).alias("n")),
            F.struct(F.col("to").alias("shard"), F.col("m").alias("n")))).alias("s")).select("gid", "s.*")
        state = materialize(state.unionByName(steps).groupBy("gid", "shard")
                            .agg(F.sum("n").alias("n")).where(F.col("n") > 0))
    return state


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] = (),
          shards: int = SHARDS, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot`` and ``row``, a struct of
    the ``carry`` columns. Slots count from 0 in every shard without gaps."""
    t = F.col(text)
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(F.coalesce(t, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.sha2(t, 256), F.lit("null")).alias("gid"), packed_row(carry)))
    total = rows.count()
    quota, buckets = quotas(total, shards), bucket_count(total)
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    groups = materialize(rows.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    state = propagate(groups, quota, max_rounds)
    load = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    order = [F.col("doc_id"), F.col("gid")]
    one = F.lit(1).cast("bigint")

    ends = Window.partitionBy("gid").orderBy("shard")  # at most one row per shard
    span = state.withColumn("hi", F.sum("n").over(ends)).withColumn("lo", F.col("hi") - F.col("n"))
    span = span.withColumn("_step", F.explode(F.sequence(
        F.floor(F.col("lo") / RANK_STEP), F.floor((F.col("hi") - 1) / RANK_STEP)))) \
        .select("gid", "_step", "lo", "hi", "shard")
    # Dealt anew by (gid, bucket): the join's partitioning by gid alone would keep a group whole.
    members = rows.join(groups.select("gid"), "gid", "left_semi").repartition("gid", "_b")
    linked = running_before(members, ["gid"], "_b", order, one, "rank") \
        .withColumn("_step", F.floor(F.col("rank") / RANK_STEP))
    linked = linked.join(span, ["gid", "_step"], "inner") \
        .where((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))

    single = running_before(rows.join(groups.select("gid"), "gid", "left_anti")
                            .withColumn("_all", F.lit(0)), ["_all"], "_b", order, one, "rank")
    target, upto = F.lit(None).cast("int"), 0
    for j in reversed(range(shards)):
        upto = sum(quota[i] - load.get(i, 0) for i in range(j + 1))
        target = F.when(F.col("rank") < upto, F.lit(j)).otherwise(target)
    cols = ["doc_id", "size", "text_crc32", "gid", "_row", "_b", "shard"]
    both = materialize(linked.select(*cols).unionByName(
        single.withColumn("shard", target).select(*cols)))
    slotted = running_before(both, ["shard"], "_b", order, one, "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                          F.col("slot").cast("bigint").alias("slot"), "gid", F.col("_row").alias("row"))
