"""Conversation structure repair by bidirectional Dijkstra over the edit lattice.

A lattice node is (turns passed, state of the role pattern ``(s?(ua)+)?``). Keep (0), Rerole to user or
assistant (1) and Delete (2) pass a turn, Insert of an empty user or assistant turn (5) does not; keeping or
reroling a truncated turn adds 5; blank and repeated turns must be deleted. A forward heap from the entry
and a reverse heap from the exits settle nodes by cost until the sum of their least costs exceeds the
best path, so all crossings of equal cost are finished. Least audits are then spelled along the
shortest-path edges of both sides, and the least concatenation over the crossing edges wins.

That least audits can be spelled node by node rests on this: an audit fixes its own cost (every
letter's cost follows from the turn it passes), so of two audits of equal cost to one node neither is a prefix
of the other, and what follows cannot change their order. For the same reason conversations
are cut into chunks of ``CHUNK`` turns: a chunk's table of (entry state, exit state) -> (cost, audit)
is solved by itself, and tables are joined, ``FOLD`` neighbours at a time, until one is left. An audit
also fixes the roles it inserts or sets, so the repaired turns are read off audit and turns in one pass.

Edge cases: a null role or text is one space (so the text is blank); turns are ordered by number, null
first, equal numbers by MD5 of role and text; rows without conversation id form one conversation
(null); a role's initial other than s, u, a can only be reroled or deleted; a conversation whose turns
all go has an empty audit's or ``D``s' cost and the hash of the empty text; no rows give no plans.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import lru_cache, reduce
from heapq import heappop, heappush

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import materialize
from tidepool.llm.turn_order import conversation_key, number_rows, sums_before, turn_digest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
CHUNK = 1024
FOLD = 16
#: Shares of a repeated turn's look-up key, so that one turn repeated very often is not one join key.
SALTS = 16
SPACES = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPTING = (START, ASSISTANT)
#: Where a turn of each role initial leads.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
BEFORE = tuple([(q, r) for q in STATES for r, to in NEXT[q].items() if to == state] for state in STATES)
WORDS = {"u": "user", "a": "assistant"}
#: The one role (of user and assistant) that may come next in each state.
FREE = tuple(next(r for r in "ua" if r in NEXT[q]) for q in STATES)


# ---------------------------------------------------------------- the lattice

def _passing(code: str, role: str) -> Iterator[tuple[int, str]]:
    """(cost, letter) of the edits by which a turn of this code can stand as ``role``. A code is x for a
    turn that must go, else the role's initial (o: none of s, u, a), in capitals if truncated."""
    if code == "x":
        return
    extra = TRUNCATED if code.isupper() else 0
    if code.lower() == role:
        yield KEEP + extra, "K"
    if role in WORDS:
        yield REROLE + extra, "R"


def _forward(codes: str, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    i, q = node
    if i < len(codes):
        yield (i + 1, q), DELETE, "D"
        for role, to in NEXT[q].items():
            for cost, letter in _passing(codes[i], role):
                yield (i + 1, to), cost, letter
    yield (i, NEXT[q][FREE[q]]), INSERT, "I"


def _reverse(codes: str, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    i, q = node
    if i:
        yield (i - 1, q), DELETE, "D"
    for came, role in BEFORE[q]:
        if i:
            for cost, letter in _passing(codes[i - 1], role):
                yield (i - 1, came), cost, letter
        if role == FREE[came]:
            yield (i, came), INSERT, "I"


class _Side:
    """One direction of the search: tentative and settled costs."""

    def __init__(self, sources, step):
        self.cost = {s: 0 for s in sources}
        self.heap = [(0, s) for s in sources]
        self.settled: dict[tuple[int, int], int] = {}
        self.step = step

    def least(self) -> float:
        while self.heap and self.heap[0][1] in self.settled:
            heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self, codes: str) -> tuple[int, int]:
        cost, node = heappop(self.heap)
        self.settled[node] = cost
        for other, price, _ in self.step(codes, node):
            total = cost + price
            if total < self.cost.get(other, total + 1):
                self.cost[other] = total
                heappush(self.heap, (total, other))
        return node


@lru_cache(maxsize=1 << 14)
def least_repair(codes: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Least (cost, audit) from state ``entry`` before the codes to one of ``exits`` behind them."""
    n = len(codes)
    ends = {(n, q) for q in exits}
    ahead, back = _Side([(0, entry)], _forward), _Side(sorted(ends), _reverse)
    best = float("inf")
    while True:
        a, b = ahead.least(), back.least()
        if a + b > best or a + b == float("inf"):
            break
        side, other = (ahead, back) if a <= b else (back, ahead)
        node = side.settle(codes)
        if node in other.cost:
            best = min(best, side.settled[node] + other.cost[node])
    if best == float("inf"):
        return None
    spelled = {(0, entry): ""}
    for node in sorted(ahead.settled, key=lambda v: (v[0], ahead.settled[v])):
        for to, price, letter in _forward(codes, node):
            if ahead.settled.get(to) == ahead.settled[node] + price:
                audit = spelled[node] + letter
                if to not in spelled or audit < spelled[to]:
                    spelled[to] = audit
    rest = {end: "" for end in ends}
    for node in sorted(back.settled, key=lambda v: (-v[0], back.settled[v])):
        for came, price, letter in _reverse(codes, node):
            if back.settled.get(came) == back.settled[node] + price:
                audit = letter + rest[node]
                if came not in rest or audit < rest[came]:
                    rest[came] = audit
    found = [spelled[end] for end in ends if ahead.settled.get(end) == best]
    for node, cost in ahead.settled.items():
        for to, price, letter in _forward(codes, node):
            if to not in ahead.settled and back.settled.get(to, best + 1) + cost + price == best:
                found.append(spelled[node] + letter + rest[to])
    return int(best), min(found)


Table = dict[tuple[int, int], tuple[int, str]]


def chunk_table(codes: str, first: bool, last: bool) -> Table:
    """(entry, exit) -> (cost, audit) of a chunk. A first chunk has one entry; all accepting states
    of a last one are one exit, ``START``."""
    table = {}
    for entry in (START,) if first else STATES:
        for way, exits in ((START, ACCEPTING),) if last else [(q, (q,)) for q in STATES]:
            found = least_repair(codes, entry, exits)
            if found:
                table[entry, way] = found
    return table


def join_tables(left: Table, right: Table) -> Table:
    out: Table = {}
    for (entry, mid), (c1, a1) in left.items():
        for (came, way), (c2, a2) in right.items():
            if came == mid:
                found = (c1 + c2, a1 + a2)
                if (entry, way) not in out or found < out[entry, way]:
                    out[entry, way] = found
    return out


def illegal_pairs(initials: str) -> int:
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


_TABLE = "array<struct<entry: int, way: int, cost: bigint, audit: string>>"


def _pack(table: Table) -> list[dict]:
    return [{"entry": e, "way": w, "cost": c, "audit": a} for (e, w), (c, a) in table.items()]


@lru_cache(maxsize=None)
def _udfs():
    @F.pandas_udf(_TABLE)
    def solve(codes: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([_pack(chunk_table(*row)) for row in zip(codes, first, last)], dtype=object)

    @F.pandas_udf(_TABLE)
    def fold(tables: pd.Series) -> pd.Series:
        out = []
        for ways in tables:
            parts: dict[int, Table] = {}
            for w in ways:
                parts.setdefault(w["chunk"], {})[w["entry"], w["way"]] = (w["cost"], w["audit"])
            out.append(_pack(reduce(join_tables, [parts[c] for c in sorted(parts)])))
        return pd.Series(out, dtype=object)

    @F.pandas_udf("bigint")
    def illegal(initials: pd.Series) -> pd.Series:
        return pd.Series([illegal_pairs(s) for s in initials], dtype="int64")
    return solve, fold, illegal


# ---------------------------------------------------------------- faults

def place_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """Turns with their place (from 1) and first fault (``blank``, ``duplicate``, ``truncated`` or null)."""
    said = F.coalesce(F.col(text), F.lit(" "))
    role_col = F.coalesce(F.col(role), F.lit(" "))
    rows = number_rows(conversations.select(
        F.col(conv_id).alias("conv_id"), conversation_key(conv_id).alias("_key"),
        F.col(turn).cast("bigint").alias("_turn"), role_col.alias("role"), said.alias("text"),
        turn_digest(role_col, said).alias("_md5")))
    tail = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    narrow = rows.select("_uid", "_key", "_md5", tail.alias("_tail")).join(
        sums_before(rows, F.lit(1).cast("bigint"), "_before"), "_uid", "inner") \
        .withColumn("place", F.col("_before") + 1)
    narrow = materialize(narrow.select("_uid", "_key", "_md5", "place", "_tail"))
    seen = narrow.groupBy("_key", "_md5").agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("_n")) \
        .where("_n > 1").select("_key", "_md5", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    judged = narrow.withColumn("_salt", F.pmod("place", F.lit(SALTS)).cast("int")) \
        .join(seen, ["_key", "_md5", "_salt"], "left")
    fault = F.when(F.col("_tail") == "", "blank").when(F.col("place") > F.col("_first"), "duplicate") \
        .when(~F.col("_tail").isin(".", "!", "?"), "truncated")
    return rows.join(judged.select("_uid", "place", fault.alias("fault")), "_uid", "inner") \
        .select("conv_id", "_key", "_turn", "place", "role", "text", "fault")


def _code(fault: Column, initial: Column) -> Column:
    return F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(initial)).otherwise(initial)


def plan_repairs(turns: DataFrame) -> DataFrame:
    """Per conversation of ``place_turns``: ``gaps``, the faults' counts, ``illegal`` neighbours, and
    the least ``cost`` and ``audit``."""
    solve, fold, illegal = _udfs()
    letter = F.left("role", F.lit(1))
    initial = F.when(letter.isin("s", "u", "a"), letter).otherwise("o")
    chunk = F.floor((F.col("place") - 1) / F.lit(CHUNK))
    spelled = lambda field: F.array_join(F.transform("_c", lambda c: c[field]), "")
    chunks = turns.select("conv_id", "_key", chunk.alias("chunk"), "place", "fault", initial.alias("_initial")) \
        .groupBy("_key", "chunk").agg(
            F.first("conv_id").alias("conv_id"),
            F.sort_array(F.collect_list(F.struct("place", _code(F.col("fault"), F.col("_initial")).alias("code"),
                                                 F.col("_initial").alias("initial")))).alias("_c"),
            *[F.count_if(F.coalesce(F.col("fault") == name, F.lit(False))).alias(name)
              for name in ("blank", "duplicate", "truncated")]) \
        .select("_key", "chunk", "conv_id", "blank", "duplicate", "truncated",
                spelled("code").alias("codes"), spelled("initial").alias("initials"))
    # one row per chunk of a conversation goes through this window
    along = Window.partitionBy("_key").orderBy("chunk")
    chunks = chunks.withColumn("_last", F.lead("chunk").over(along).isNull()) \
        .withColumn("_before", F.coalesce(F.right(F.lag("initials").over(along), F.lit(1)), F.lit("")))
    solved = materialize(chunks.select(
        "_key", "chunk", "conv_id", "blank", "duplicate", "truncated",
        illegal(F.concat("_before", "initials")).alias("illegal"),
        solve("codes", F.col("chunk") == 0, "_last").alias("_table")))
    tables = solved.select("_key", "chunk", "_table")
    while not tables.where("chunk > 0").isEmpty():
        ways = F.transform("_table", lambda t: F.struct("chunk", *[t[f].alias(f) for f in ("entry", "way", "cost", "audit")]))
        tables = materialize(tables.groupBy("_key", F.floor(F.col("chunk") / F.lit(FOLD)).alias("_next")).agg(
            F.flatten(F.collect_list(ways)).alias("_ways"))
            .select("_key", F.col("_next").alias("chunk"), fold("_ways").alias("_table")))
    found = tables.select("_key", F.get("_table", F.lit(0))["cost"].alias("cost"),
                          F.get("_table", F.lit(0))["audit"].alias("audit"))
    counts = solved.groupBy("_key").agg(
        F.first("conv_id").alias("conv_id"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    spans = turns.where("_turn IS NOT NULL").select("_key", "_turn").distinct().groupBy("_key").agg(
        (F.max("_turn") - F.min("_turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    return counts.join(spans, "_key", "left").join(found, "_key", "inner").select(
        "_key", "conv_id", F.coalesce("gaps", F.lit(0).cast("bigint")).alias("gaps"), "blank", "duplicate",
        "truncated", "illegal", "cost", "audit")


# ---------------------------------------------------------------- applying a repair

def _apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired turns from rows sorted by (key, place); a conversation's audit comes first, at place 0."""
    columns = ["_key", "place", "role", "text", "edit"]
    key, audit, at, state, place = None, "", 0, START, 0

    def inserted(out):
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            role, at, place = FREE[state], at + 1, place + 1
            state = NEXT[state][role]
            out.append((key, place, WORDS[role], "", "I"))
    for frame in frames:
        out = []
        for k, p, role, text, plan in zip(frame["_key"], frame["place"], frame["role"], frame["text"], frame["audit"]):
            inserted(out)
            if p == 0:
                key, audit, at, state, place = k, plan, 0, START, 0
                continue
            letter, at = audit[at], at + 1
            if letter == "D":
                continue
            if letter == "R":
                role = WORDS[FREE[state]]
            state, place = NEXT[state][role[0]], place + 1
            out.append((key, place, role, text, letter))
        yield pd.DataFrame(out, columns=columns)
    out = []
    inserted(out)
    yield pd.DataFrame(out, columns=columns)


def apply_repairs(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """Repaired turns: ``_key`` (of the conversation), ``place, role, text, edit`` (K, R or I). A conversation
    streams through one task, in batches; its rows come out in order."""
    rows = turns.select("_key", "place", "role", "text", F.lit(None).cast("string").alias("audit"))
    heads = plans.select("_key", F.lit(0).cast("bigint").alias("place"),
                         *[F.lit(None).cast("string").alias(c) for c in ("role", "text")], "audit")
    return rows.unionByName(heads).repartition("_key").sortWithinPartitions("_key", "place").mapInPandas(
        _apply, "_key string, place bigint, role string, text string, edit string")


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of ``role:text`` lines per conversation, streamed over repaired turns in order."""
    key, state = None, None
    for frame in frames:
        done = []
        for k, role, text in zip(frame["_key"], frame["role"], frame["text"]):
            if k == key:
                state.update(f"\n{role}:{text}".encode())
                continue
            if key is not None:
                done.append((key, state.hexdigest()))
            key, state = k, hashlib.sha256(f"{role}:{text}".encode())
        yield pd.DataFrame(done, columns=["_key", "repaired_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["_key", "repaired_sha256"])


def repair(conversations: DataFrame, **names) -> tuple[DataFrame, DataFrame]:
    """Plans per conversation, with ``repaired_sha256`` of the repaired ``role:text`` lines, and the
    repaired turns (``conv_id, place, role, text, edit``)."""
    turns = materialize(place_turns(conversations, **names))
    plans = materialize(plan_repairs(turns))
    repaired = apply_repairs(turns, plans)
    digests = repaired.mapInPandas(_digest, "_key string, repaired_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return plans.join(digests, "_key", "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", none)), \
        repaired.select(F.when(F.col("_key") != "-", F.substring("_key", 2, 40).cast("bigint")).alias("conv_id"),
                        "place", "role", "text", "edit")


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults at places fixed by crc32(``conv_id:turn``) mod 20: 0 drops the turn, 1 empties
    its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's. A null is one space."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("_kind")
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind)
    is_kind = lambda k: F.col("_kind") == k
    return rows.where(~is_kind(0)).select(
        "conv_id", "turn", F.when(is_kind(4), "user").otherwise(F.col("role")).alias("role"),
        F.when(is_kind(1), "").when(is_kind(2), F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(is_kind(3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
