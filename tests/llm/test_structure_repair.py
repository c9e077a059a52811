"""Structure repair against exhaustive search over the edits, chunked and whole."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidepool.llm import structure_repair as repair
from tidepool.llm.conversation_queries import op13_structure_repair

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def brute_plan(codes, entry=0, accept=(0, 3)):
    """Least (cost, audit) by trying every edit, at most 2n/5 + 2 insertions."""
    n = len(codes)

    @lru_cache(maxsize=None)
    def best(i, q, inserts):
        options = [(0, "")] if i == n and q in accept else []

        def add(cost, letter, rest):
            if rest is not None:
                options.append((cost + rest[0], letter + rest[1]))
        if inserts:
            for r in "ua":
                if r in NEXT[q]:
                    add(5, "I", best(i, NEXT[q][r], inserts - 1))
        if i < n:
            c = codes[i]
            add(2, "D", best(i + 1, q, inserts))
            if c != "x":
                extra = 5 * c.isupper()
                if c.lower() in NEXT[q]:
                    add(extra, "K", best(i + 1, NEXT[q][c.lower()], inserts))
                for r in "ua":
                    if r in NEXT[q]:
                        add(1 + extra, "R", best(i + 1, NEXT[q][r], inserts))
        return min(options) if options else None
    return best(0, entry, 2 * n // 5 + 2)


def random_codes(rng, n):
    return "".join(rng.choices("suaoxSUAO", weights=[2, 6, 6, 1, 2, 1, 2, 2, 1], k=n))


def test_bidirectional_search_finds_the_least_audit():
    rng = random.Random(1)
    for _ in range(1500):
        codes = random_codes(rng, rng.randrange(13))
        assert repair.least_repair(codes, 0, (0, 3)) == brute_plan(codes), codes
    for _ in range(300):
        codes, entry, way = random_codes(rng, rng.randrange(7)), rng.randrange(4), rng.randrange(4)
        assert repair.least_repair(codes, entry, (way,)) == brute_plan(codes, entry, (way,)), (codes, entry, way)


def test_joined_chunk_tables_equal_the_whole():
    rng = random.Random(2)
    for _ in range(200):
        codes = random_codes(rng, rng.randrange(2, 40))
        cuts = sorted(rng.sample(range(1, len(codes)), min(len(codes) - 1, rng.randrange(1, 5))))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        whole = repair.chunk_table(parts[0], True, False)
        for k, part in enumerate(parts[1:], 1):
            whole = repair.join_tables(whole, repair.chunk_table(part, False, k == len(parts) - 1))
        assert whole[0, 0] == repair.least_repair(codes, 0, (0, 3))


def brute_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        show = lambda v: " " if v is None else str(v)
        role, text = show(role), show(text)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute_row(rows):
    """The contract's columns of one conversation's damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0,
                                       hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
    turns = {r[1] for r in rows if r[1] is not None}
    seen, faults, codes = set(), [], ""
    for _, _, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        code = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else code.upper() if fault else code
    pairs = [(a[2][:1], b[2][:1]) for a, b in zip(rows, rows[1:])]
    cost, audit = brute_plan(codes)
    lines, left, state = [], list(rows), 0
    for letter in audit:
        free = "a" if state == 2 else "u"
        if letter == "I":
            role, text = {"u": "user", "a": "assistant"}[free], ""
        else:
            _, _, role, text = left.pop(0)
            if letter == "D":
                continue
            role = {"u": "user", "a": "assistant"}[free] if letter == "R" else role
        state = NEXT[state][role[0]]
        lines.append(f"{role}:{text}")
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in {("s", "u"), ("u", "a"), ("a", "u")} for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talks(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, -4, *range(60), 2**60 + 1]:
        for i in range(rng.choice([1, 2, 4, 7, 11])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "Assistant"])
            text = rng.choice(["Fine.", "Really?!", "cut off", None, "", " \t ", "ends. \n", "two\nlines!", "ä。", "x" * 50 + ".", "."])
            rows.append((conv, rng.choice([i, i, i * 2, None, 0]), role, f"{text} {i}." if text and rng.random() < .5 else text, "e", 1))
    return rows + rows[:6]


@pytest.mark.parametrize("chunk", [2, 1024])
def test_query_matches_exhaustive_search(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "FOLD", 2)
    rows = talks(chunk)
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, edit string, Place int") \
        .repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in op13_structure_repair(spark, str(tmp_path)).collect()}
    want = {r[0]: [] for r in rows}
    for r in brute_damage(rows):
        want[r[0]].append(r)
    assert got.keys() == want.keys()
    for conv, left in want.items():
        assert got[conv] == brute_row(left), conv


def test_repaired_turns_follow_the_pattern(spark):
    rows = [r[:4] for r in talks(9)]
    plans, turns = repair.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    by = {}
    for t in sorted(turns.collect(), key=lambda t: t.place):
        by.setdefault(t.conv_id, []).append(t)
    for p in plans.collect():
        out = by.get(p.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in out))
        assert [t.place for t in out] == list(range(1, len(out) + 1))
        assert "".join(t.edit for t in out) == p.audit.replace("D", "")


def test_long_conversation_with_one_turn_repeated(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Line {i}.") for i in range(5000)] + [(1, 7, "user", "Again.")] * 300
    plans, turns = repair.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    plan = plans.collect()[0]
    assert (plan.duplicate, plan.cost, plan.audit.count("D"), turns.count()) == (299, 300 * 2, 300, 5000)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string") \
        .write.parquet(f"{tmp_path}/conversations.parquet")
    assert op13_structure_repair(spark, str(tmp_path)).collect() == []
