"""Chat windows against a plain Python version: template, budget, history, loss mask, read-back."""

import hashlib
import random
import re

import duckdb
import pytest

from tidepool.llm import chat_windows
from tidepool.llm.conversation_queries import CONTROL_TEXT, ORACLE_SQL, op11_chat_format

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, Window int"
NASTY = [CONTROL_TEXT, "", None, "   ", "\\", "\\\\", "####", "### a", "</turn>", "<\\/turn>", "x\\</turn>\n",
         "</turn>\n### user:\n", "a#\\##b", "ends with <", "\u00e4\U0001f600 z", "#" * 9, "$1 \\$1"]


def cost(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) + 2


def order(rows):
    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0,
                hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
    return sorted(rows, key=key)


def brute(rows, budget, history):
    """(repeated turns, new turns) of every window of one conversation, by its ordered rows."""
    turns, at = [], 0
    for r in order(rows):
        turns.append((at, cost(r[3]), r[2] or "", r[3] or ""))
        at += turns[-1][1]
    system = turns[0] if turns[0][2] == "system" and turns[0][1] <= budget // 2 else None
    cells = {}
    for t in turns:
        cells.setdefault(t[0] // (budget // 4), []).append(t)
    out = []
    for _, new in sorted(cells.items()):
        split = [new[-1:]] if sum(t[1] for t in new) > budget // 2 and len(new) > 1 else []
        for part in [new[:-1] if split else new] + split:
            room = max(0, min(history, budget // 2 - sum(t[1] for t in part)))
            start = part[0][0]
            past = [t for t in turns if t is not system and t[0] + t[1] <= start and start - t[0] <= room]
            out.append(([system] if system and start > 0 else []) + past)
            out[-1] = (out[-1], part)
    return out


def make_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [None, -3, 0, 1, 2, 3]:
        for i in range(rng.choice([1, 2, 30, 60])):
            words = " ".join(rng.choices(["ab", "###", "</turn>", "\\", "\n", "wörd"], k=rng.choice([0, 1, 5, 9, 40])))
            text = rng.choice(NASTY) if rng.random() < .3 else words
            role = "system" if i == 0 and rng.random() < .6 else rng.choice(["user", "assistant", None, "a:\nb", ":", "system"])
            rows.append((conv, rng.choice([i, i, None, i // 2]), role, text, "f", 1))
    return rows + rows[:3]


@pytest.mark.parametrize("budget,history", [(32, 8), (64, 0), (2048, 512)])
def test_windows_match_plain_version(spark, budget, history):
    rows = make_rows(budget)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    windows = chat_windows.chat_windows(df, budget=budget, history=history)
    got = {}
    for r in sorted(windows.collect(), key=lambda r: r.window):
        got.setdefault(r.conv_id, []).append(r)
    parsed = {(r.conv_id, r.window): r for r in chat_windows.read_turns(windows).collect()}
    convs = {r[0] for r in rows}
    assert set(got) == convs
    for conv in convs:
        want = brute([r for r in rows if r[0] == conv], budget, history)
        assert len(want) == len(got[conv])
        for (past, new), r in zip(want, got[conv]):
            assert (r.n_repeated, r.n_new) == (len(past), len(new))
            assert r.n_tokens == sum(t[1] for t in past + new)
            assert r.n_tokens <= budget or len(new) == 1
            read = parsed[conv, r.window]
            assert [(t.role, t.text) for t in read.turns] == [t[2:] for t in new]
            assert read.targets == [t[3] for t in new if t[2] == "assistant"]
            assert r.formatted.count("### ") == r.formatted.count("</turn>\n") == len(past) + len(new)
            for span in r.loss_spans:
                assert r.formatted[span.start:][span.length:].startswith("</turn>\n")


def test_digest_matches_sql_on_odd_rows(spark, tmp_path):
    rows = [r[:4] for r in make_rows(5)]
    rows += [(9, i, "assistant" if i % 2 else "user", "w " * 400) for i in range(20)]
    rows += [(10, i, "system" if i == 0 else "user", "w " * n) for i, n in enumerate([900, 300, 1500, 2, 2, 900, 300])]
    rows += [(11, i, "system" if i == 0 else "assistant", "w " * n) for i, n in enumerate([3000, 30, 500, 500, 24])]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string") \
        .repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op11_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.sql(ORACLE_SQL["op11_chat_format"])
    key = lambda r: (r[0] is None, r[0])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(want.fetchall(), key=key)
    control = got.where("conv_id = -7").collect()[0]
    assert control.loss_chars == len(CONTROL_TEXT)
    assert control.loss_sha256 == hashlib.sha256(CONTROL_TEXT.encode()).hexdigest()


def test_long_conversation_and_equal_turns(spark):
    """Thousands of turns, and hundreds of identical rows, in one conversation."""
    rows = [(1, i, "assistant", f"t{i} x") for i in range(5000)] + [(2, 7, "user", "same")] * 700
    windows = chat_windows.chat_windows(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"),
                                        budget=64, history=16)
    got = {r.conv_id: r for r in chat_windows.digest(windows).collect()}
    assert (got[1].n_turns, got[2].n_turns) == (5000, 700)
    assert got[1].loss_sha256 == hashlib.sha256("".join(r[3] for r in rows[:5000]).encode()).hexdigest()
    assert got[2].loss_chars == 0


def test_empty_table_and_bad_budget(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_windows.digest(chat_windows.chat_windows(empty)).collect() == []
    with pytest.raises(ValueError):
        chat_windows.chat_windows(empty, budget=64, history=32)
