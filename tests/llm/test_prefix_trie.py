"""Prefix trie against a plain trie: segments, partition boundaries, copies, empty conversations."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tidepool.llm import prefix_trie
from tidepool.llm.conversation_queries import ORACLE_SQL, op12_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, Depth int"
TURNS = "conv bigint, place bigint, digest string, words bigint"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def order(rows):
    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
    return [(r[2] or "", r[3] or "") for r in sorted(rows, key=key)]


def rebuild(rows):
    by = {}
    for r in rows:
        if r[0] is not None:
            by.setdefault(r[0], []).append(r)
    own = {c: order(v) for c, v in by.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs, weight):
    """{(smallest member, depth): (parent, members, children, leaves, saved, ends)}."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    below = {}
    for path in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[path]) - 1) * (weight(path[-1]) if path else 0)
        sub = [below[k] for k in kids.get(path, [])]
        below[path] = (sum(s[0] for s in sub) or 1, own + sum(s[1] for s in sub))
    out = {}
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(path))
        out[min(members), len(path)] = (min(nodes[path[:-1]]) if path else None, len(members), len(kids.get(path, [])),
                                        *below[path], hashlib.sha256(ends.encode()).hexdigest())
    return out


def result(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in rows}
    assert len(out) == len(rows)
    return out


def talk_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in list(range(0, 90, 1)) + [200, 1000003]:
        for i in range(rng.choice([1, 2, 3, 9])):
            rows.append((c, rng.choice([i, None, i // 2]), rng.choice(["user", "assistant", None]),
                         rng.choice(["a b", "", None, "same text here", "x\ty"]), "c", 1))
    rows += [(None, 1, "user", "belongs to none", "c", 1)] * 2 + rows[:5]
    return rows


def test_trie_of_rebuilt_conversations(spark, tmp_path):
    rows = talk_rows(3)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op12_prefix_trie(spark, str(tmp_path))
    assert result(got) == brute(rebuild(rows), lambda t: words(t[1]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.sql(ORACLE_SQL["op12_prefix_trie"])
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_trie_over_segments_and_boundaries(spark, segment, monkeypatch):
    """Hundreds of copies and near copies over eight partitions, deeper than a segment."""
    monkeypatch.setattr(prefix_trie, "MANY_CHILDREN", 5)
    rng = random.Random(segment)
    base = [(f"d{i}", i % 4) for i in range(11)]
    convs = {}
    for c in rng.sample(range(-50, 2000), 400):
        turns = base[:rng.choice([0, 3, 6, 11, 11, 11])]
        convs[c] = turns + [(f"e{rng.randrange(3)}", 2) for _ in range(rng.choice([0, 0, 1, 4]))]
    rows = [(c, i + 1, t[0], t[1]) for c, turns in convs.items() for i, t in enumerate(turns)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(4),
                                  spark.createDataFrame([(c,) for c in convs], "conv bigint"), segment=segment)
    assert result(got) == brute(convs, lambda t: t[1])


def test_long_copies(spark):
    """Two conversations of 3000 equal turns and one that leaves them late."""
    turns = [(f"t{i}", 1) for i in range(3000)]
    convs = {5: turns, 4: turns, 9: turns[:2900] + [("other", 7)], 1: [("alone", 1)]}
    rows = [(c, i + 1, t[0], t[1]) for c, ts in convs.items() for i, t in enumerate(ts)]
    got = result(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS),
                                         spark.createDataFrame([(c,) for c in convs], "conv bigint")))
    assert len(got) == 1 + 3000 + 1 + 1
    assert got[1, 0][1:5] == (4, 2, 3, 2 * 2900 + 100)
    assert got[4, 2900][1:5] == (3, 2, 2, 2 + 100)
    assert got[9, 2901][:5] == (4, 1, 0, 1, 0)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    got = prefix_trie.prefix_trie(*prefix_trie.share_openings(prefix_trie.order_turns(empty)))
    assert got.collect() == []
