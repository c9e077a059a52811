"""Exact tree against a sequential builder that tries every boundary of every term."""

import os
import random

import pytest

from tidepool import config
from tidepool.operators import cart

SCHEMA = "doc_id bigint, label_code int, weights map<string, bigint>"


def kept(counts):
    return sum(float(c) * float(c) for c in counts) / float(sum(counts))


def brute(rows, depth):
    """{node: (term, threshold, counts)} by trying every boundary."""
    terms = sorted({t for _, _, w in rows for t in w})
    nodes = {}

    def grow(node, part, level):
        counts = [sum(y == k for _, y, _ in part) for k in range(3)]
        best = None
        if sum(c > 0 for c in counts) > 1 and level < depth:
            for t in terms:
                values = sorted({w.get(t, 0) for _, _, w in part})
                for a, b in zip(values, values[1:]):
                    cut = (a + b) / 2
                    left = [sum(y == k for _, y, w in part if w.get(t, 0) <= cut) for k in range(3)]
                    score = kept(left) + kept([c - x for c, x in zip(counts, left)])
                    if best is None or (-score, t, cut) < best:
                        best = (-score, t, cut)
        nodes[node] = (*(best[1:] if best else (None, None)), *counts)
        if best:
            _, t, cut = best
            grow(2 * node, [r for r in part if r[2].get(t, 0) <= cut], level + 1)
            grow(2 * node + 1, [r for r in part if r[2].get(t, 0) > cut], level + 1)
    if rows:
        grow(1, rows, 0)
    return nodes


def brute_predict(nodes, weights):
    node = 1
    while nodes[node][0]:
        node = 2 * node + (weights.get(nodes[node][0], 0) > nodes[node][1])
    counts = nodes[node][2:]
    return config.LABELS[counts.index(max(counts))], max(counts) / sum(counts)


def make(seed, n, noise):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = {t: rng.choice([1, 250_000, 333_333, 500_000, rng.randrange(1, cart.UNIT + 1)])
             for t in ("alpha", "beta", "gamma", "delta") if rng.random() < .5}
        y = 0 if w.get("alpha", 0) > 300_000 else 1 if "beta" in w else 2
        rows.append((i, rng.randrange(3) if rng.random() < noise else y, w))
    return rows + rows[:3]


@pytest.mark.parametrize("n,noise,depth", [(60, .3, 10), (200, .5, 4), (40, 0, 10)])
def test_tree_equals_sequential_builder(spark, n, noise, depth):
    rows = make(n, n, noise)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tree = cart.fit(df, depth=depth)
    want = brute(rows, depth)
    assert {t[0]: t[1:] for t in tree.nodes} == want
    fresh = make(n + 1, 50, 1)
    got = {r.doc_id: r for r in cart.predict(tree, spark.createDataFrame(fresh, SCHEMA)).collect()}
    for i, _, w in fresh:
        label, share = brute_predict(want, w)
        assert got[i].predicted_label == label and abs(got[i].confidence - share) < 1e-12


def test_small_trees(spark, workdir):
    """One class, rows that cannot be told apart, no rows, rows without a label; saved and read again."""
    one = cart.fit(spark.createDataFrame([(1, 2, {"a": 5}), (2, 2, {})], SCHEMA))
    assert one.nodes == ((1, None, None, 0, 0, 2),)
    same = cart.fit(spark.createDataFrame([(1, 0, {"a": 5}), (2, 1, {"a": 5}), (3, None, {"a": 7})], SCHEMA))
    assert same.nodes == ((1, None, None, 1, 1, 0),)
    assert cart.predict(same, spark.createDataFrame([(1, 0, {})], SCHEMA)).first().predicted_label == "complaint"
    none = cart.fit(spark.createDataFrame([], SCHEMA))
    assert none.nodes == () and cart.predict(none, spark.createDataFrame([(1, 0, {})], SCHEMA)).first().confidence is None
    tree = cart.fit(spark.createDataFrame(make(7, 80, .2), SCHEMA))
    tree.save(spark, os.path.join(workdir, "tree"))
    back = cart.load(spark, os.path.join(workdir, "tree"))
    assert back.nodes == tree.nodes
    docs = spark.createDataFrame(make(8, 30, 1), SCHEMA)
    a, b = (sorted(cart.predict(t, docs).select("doc_id", "predicted_label", "confidence").collect()) for t in (tree, back))
    assert a == b
