"""MinHash banding against all pairs: classes, recall of links, hot buckets, odd texts."""

import random

import numpy as np
import pytest

from tidepool.functions import minhash as sketch
from tidepool.operators import minhash

SCHEMA = "seq bigint, message string"


def norm(text):
    return " ".join((text or "").lower().split())


def brute_classes(rows, similarity=.8):
    sets = [sketch.shingles(norm(t), 5) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= similarity:
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    groups = {}
    for i, (seq, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(seq)
    return sorted(tuple(sorted(g)) for g in groups.values())


def classes(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.class_id, []).append(r)
    for low, rows in groups.items():
        assert low == min(r.seq for r in rows)
        assert all(r.class_size == len(rows) and r.is_near_copy == (r.seq != low) for r in rows)
    return sorted(tuple(sorted(r.seq for r in g)) for g in groups.values())


def family(rng, size, vocab, words=60, edits=(1, 2, 3, 8)):
    base = rng.choices(vocab, k=words)
    out = [" ".join(base)]
    for _ in range(size - 1):
        copy = list(base)
        for _ in range(rng.choice(edits)):
            copy[rng.randrange(words)] = f"new{rng.randrange(1000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("cell", [4, 256])
def test_classes_match_all_pairs(spark, cell):
    rng = random.Random(cell)
    vocab = [f"w{i}" for i in range(300)]
    texts = [None, "", "  ", "one", "One", "one two", "one two three four five", "ONE two  three\tfour five", "five four three two one"]
    for size in (1, 2, 5, 40):
        texts += family(rng, size, vocab)
    shared = " ".join(rng.choices(vocab, k=40))  # half of each text: meets in buckets, links with none
    texts += [shared + " " + " ".join(rng.choices(vocab, k=25)) for _ in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    rows += [(1000, texts[3]), (1001, texts[5])]
    got = classes(minhash.near_classes(spark.createDataFrame(rows, SCHEMA).repartition(4), cell=cell))
    assert got == brute_classes(rows)


def test_recall_of_links_at_the_threshold(spark):
    """Pairs of similarity 0.8 to 0.85 from many independent families."""
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(5000)]
    rows, wanted = [], 0
    for k in range(150):
        base = rng.choices(vocab, k=100)
        copy = list(base)
        for at in rng.sample(range(0, 100, 12), 2):  # two apart edits: 86 of 106 shingles are common, 0.81
            copy[at] = "changed"
        pair = [" ".join(base), " ".join(copy)]
        sets = [sketch.shingles(t, 5) for t in pair]
        s = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        wanted += s >= .8
        rows += [(2 * k, pair[0]), (2 * k + 1, pair[1])]
    found = sum(len(g) == 2 for g in classes(minhash.near_classes(spark.createDataFrame(rows, SCHEMA))))
    assert wanted >= 100 and found >= .99 * wanted


def test_repeated_and_missing_ids(spark):
    rows = [(5, "a b c d e f"), (5, "x y z u v w"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "x y z u v w")]
    got = sorted((r.seq, r.class_id, r.class_size) for r in minhash.near_classes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(5, 5, 4)] * 3 + [(7, 5, 4)]  # classes of one least id are counted together
    assert minhash.near_classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_signature_steps_and_permutations(monkeypatch):
    a, b = (np.array(p, dtype=np.int64) for p in sketch.permutations(10))
    ids = np.array(sorted(random.Random(1).sample(range(2**60), 500)), dtype=np.int64)
    want = [min((int(x) * (int(i) % sketch.PRIME) + int(y)) % sketch.PRIME for i in ids) for x, y in zip(a, b)]
    monkeypatch.setattr(sketch, "STEP", 7)
    assert sketch.signature(ids, a, b).tolist() == want


def test_a_task_skips_what_an_earlier_band_compares():
    ids = np.arange(50)
    one, two = (True, 1, 1, ids, np.array([4, 5])), (True, 2, 2, ids, np.array([4, 5]))
    assert minhash.meeting_links(0, [one, two], .8) == [(1, 2)]
    assert minhash.meeting_links(1, [one, two], .8) == []


def test_sketches_leave_a_batch_in_parts(monkeypatch):
    """One batch of texts comes back as several small arrays, rows and values as of one text at a time."""
    import pyarrow as pa
    texts = [" ".join(f"w{(i * 7 + j) % 90}" for j in range(i % 60)) for i in range(80)]
    one = sketch._udf.__wrapped__(5, 4, 5).func
    want = [one(iter([pa.array([t])])) for t in texts]
    want = [next(w)[0].as_py() for w in want]
    monkeypatch.setattr(sketch, "HELD_IDS", 200)
    parts = list(one(iter([pa.array(texts)])))
    assert len(parts) > 5 and max(len(p.field("ids").flatten()) for p in parts) <= 200 + 60
    assert [row for p in parts for row in p.to_pylist()] == want
    assert [len(w["ids"]) for w in want] == [len(sketch.shingles(t, 5)) for t in texts]
