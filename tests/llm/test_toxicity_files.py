"""Word counts in files: lookups over several files, what a model carries, scores by piece."""

import pickle
import random

import numpy as np
import pyarrow as pa

from tidepool.llm import toxicity


def test_counts_are_found_in_files_and_not_carried(spark, monkeypatch):
    rng = random.Random(8)
    vocab = [f"{a}{b}{c}{d}" for a in "bdfg" for b in "aeiou" for c in "lmnr" for d in ("st", "x", "é")]
    rows = [(" ".join(rng.choices(vocab, k=20)), rng.randrange(2)) for _ in range(200)]
    monkeypatch.setattr(toxicity, "FILE_KEYS", 50)
    model = toxicity.count_model(spark.createDataFrame(rows, "text string, toxic int").repartition(3))
    assert len(model.counts.paths) > 3
    seen = {}
    for text, toxic in rows:
        for key in {k for w in text.split() for k in toxicity.features(w)}:
            t, n = seen.get(key, (0, 0))
            seen[key] = (t + toxic, n + 1)
    assert model.keys.tolist() == sorted(seen)
    wanted = np.array([*seen, 1, -1, 2**62], dtype=np.int64).reshape(-1, 1)
    toxic, every = model.counts.find(wanted)
    assert [(int(t), int(n)) for t, n in zip(toxic[:, 0], every[:, 0])] == [seen.get(k, (0, 0)) for k in wanted[:, 0].tolist()]
    sent = pickle.dumps(model)  # after lookups: maps stay behind
    assert len(sent) < 400 * len(model.counts.paths) + 2000
    again = pickle.loads(sent)
    assert again.log_odds(["bale", "unknown"]).tolist() == model.log_odds(["bale", "unknown"]).tolist()


def test_no_labelled_words(spark):
    model = toxicity.count_model(spark.createDataFrame([], "text string, toxic int"))
    assert model.keys.tolist() == [] and model.log_odds(["x"]).tolist() == [0.0] and len(model.log_odds([])) == 0


def test_scores_by_piece_equal_scores_by_token(spark, monkeypatch):
    """Pieces of none, one or many tokens, memos that begin anew between and inside the texts."""
    rng = random.Random(3)
    rows = [("bad worse, good-bad", 1), ("good fine", 0)] * 5
    model = toxicity.count_model(spark.createDataFrame(rows, "text string, toxic int"))
    texts = ["".join(rng.choices(["bad", "good", ",", " ", "-", "\n", "日本", "é", "x", "..."], k=rng.randrange(40))) for _ in range(300)]
    texts += [None, "", " ", "bad"]
    for memo in (10**6, 25):
        monkeypatch.setattr(toxicity, "MEMO_PIECES", memo)
        monkeypatch.setattr(toxicity, "MEMO_WORDS", memo)
        got = list(toxicity.Scorer(model).scores(texts))
        for text, s in zip(texts, got):
            want = model.log_odds(toxicity.words_of(text)) - toxicity.DRIFT
            assert np.allclose(s, want) and len(s) == len(want)


def test_texts_of_few_rows_leave_a_batch_together(monkeypatch):
    """Every pass takes a large batch in slices, all rows in order; a word piece is held once."""
    batch = pa.RecordBatch.from_pydict({"text": [f"t{i}" for i in range(1100)]})
    assert pa.Table.from_batches(toxicity._parts(iter([batch]))).equals(pa.Table.from_batches([batch]))
    asked = []

    class Asked:
        def __init__(self, model):
            pass

        def segments(self, texts):
            asked.extend(texts)
            assert len(texts) <= toxicity.BATCH_ROWS < 1100
            return [(int(t[1:]), []) for t in texts]
    monkeypatch.setattr(toxicity, "Scorer", Asked)
    found = [n for part in toxicity._best(iter([batch]), None) for n in part.column("tokens").to_pylist()]
    assert found == list(range(1100)) and asked == batch.column("text").to_pylist()
    piece = "".join(["wo", "rd"])
    assert toxicity.piece_words(piece)[0] is piece and list(toxicity.piece_words("a-b")) == ["a", "b"]


def test_tokens_of_many_texts_equal_those_of_each():
    rng = random.Random(11)
    bits = ["Word", "École", "İ", "ΑΣ", "don't", "a-b", "3.14", ",", "--", "_", "^", "©", "😀", "日本語", "ไทย", "́", "÷",
            "­", "\xa0", "　", "\x1c", "\x85", "\x00", " ", "  ", "\n", "\t", "\x0b", "(", "’", "Привет"]
    texts = [None, "", " "] + ["".join(rng.choices(bits, k=rng.randrange(25))) for _ in range(3000)] + [""]
    words, at, before = toxicity.PieceTokens().of(texts)
    assert len(set(words)) == len(words) and len(before) == len(texts) + 1
    for i, t in enumerate(texts):
        assert [words[j] for j in at[before[i]:before[i + 1]]] == [w.lower() for w in toxicity.words_of(t)]
    assert toxicity.PieceTokens().of([None, " "])[2].tolist() == [0, 0, 0]


def test_latin_words_are_not_read_one_by_one(spark, monkeypatch):
    """New Latin words of any case, with marks around them, take no call each, counted or scored."""
    read = []
    monkeypatch.setattr(toxicity, "piece_words", lambda piece: read.append(piece) or toxicity.words_of(piece))
    texts = [" ".join(f"(Wörd{i}x{j}, WORD{i}x{j}." for j in range(50)) for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": pa.array([i % 2 for i in range(100)], pa.int32())})
    counted = pa.Table.from_batches(list(toxicity._count(iter([batch])))).to_pylist()
    n = {r["key"]: r["n"] for r in counted}
    assert all(n[toxicity.features(w)[-1]] == 1 for w in ("wörd7x3", "word99x49")) and n[toxicity.features("word")[0]] == 50
    model = toxicity.count_model(spark.createDataFrame([("word1x1 bad", 1), ("wörd2x2", 0)], "text string, toxic int"))
    got = list(toxicity.Scorer(model).scores(texts))
    assert [len(s) for s in got] == [100] * 100 and read == []
    assert np.allclose(got[1][:4], model.log_odds(["wörd1x0", "word1x0", "wörd1x1", "word1x1"]) - toxicity.DRIFT)


def test_documents_are_counted_once_per_key_in_steps(monkeypatch):
    """Small steps and slices give the counts of a plain count per document."""
    rng = random.Random(2)
    vocab = [f"{a}{b}ing{c}" for a in "bdf" for b in "aeiou" for c in ("", "s", "er", "日本")] + ["a", "I", "x-y", "don't"]
    texts = [None, "", "a a A"] + [" ".join(rng.choices(vocab, k=rng.randrange(30))) for _ in range(200)]
    sides = [rng.randrange(2) for _ in texts]
    monkeypatch.setattr(toxicity, "TEXT_STEP", 500)
    monkeypatch.setattr(toxicity, "BATCH_ROWS", 64)
    monkeypatch.setattr(toxicity, "HELD_KEYS", 100)
    want = {}
    for text, side in zip(texts, sides):
        for key in {k for w in toxicity.words_of(text) for k in toxicity.features(w)}:
            want[key, side] = want.get((key, side), 0) + 1
    got = {}
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "toxic": pa.array(sides, pa.int32())})
    for r in pa.Table.from_batches(list(toxicity._count(iter([batch])))).to_pylist():
        got[r["key"], r["toxic"]] = got.get((r["key"], r["toxic"]), 0) + r["n"]
    assert {s: got.pop((None, s)) for s in (0, 1)} == {s: sides.count(s) for s in (0, 1)} and got == want
