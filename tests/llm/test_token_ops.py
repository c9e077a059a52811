"""Token files and packing: exact round trips through the public tokenizers."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tidepool.llm import packing, tokens  # noqa: E402

ODD = [None, "", " ", "  lead", "trail  ", "a  b", "a \n b", "a\n\nb c", "tab\tone two", "x" * 200 + " y",
       "Ünï cödé  ’s it's we'll", "é ä ́x", "<|endoftext|> a <|endoftext|>b <|startoftext|>",
       "nbsp here  em", "日本語 テキスト 😀 👩‍👩‍👧", "1234 5.67 -8", "\x1c sep \x85 z", "ΑΣ ΑΣ. Σ", "İstanbul I"]


def plain(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name, monkeypatch):
    rng = random.Random(7)
    alphabet = ["word", "It's", " ", "  ", "\n", "é", "Σ", "9", "<|endoftext|>", "-", " ", "́", "x" * 60]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(400)]
    ids = plain(name)
    want = [ids(t) for t in texts]
    enc = tokens.Encoder(public_tokenizers.path(name))
    for _ in range(2):
        got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
        assert got == want
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)] == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_with_added_tokens_equals_unmodified_library(name):
    rng = random.Random(9)
    alphabet = ["word", " ", "  ", "\n", "é", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "-"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(400)]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    enc = tokens.Encoder(public_tokenizers.path(name), added_tokens=True)
    for t, b in zip(texts, enc.encode(texts)):
        assert np.frombuffer(b, enc.dtype).tolist() == library.encode(t or "", add_special_tokens=False).ids


class Counting:
    """The library's tokenizer, counting the strings given to it."""

    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def encode(self, what, **more):
        self.given += len(what) if isinstance(what, list) else 1
        return self.inner.encode(what, **more)

    def encode_batch_fast(self, what, **more):
        self.given += sum(len(x) if isinstance(x, list) else 1 for x in what)
        return self.inner.encode_batch_fast(what, **more)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_word_is_merged_once_whatever_marks_follow(name):
    words = ["".join(w) for w in zip(*[iter("anthereinouedstionlyhawhshbleor" * 20)] * 7)]
    words = sorted(set(words))
    marks = ["", ".", ",", "!!", "***", ".###", "%%%", ")", "...", "?!", "&&&", "_"]
    texts = [" ".join(w + m for w in words) for m in marks]
    enc = tokens.Encoder(public_tokenizers.path(name))
    enc.model, enc.plain = Counting(enc.model), Counting(enc.plain)
    ids = plain(name)
    assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)] == [ids(t) for t in texts]
    assert len(words) > 20
    assert enc.model.given + enc.plain.given <= 2 * (len(words) + 1) + 2 * len(marks) + 2
    before = enc.model.given + enc.plain.given
    enc.encode(texts)
    assert enc.model.given + enc.plain.given == before


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("memo", [1, 40, 400_000])
def test_marks_cases_and_scripts_equal_library(name, memo, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", memo)
    monkeypatch.setattr(tokens, "CALL_PIECES", 7)
    rng = random.Random(memo)
    heads = ["", "(", "'", "\0", "_", "9"]
    cores = ["Word", "WORD", "word", "Éa", "ÉA", "ß", "ÿ", "ÀÖ", "×", "÷a", "don", "x" * 60, "日本", "Σς", "aΣ", "4", "ªº", "µm"]
    tails = ["", ".", "'s", "'", "'S.", "!!", "_", "__x", "***.", "~`", "\\]^", "\0", "…", "´", "\u0301", "’s"]

    def piece():
        return rng.choice(heads[:1] * 4 + heads) + rng.choice(cores) + rng.choice(tails)

    texts = ["".join(piece() + rng.choice([" ", " ", " ", "\n", "  "]) for _ in range(rng.randrange(1, 9))).strip(" ")
             for _ in range(600)] + ODD
    enc, ids = tokens.Encoder(public_tokenizers.path(name)), plain(name)
    want = [ids(t) for t in texts]
    got = [b for at in range(0, len(texts), 50) for b in enc.encode(texts[at:at + 50])]
    assert [np.frombuffer(b, enc.dtype).tolist() for b in got] == want
    assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)] == want
    assert enc.encode([]) == [] and enc.encode([None, ""]) == [b"", b""]


def test_queries_find_added_tokens_as_the_library(spark, workdir):
    import corpus_pipeline
    from tidepool.llm import queries
    rows = [(1, "see <|endoftext|> here"), (2, "plain text"), (3, "<|startoftext|>a\n<|endoftext|>b"), (4, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{workdir}/documents.parquet")
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    for name, end, got in [
            ("word_bpe_49k.json", 1, queries.op4_token_files(spark, workdir)),
            ("byte_bpe_50k.json", 0, queries.op6_packing(spark, workdir)),
            ("byte_bpe_50k.json", 0, corpus_pipeline.STAGES[-1][1](spark, docs, workdir))]:
        library = Tokenizer.from_file(public_tokenizers.path(name))
        want = {i: crc(library.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows}
        assert {r.doc_id: r.ids_crc32 for r in got.collect()} == want


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, workdir):
    rows = [(i * 3 - 9, t, "x", 1) for i, t in enumerate(ODD * 3)] + [(None, "null id", "", 0), (0, "a b", "", 0)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start string, part int").repartition(3)
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = tokens.write_tokens(df, path, end_id=1, root=f"file://{workdir}/t")
    ids = plain("word_bpe_49k.json")
    for frame in (manifest, tokens.read_manifest(spark, f"file://{workdir}/t")):
        got = sorted(tokens.read_tokens(frame).collect(), key=lambda r: r.start)
        assert len(got) == len(rows)
        assert [r.doc_id is None for r in got] == [True] + [False] * (len(rows) - 1)
        known = [r.doc_id for r in got[1:]]
        assert known == sorted(known)
        want = defaultdict(list)
        for r in rows:
            want[r[0]].append(ids(r[1]) + [1])
        at = 0
        for r in got:
            assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
            want[r.doc_id].remove(r.ids)
            at += r.n_tokens
    flat = np.memmap(manifest.orderBy("part").first().path.removeprefix("file://") + ".ids", "<u2", "r")
    assert flat[:len(got[0].ids)].tolist() == got[0].ids


def test_token_files_of_nothing(spark, workdir):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    manifest = tokens.write_tokens(df, public_tokenizers.path("word_bpe_49k.json"), 1, root=f"{workdir}/t")
    assert tokens.read_tokens(manifest).count() == 0


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= n]
        if fits:
            i = min(fits, key=lambda i: bins[i])
            bins[i] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_document_by_document(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 64, 100])
    lengths = [rng.randrange(1, cap + 1) if rng.random() < 0.6 else rng.randrange(1, 1 + cap // 4)
               for _ in range(rng.randrange(1, 700))]
    counts = {}
    for n in lengths:
        counts[n] = counts.get(n, 0) + 1
    spans = packing.best_fit(counts, cap)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, per, lo, off in spans:
        for x in range(n):
            ranks[length].append(rank + x)
            used[lo + x // per].append((off + x % per * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}
    left = []
    for pieces in used.values():
        at = 0
        for off, length in sorted(pieces):
            assert off == at
            at += length
        assert at <= cap
        left.append(cap - at)
    assert sorted(left) == plain_best_fit(lengths, cap)
    assert packing.best_fit({}, cap) == []


def test_pack_whole_operator(spark):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, "same text here") for i in range(200)]
    rows += [(500 + i, " ".join(rng.choices(["alpha", "beta", "x"], k=rng.randrange(400)))) for i in range(40)]
    rows += [(None, "no id"), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame([(*r, "o") for r in rows], "doc_id bigint, text string, rank string").repartition(5)
    cap, ids = 64, plain("byte_bpe_50k.json")
    got = packing.pack(df, public_tokenizers.path("byte_bpe_50k.json"), 0, capacity=cap).collect()
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(ids(t) + [0])
    docs, bins = defaultdict(list), defaultdict(list)
    for r in got:
        x = np.frombuffer(r.ids, f"<u{r.id_bytes}").tolist()
        assert len(x) == r.length and crc(x) == r.ids_crc32
        docs[r.doc_id].append((r.piece, r.start, x))
        bins[r.sequence_id].append((r.offset, r.length))
    for i, pieces in docs.items():
        if len(want[i]) == 1:
            pieces.sort()
            assert [x for _, _, p in pieces for x in p] == want[i][0]
            assert [p[0] for p in pieces] == list(range(len(pieces)))
            assert all(len(p) == cap for _, _, p in pieces[1:])
            assert len(pieces) == -(-len(want[i][0]) // cap)
    assert len(docs) == len(want)
    lengths = []
    for b in bins.values():
        at = 0
        for off, n in sorted(b):
            assert off == at
            at += n
            lengths.append(n)
        assert at <= cap
    assert len(bins) == len(plain_best_fit(lengths, cap))
    assert packing.pack(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"), 0).count() == 0
