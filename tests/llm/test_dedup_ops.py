"""Exact dedup and SimHash near-dedup against brute force on small fixtures."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidepool.llm import exact_dedup, simhash
from tidepool.llm.common import components


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


TEXTS = ["a b  c", "a\tb c", " a b c", None, "", "x" * 40, "x" * 40 + " ", "x" * 41, "Ä ö\n\nü",
         "Ä ö ü", "a b c", "y" * 300, "y" * 300, "y" * 299 + "z"]


def group_check(spark, rows, chunk):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string, _uid int, Lang string")
    got = exact_dedup.exact_dedup(df, carry=["doc_id", "text", "_uid", "Lang"], chunk_bytes=chunk).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    for r in got:
        ids = groups[norm(r.text)]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == (min(known) if known else None)
    assert sum(r.kept for r in got) == len(groups)


@pytest.mark.parametrize("chunk", [8, 1 << 16])
def test_exact_dedup_edges(spark, chunk):
    rows = [(i, t, "k", i, "L") for i, t in enumerate(TEXTS)] * 2 + [(None, "a b c", None, None, None),
                                                                     (None, "only", None, 1, "x")]
    random.Random(1).shuffle(rows)
    group_check(spark, rows, chunk)


def test_exact_dedup_splits_colliding_fingerprints(spark, monkeypatch):
    """With a constant fingerprint the chunk comparison alone separates the texts."""
    rows = [(i, t, "k", i, "L") for i, t in enumerate(["aa", "bb", "aa", "cc", "bb", "dd"] * 2)]

    def constant(df, text, uid, chunk_bytes):
        from pyspark.sql import functions as F
        return df.select(uid, F.lit(1).alias("f1"), F.lit(1).alias("f2"),
                         F.octet_length(text).cast("bigint").alias("n_bytes"),
                         F.sha2(text, 256).alias("text_sha256"))
    monkeypatch.setattr(exact_dedup, "fingerprints", constant)
    group_check(spark, rows, 1 << 16)


def test_chunk_hashes_compose():
    data = bytes(random.Random(2).randrange(256) for _ in range(1000))
    tables = [exact_dedup.powers(b, p, 1000) for b, p in zip(exact_dedup.BASES, exact_dedup.PRIMES)]
    whole = exact_dedup.chunk_hash(data, tables)
    for cut in (0, 1, 313, 1000):
        x, y = exact_dedup.chunk_hash(data[:cut], tables), exact_dedup.chunk_hash(data[cut:], tables)
        for k, p in enumerate(exact_dedup.PRIMES):
            assert (x[k] * y[2 + k] + y[k]) % p == whole[k]


def brute_simhash(text, words=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + words]) for i in range(max(1, len(ws) - words + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, limit=2):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def test_simhash_whole_operator(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["É", "ß"]
    texts = [None, "", "   ", "one", "One two", "one TWO three"]
    base = [rng.choices(vocab, k=200) for _ in range(8)]
    for b in base:
        texts += [" ".join(b), "\n".join(b).upper().replace("SS", "ß")]
        for _ in range(6):
            c = list(b)
            c[rng.randrange(200)] = "changed"
            texts.append("  ".join(c))
    rows = [(i, t, "f") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + rows[:3], "doc_id bigint, text string, fp string")
    got = simhash.simhash_components(df).collect()
    assert len(got) == len(rows) + 3
    fps = [brute_simhash(t) for t in texts]
    comp = brute_components(fps)
    for r in got:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        assert r.component_id == comp[r.doc_id]
        assert r.fp == "f"
    assert sum(r.kept for r in got) == len(set(comp))


@pytest.mark.parametrize("block", [16, 4096])
def test_near_links_match_all_pairs(spark, block):
    rng = random.Random(5)
    codes = {rng.getrandbits(64) & 0xFFFF00000000FFFF for _ in range(250)}
    for c in list(codes)[:80]:
        for _ in range(rng.randrange(4)):
            for _ in range(rng.randrange(1, 5)):
                c ^= 1 << rng.randrange(64)
            codes.add(c)
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp bigint")
    roots = {r.node: r.root for r in components(simhash.near_links(df, 2, block)).collect()}
    comp = brute_components(codes)
    got, want = {}, {}
    for c, k in zip(signed, comp):
        got.setdefault(roots.get(c, c), set()).add(c)
        want.setdefault(k, set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_chain_star_and_empty(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(300)] + [(5000, 5000), (None, 1)]
    df = spark.createDataFrame(chain + star, "a bigint, b bigint")
    by = {}
    for r in components(df).collect():
        by.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, by.values())) == [201, 301]
    assert components(df.limit(0)).count() == 0


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_dedup(df).count() == 0
    assert simhash.simhash_components(df).count() == 0


def test_forest_is_transitive():
    a, b = np.array([5, 4, 9, 7]), np.array([4, 1, 8, 9])
    assert simhash.forest(a, b, 10).tolist() == [0, 1, 2, 3, 1, 1, 6, 7, 7, 7]


def test_clashing_names_in_other_case_can_be_written(spark, workdir):
    """Columns called like an output but for the case are replaced, so the result can be stored."""
    df = spark.createDataFrame([(1, "a b c", "k", "g", "f"), (2, "a b c", "k", "g", "f")],
                               "doc_id bigint, text string, Kept string, Group_Size string, Fingerprint string")
    exact_dedup.exact_dedup(df).write.parquet(f"{workdir}/exact")
    simhash.simhash_components(df).write.parquet(f"{workdir}/simhash")
    assert [r.kept for r in spark.read.parquet(f"{workdir}/exact").orderBy("doc_id").collect()] == [True, False]
    assert [r.kept for r in spark.read.parquet(f"{workdir}/simhash").orderBy("doc_id").collect()] == [True, False]
