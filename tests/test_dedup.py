"""Closed-form flags equal the sequential model; properties of the flags."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001
from tests.seqmodel import band_key, bucket_vector, normalize, sequential_flags
from tidepool.functions import hashing
from tidepool.functions.vectors import bucket_vector_py
from tidepool.operators import dedup
from tidepool.sources import tables

# Own sentences: copies, case and whitespace variants, a one-character change, unrelated lines.
SENTENCES = [
    "My parcel never showed up and nobody answers",
    "Thanks a lot, the blender works great",
    "my parcel never showed up and NOBODY answers",
    "  My parcel   never showed up\tand nobody answers ",
    "Where do I send a broken kettle back?",
    "My parcel never showed up and nobody answers!",
    "Thanks a lot, the blender works great",
    "",
    "Do you deliver on Sundays?",
    "ok",
    "OK",
    "The app logs me out every few minutes",
    "Loving the new colours this season",
    "where do i send a broken kettle back?",
]


def _frame(spark, pairs):
    return spark.createDataFrame(pairs, "seq long, message string")


def _check(spark, pairs, size):
    got = {r.seq: (r.is_duplicate, r.is_near_duplicate)
           for r in dedup.flag_messages(_frame(spark, pairs), size=size).collect()}
    exact = {r.seq: r.is_exact_duplicate for r in
             dedup.exact_flags(dedup.with_message_keys(_frame(spark, pairs))).collect()}
    want = sequential_flags(pairs, size=size)
    assert got == {s: (v[0], v[1]) for s, v in want.items()}
    assert exact == {s: v[2] for s, v in want.items()}
    return got, exact


def test_own_sentences(spark):
    pairs = [(i + 1, s) for i, s in enumerate(SENTENCES)]
    got, exact = _check(spark, pairs, 100000)
    assert got[3][0] and got[4][0] and got[7][0] and got[11][0]
    assert not got[6][0]  # one character differs


@pytest.mark.parametrize("size", [100000, 300])
def test_driver_messages_match_sequential_model(spark, size):
    docs = tables.raw_messages(spark, SF0001).select("seq", "message")
    conv = spark.read.parquet(f"{SF0001}/conversations.parquet").filter(F.col("role") == "user") \
        .select((F.lit(1_000_000) + F.col("conv_id") * 100 + F.col("turn")).alias("seq"),
                F.col("text").alias("message"))
    pairs = [(r.seq, r.message) for r in docs.unionByName(conv).collect()]
    got, exact = _check(spark, pairs, size)
    if size == 300:
        assert sum(v[0] for v in got.values()) > sum(exact.values())  # false positives reproduced
    # Bloom flag covers every exact duplicate.
    assert all(got[s][0] for s, e in exact.items() if e)


def test_flags_independent_of_partitioning_and_prefix_stable(spark):
    raw = tables.raw_messages(spark, SF0001).select("seq", "message")
    a = {r.seq: (r.is_duplicate, r.is_near_duplicate)
         for r in dedup.flag_messages(raw.repartition(1), size=500).collect()}
    b = {r.seq: (r.is_duplicate, r.is_near_duplicate)
         for r in dedup.flag_messages(raw.repartition(7), size=500).collect()}
    assert a == b
    half = raw.filter(F.col("seq") < 100)
    p = {r.seq: (r.is_duplicate, r.is_near_duplicate)
         for r in dedup.flag_messages(half, size=500).collect()}
    assert p == {s: v for s, v in a.items() if s < 100}


def test_hash_helpers_match_python(spark):
    words = ["alpha", "beta", "", "ünïcode", "x" * 50]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", hashing.md5_mod(F.col("w"), 15).alias("m15"),
                     hashing.md5_mod(F.col("w"), 100000).alias("m"),
                     hashing.user_hash(F.col("w")).alias("sha")).collect()
    for r in rows:
        h = int(hashlib.md5(r.w.encode()).hexdigest(), 16)
        assert r.m15 == h % 15 and r.m == h % 100000
        assert r.sha == hashlib.sha256(r.w.encode()).hexdigest()
    one = spark.createDataFrame([("user_001",)], "u string").select(hashing.user_hash(F.col("u"))).first()[0]
    assert one == "ab2201ddf6cec4bd8548754effa9bbceaadd6bb278d0c294236f42d467975b6c"


def test_band_key_and_vector(spark):
    pairs = [(i, s) for i, s in enumerate(SENTENCES)]
    df = dedup.with_band(dedup.with_message_keys(_frame(spark, pairs)))
    got = {r.seq: r.band_key for r in df.select("seq", dedup.band_key_col().alias("band_key")).collect()}
    for seq, msg in pairs:
        norm = normalize(msg)
        assert bucket_vector_py(norm, 15) == bucket_vector(norm, 15)
        assert got[seq] == band_key(bucket_vector(norm, 15), 5)


def test_prior_state_paths_equal_one_shot(spark):
    raw = dedup.with_message_keys(tables.raw_messages(spark, SF0001).select("seq", "message"))
    first, second = raw.filter(F.col("seq") < 120), raw.filter(F.col("seq") >= 120)
    whole_b = {r.seq: r.is_duplicate for r in dedup.bloom_flags(raw, size=400).collect()}
    whole_n = {r.seq: r.is_near_duplicate for r in dedup.near_flags(raw).collect()}
    whole_e = {r.seq: r.is_exact_duplicate for r in dedup.exact_flags(raw).collect()}
    fill = dedup.bloom_fill(dedup.with_bloom_bits(first, size=400))
    bands = dedup.band_firsts(dedup.with_band(first))
    msgs = dedup.message_firsts(first)
    got_b = {r.seq: r.is_duplicate for r in dedup.bloom_flags(second, size=400, prior_fill=fill).collect()}
    got_n = {r.seq: r.is_near_duplicate for r in dedup.near_flags(second, prior=bands).collect()}
    got_e = {r.seq: r.is_exact_duplicate for r in dedup.exact_flags(second, prior=msgs).collect()}
    assert got_b == {s: v for s, v in whole_b.items() if s >= 120}
    assert got_n == {s: v for s, v in whole_n.items() if s >= 120}
    assert got_e == {s: v for s, v in whole_e.items() if s >= 120}
    keyed = dedup.with_band(dedup.with_bloom_bits(second, size=400))
    flagged, _, _ = dedup.flag_with_state(keyed, 400, 3, 5, prior_bits=fill, prior_bands=bands)
    got = {r.seq: (r.is_duplicate, r.is_near_duplicate) for r in flagged.collect()}
    assert got == {s: (whole_b[s], whole_n[s]) for s in got_b}


def test_shuffle_fallback_when_lookups_are_too_large(spark, monkeypatch):
    """Beyond the broadcast bounds the probes become shuffle joins with the same flags."""
    from tidepool import config
    from tidepool.plans import joins
    raw = tables.raw_messages(spark, SF0001).select("seq", "message")
    want = {r.seq: (r.is_duplicate, r.is_near_duplicate)
            for r in dedup.flag_messages(raw, size=500).collect()}
    want_e = {r.seq: r.is_exact_duplicate
              for r in dedup.exact_flags(dedup.with_message_keys(raw)).collect()}
    monkeypatch.setattr(dedup, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(config, "BLOOM_BROADCAST_MAX_BITS", 0)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        flagged = dedup.flag_messages(raw, size=500)
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        got = {r.seq: (r.is_duplicate, r.is_near_duplicate) for r in flagged.collect()}
        exact = dedup.exact_flags(dedup.with_message_keys(raw))
        got_e = {r.seq: r.is_exact_duplicate for r in exact.collect()}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want and got_e == want_e


def test_token_memo_is_bounded_however_many_tokens(spark, monkeypatch):
    """A batch of ever new tokens leaves a memo of bounded size and the same counts."""
    from tidepool.functions import vectors
    texts = [" ".join(f"w{i * 37 + j}" for j in range(50)) for i in range(40)]
    want = [bucket_vector_py(t, 15) for t in texts]
    monkeypatch.setattr(vectors, "MEMO_TOKENS", 64)
    cache = {}
    assert [bucket_vector_py(t, 15, cache) for t in texts] == want and 0 < len(cache) <= 64
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "i int, t string")
    got = df.select("i", vectors.bucket_vector(F.col("t"), 15).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [*want, [0] * 15, [0] * 15]
