"""Growing Bloom filter: error bound far past the design size, against a filter that walks in order."""

import hashlib

from pyspark.sql import functions as F

from tidepool.operators import dedup, scalable_bloom as growing

SCHEMA = "seq bigint, message string"


def walk(rows, capacity, error):
    """Flags by walking the rows, a bit set per generation; every distinct message is inserted."""
    gens = growing.generations(len({m for _, m in rows}), capacity, error)
    filled = [set() for _ in gens]
    seen, out = {}, {}

    def places(msg, g):
        h = hashlib.md5(f"{msg}:{g.number}".encode()).hexdigest()
        a, b = int(h[:15], 16) % g.size, int(h[15:30], 16) % g.size
        return {(a + i * b) % g.size for i in range(g.hashes)}
    for seq, text in sorted(rows):
        msg = hashlib.md5(" ".join((text or "").lower().split()).encode()).hexdigest()
        hit = any(places(msg, g) <= filled[g.number] for g in gens)
        if msg not in seen:
            g = max(g.number for g in gens if len(seen) >= g.start)
            seen[msg] = g
            filled[g] |= places(msg, gens[g])
            out[seq] = (g, hit, hit)
        else:
            out[seq] = (seen[msg], True, False)
            assert hit
    return out


def test_flags_equal_a_walk_in_order(spark):
    rows = [(i * 3, f"text {i * 7 % 150}") for i in range(400)] + [(1, None), (2, ""), (4, "TEXT  7")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for capacity, error in ((10, .5), (16, .05), (1000, .01)):
        got = {r.seq: (r.generation, r.is_duplicate, r.is_false_hit)
               for r in growing.flags(df, capacity=capacity, error=error).collect()}
        assert got == walk(rows, capacity, error)


def test_error_stays_under_the_bound_where_a_fixed_filter_fails(spark):
    """Sixty times the design size: first arrivals flagged by mistake stay under the bound."""
    df = spark.range(30_000).select(F.col("id").alias("seq"), F.format_string("message %d", "id").alias("message"))
    got = growing.flags(df, capacity=500, error=.02).agg(
        F.avg(F.col("is_false_hit").cast("double")).alias("rate"), F.max("generation").alias("g")).first()
    assert got.rate <= .02 and got.g == 5
    # a filter of fixed size with the same design capacity and error
    gen = growing.generations(1, 500, .04)[0]
    fixed = dedup.bloom_flags(dedup.key_rows(df, size=gen.size, num_hashes=gen.hashes), gen.size, gen.hashes)
    assert fixed.agg(F.avg(F.col("is_duplicate").cast("double"))).first()[0] > .9


def test_a_message_is_one_probe_per_generation_and_drops_out_at_a_missing_bit(spark, monkeypatch):
    """The rows of the look-ups are one per message and generation, fewer each round, not one per bit."""
    df = spark.range(3000).select(F.col("id").alias("seq"), F.format_string("message %d", "id").alias("message"))
    gens = growing.generations(3000, 20, .01)
    firsts = growing.with_generation(growing.first_arrivals(dedup.key_rows(df)), gens)
    probes, fill = growing.probe_rows(firsts, gens), growing.first_setters(firsts, gens)
    assert probes.count() == firsts.agg(F.sum(F.col("generation") + 1)).first()[0]
    rounds, write = [], growing.materialize

    def noted(rows):
        rounds.append(write(rows))
        return rounds[-1]
    monkeypatch.setattr(growing, "materialize", noted)
    hits = growing.filled_probes(probes, fill, gens).collect()
    counts = [r.count() for r in rounds]
    assert counts[0] < .6 * probes.count() and counts[1] < .6 * counts[0] and counts == sorted(counts, reverse=True)
    # every bit by hand
    set_by = {r.key: r.set_by for r in fill.collect()}
    want = {(r["rank"], r.g) for r in probes.collect()
            if all(set_by.get(r.g * growing.KEY_SPACE + (r.a + i * r.b) % gens[r.g].size, r.first_seq) < r.first_seq
                   for i in range(gens[r.g].hashes))}
    assert {(r["rank"], r.g) for r in hits} == want


def test_generations_share_the_error():
    gens = growing.generations(10**9, 1000, .01)
    assert sum(.01 / 2 ** (g.number + 1) for g in gens) < .01
    assert [g.start for g in gens[:4]] == [0, 1000, 3000, 7000] and gens[-1].start < 10**9
    assert growing.generations(0)[0].start == 0


def test_no_messages(spark):
    assert growing.flags(spark.createDataFrame([], SCHEMA)).collect() == []
