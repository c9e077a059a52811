"""Quantiles, counters with resets, whole-number noise and the budget ledger against plain Python."""

import math
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidepool.operators import budget, counters, monitoring, quantiles


def brute_bucket_quantile(values, q):
    """Interpolation inside the cumulative bucket that the rank falls into."""
    bounds = [0.0, *monitoring.HISTOGRAM_BOUNDS, math.inf]
    upto = [0] + [sum(v <= b for v in values) for b in bounds[1:]]
    if not values:
        return None
    rank = q * len(values)
    i = next(k for k in range(1, len(bounds)) if upto[k] >= rank and upto[k] > 0)
    if bounds[i] == math.inf:
        return bounds[i - 1]
    return bounds[i - 1] + (bounds[i] - bounds[i - 1]) * max(rank - upto[i - 1], 0) / (upto[i] - upto[i - 1])


@pytest.mark.parametrize("values", [[], [0.02], [50.0, 70.0], [0.1, 0.1, 0.3, 2.0, 9.9, 11.0], None])
def test_bucket_quantiles(spark, values):
    rng = random.Random(1)
    values = [rng.expovariate(1.5) for _ in range(500)] if values is None else values
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "duration double")
    got = {r.quantile: r.value for r in quantiles.bucket_quantiles(monitoring.duration_histogram(df), (0.0, .25, .5, .99, 1.0)).collect()}
    for q, v in got.items():
        want = brute_bucket_quantile(values, q)
        assert v is None if want is None else abs(v - want) < 1e-6


def test_sketches_merge_without_the_rows(spark):
    """Ranks of merged quantiles are right within a percent; an epoch's sketch has a bounded size."""
    rows = spark.range(200_000).select((F.col("id") % 20).alias("epoch"), (F.pmod(F.xxhash64("id"), F.lit(10**6)) / 1000.0).alias("value"))
    rows = rows.unionByName(spark.createDataFrame([(3, None), (77, None)], "epoch bigint, value double"))
    deltas = quantiles.epoch_sketches(rows, "value")
    assert deltas.count() == 20 and deltas.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    for r in quantiles.merged_quantiles(deltas, (.01, .5, .9, .99)).collect():
        share = rows.where(F.col("value") <= r.value).count() / 200_000
        assert r.n == 200_000 and abs(share - r.quantile) < .01
    assert quantiles.merged_quantiles(deltas.limit(0)).collect() == []


def make_samples(rng):
    t0 = datetime(2024, 1, 1)
    rows, value = [], 0.0
    for i in range(600):
        value = round(rng.choice([value + rng.random() * 5, value, rng.random()]), 3)
        rows.append((i, "hot", t0 + timedelta(minutes=rng.choice([i, i, i - i % 5])), value))
    rows += [(1000 + i, "cold", t0 + timedelta(hours=40 * i), float(3 - i)) for i in range(3)]
    return rows + [(2000, "one", t0, 4.0), (2001, None, t0, 1.0), (2002, "hot", None, 1.0), (2003, "hot", t0, None)]


def test_increase_and_islands(spark):
    rng = random.Random(6)
    rows = make_samples(rng)
    df = spark.createDataFrame(rows, "event_id long, name string, ts timestamp_ntz, value double").repartition(5)
    want, runs = {}, {}
    for name in ("hot", "cold", "one"):
        last, island = None, 0
        for _, _, ts, v in sorted((r for r in rows if r[1] == name and r[2] and r[3] is not None), key=lambda r: (r[2], r[0])):
            reset = last is not None and v < last
            island += reset
            add = 0.0 if last is None else v if reset else v - last
            n, k, s = want.get((name, ts.strftime("%Y-%m-%d %H:00:00")), (0, 0, 0.0))
            want[name, ts.strftime("%Y-%m-%d %H:00:00")] = (n + 1, k + reset, s + add)
            first, _, m, _ = runs.get((name, island), (ts, ts, 0, v))
            runs[name, island] = (first, ts, m + 1, v)
            last = v
    got = {(r.name, r.slice_start): (r.n_samples, r.n_resets, r.increase)
           for r in counters.increase(df, "name", "ts", "value", "event_id").collect()}
    assert got.keys() == want.keys()
    assert all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 1e-6 for k in got)
    found = {(r.name, r.island): (r.first_ts, r.last_ts, r.n_samples, r.last_value)
             for r in counters.islands(df, "name", "ts", "value", "event_id").collect()}
    assert found == runs


def test_geometric_noise_has_the_stated_distribution(spark):
    keys = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    for eps in (.5, 2.0):
        counts = {r.n: r["count"] / 60_000 for r in keys.select(
            budget.two_sided_geometric(F.col("k"), eps).alias("n")).groupBy("n").count().collect()}
        a = math.exp(-eps)
        for k in range(-3, 4):
            assert abs(counts.get(k, 0) - (1 - a) / (1 + a) * a ** abs(k)) < .01
    again = keys.select(F.sum(budget.two_sided_geometric(F.col("k"))).alias("s"))
    assert again.first() == keys.repartition(7).select(F.sum(budget.two_sided_geometric(F.col("k"))).alias("s")).first()
    assert spark.range(1).select(budget.geometric_count(F.lit(None).cast("long"), F.lit("x"), .01)).first()[0] >= 0


def test_ledger_composes_and_refuses(spark, workdir):
    ledger = budget.Ledger(os.path.join(workdir, "budget"), 1.0)
    assert ledger.spent(spark) == 0
    labels = [("labels", x, .3) for x in ("complaint", "praise", "inquiry")]  # disjoint: one charge of 0.3
    assert abs(ledger.charge(spark, "monday", labels + [("totals", "all", .2)]) - .5) < 1e-9
    assert abs(ledger.charge(spark, "monday", labels + [("totals", "all", .2)]) - .5) < 1e-9  # asked again: free
    with pytest.raises(ValueError):
        ledger.charge(spark, "monday", labels)
    with pytest.raises(budget.BudgetSpent):
        ledger.charge(spark, "tuesday", [("labels", "praise", .4), ("labels", "praise", .2)])  # one part twice: 0.6
    assert abs(ledger.spent(spark) - .5) < 1e-9
    assert abs(budget.Ledger(ledger.path, 1.0).charge(spark, "tuesday", [("labels", "praise", .5)])) < 1e-9
    with pytest.raises(budget.BudgetSpent):
        ledger.charge(spark, "wednesday", [("labels", "praise", .01)])
    with pytest.raises(ValueError):
        ledger.charge(spark, "odd", [("labels", "praise", -1.0)])
