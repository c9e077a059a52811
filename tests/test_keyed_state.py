"""Flags from keyed state in the store equal the batch flags over the union, also after a restart."""

import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepool.operators import dedup
from tidepool.sources import tables
from tidepool.streaming import keyed_state
from tests.conftest import SF0001

SCHEMA = "seq bigint, message string"


def put(spark, src, k, rows):
    path = os.path.join(src, f"part-{k}")
    rows.coalesce(1).write.parquet(path)
    return path


def run(spark, src, root):
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    q = keyed_state.start_keyed_flags(stream, root, trigger={"availableNow": True}, partitions=3)
    assert q.awaitTermination(300)
    return q


def batch_flags(df):
    exact = dedup.exact_flags(dedup.key_rows(df), out="is_duplicate").select("seq", "is_duplicate")
    near = dedup.near_flags(dedup.key_rows(df, rows=5)).select("seq", "is_near_duplicate")
    return {r.seq: (r.is_duplicate, r.is_near_duplicate) for r in exact.join(near, "seq").collect()}


def test_stream_with_restart_equals_batch(spark, workdir):
    raw = tables.raw_messages(spark, SF0001).select("seq", "message")
    rng = random.Random(4)
    odd = [(10_000 + i, rng.choice([None, "", "  ", "Same text", "same  TEXT", "a b", "b a", "c"])) for i in range(120)]
    union = raw.unionByName(spark.createDataFrame(odd, SCHEMA)).orderBy("seq")
    rows = union.collect()
    cuts = [0, 60, 130, 200, 260, len(rows)]
    src, root = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    os.makedirs(src)
    epochs = []
    for k in range(5):
        part = rows[cuts[k]:cuts[k + 1]]
        rng.shuffle(part)  # within an epoch, arrival order is seq, not file order
        put(spark, src, k, spark.createDataFrame(part, SCHEMA))
        time.sleep(0.02)
        if k in (1, 4):  # two files, stop, three more on the same checkpoint
            epochs.append(run(spark, src, root).lastProgress["batchId"])
    assert epochs[1] > epochs[0]
    got = spark.read.parquet(os.path.join(root, "flags")).collect()
    assert len(got) == len(rows)
    assert {r.seq: (r.is_duplicate, r.is_near_duplicate) for r in got} == batch_flags(union)


def test_state_is_read_by_key_not_as_a_whole(spark, workdir):
    """After a first epoch of thousands of keys, an epoch of two keys touches two keys' state."""
    src, root = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    os.makedirs(src)
    put(spark, src, 0, spark.range(2000).select(F.col("id").alias("seq"), F.format_string("text %d", "id").alias("message")))
    run(spark, src, root)
    put(spark, src, 1, spark.createDataFrame([(5000, "text 7"), (5001, "new here"), (5002, "text 7")], SCHEMA))
    ops = run(spark, src, root).lastProgress["stateOperators"]
    totals, updated = [o["numRowsTotal"] for o in ops], [o["numRowsUpdated"] for o in ops]
    assert max(totals) == 2001 and max(updated) <= 1
    got = spark.read.parquet(os.path.join(root, "flags")).where("seq >= 5000").orderBy("seq").collect()
    assert [r.is_duplicate for r in got] == [True, False, True]


class Held:
    """Map state in a dictionary that counts its calls."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def containsKey(self, k):
        self.calls += 1
        return k in self.rows

    def getValue(self, k):
        return self.rows[k]

    def updateValue(self, k, v):
        self.calls += 1
        self.rows[k] = v


def test_one_call_serves_the_keys_of_a_bucket():
    """Frames of many keys in any order over three epochs against a walk; state is asked once per key and epoch."""
    rng = random.Random(7)
    exact, near = keyed_state.ExactFlag(["msg_id"], None), keyed_state.NearFlag(["k0", "k1"], None)
    exact.first, near.first = Held(), Held()
    seen, first, number = set(), {}, 0
    for _ in range(3):
        rows = []
        for _ in range(200):
            m = rng.randrange(60)
            rows.append((number, f"m{m}", m % 4, m % 3, 5))
            number += 1
        want = {}
        for seq, m, *k, _ in rows:
            want[seq] = (m in seen, first.setdefault(tuple(k), m) != m)
            seen.add(m)
        rng.shuffle(rows)
        frames = [pd.DataFrame(rows[i:i + 70], columns=["seq", "msg_id", "k0", "k1", "bucket"]) for i in range(0, 200, 70)]
        for part in (exact, near):
            part.first.calls = 0
        mid = list(exact.handleInputRows((5,), iter(frames), None))
        out = list(near.handleInputRows((5,), iter(mid), None))
        assert exact.first.calls <= 2 * 60 and near.first.calls <= 2 * 12
        got = {r.seq: (r.is_duplicate, r.is_near_duplicate) for f in out for r in f.itertuples()}
        assert sum(map(len, out)) == 200 and got == want


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError):
        with keyed_state.state_settings(spark, 3):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_query_over_one_file_and_over_a_folder(spark, tmp_path):
    from tidepool.plans import catalog
    whole = spark.read.parquet(f"{SF0001}/documents.parquet")
    whole.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(catalog.keyed_flags(spark, SF0001).collect())
    assert len(want) == whole.count()
    assert sorted(catalog.keyed_flags(spark, str(tmp_path)).collect()) == want
