"""Exact and near flags as a stateful stream: one value per key in the state store.

``MessageJob`` keeps what was seen in tables and joins them once per epoch. Here the state store holds
it: per message id that it was seen, per band key the id that came first (``transformWithState``, RocksDB
on the executors, checkpointed with the stream's offsets). An epoch reads and writes the state of its own
keys only, however large the state is, and a restart on the same checkpoint goes on where the stream was.

Order of arrival is (epoch, ``seq``): earlier epochs first, then the order column within an epoch.
Keys are dealt into ``BUCKETS`` buckets by hash, and a bucket's state is a map with one entry per key: a call
into Python and a frame back serve a bucket's rows of the epoch, not a single key's, while state is still read and
written key by key. Rows reach their task in no order and in any number; the exact flag holds back one
row per new key (the least so far). The near flag of a key that no epoch before had needs the first
id before it can judge any row, so the rows of such a key wait, as narrow columns, until the epoch's rows of
its bucket were read; for a known key they stream through. The trigger bounds an epoch
(``maxFilesPerTrigger``). ``ttl_ms`` lets keys go that were not written for so long; None keeps all.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidepool import config
from tidepool.operators import dedup

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of keys; the state depends on it, so it stays for the life of a checkpoint.
BUCKETS = 4096
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _First(StatefulProcessor):
    """State of a bucket: per key of it, the message id that came first."""

    def __init__(self, keys: list[str], ttl_ms: int | None):
        self.keys, self.ttl_ms = keys, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = ", ".join(f"{k} {'string' if k == 'msg_id' else 'bigint'}" for k in self.keys)
        self.first = handle.getMapState("first", key, "msg_id string", self.ttl_ms)

    def close(self) -> None:
        pass

    def keys_of(self, frame: pd.DataFrame) -> list[tuple]:
        return list(zip(*(frame[k].tolist() for k in self.keys)))


def _before(seq, other) -> bool:
    """Order of arrival: a row without number comes last."""
    return seq < other or (other != other and seq == seq)


class ExactFlag(_First):
    """``is_duplicate``: an earlier row has the same key."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, held = set(), {}  # keys of earlier epochs; of a new key the least row so far
        names = None
        for frame in rows:
            names, at, later = list(frame.columns), frame.columns.get_loc("seq"), []
            for k, row in zip(self.keys_of(frame), frame.itertuples(index=False, name=None)):
                if k not in seen and k not in held:
                    if not self.first.containsKey(k):
                        held[k] = row
                        continue
                    seen.add(k)
                if k in held and _before(row[at], held[k][at]):
                    row, held[k] = held[k], row
                later.append(row)
            if later:
                yield pd.DataFrame(later, columns=names).assign(is_duplicate=True)
        if held:
            for k, row in held.items():
                self.first.updateValue(k, (row[names.index("msg_id")],))
            yield pd.DataFrame(list(held.values()), columns=names).assign(is_duplicate=False)


class NearFlag(_First):
    """``is_near_duplicate``: the band key (the key) was first taken by another message id."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, least, waiting = {}, {}, []  # first ids of known keys; (seq, id) of new ones
        for frame in rows:
            keys, known = self.keys_of(frame), []
            for k, seq, msg_id in zip(keys, frame["seq"].tolist(), frame["msg_id"].tolist()):
                if k not in first and k not in least:
                    held = self.first.getValue(k) if self.first.containsKey(k) else None
                    if held is None:
                        least[k] = (seq, msg_id)
                    else:
                        first[k] = held[0]
                elif k in least and _before(seq, least[k][0]):
                    least[k] = (seq, msg_id)
                known.append(k in first)
            if all(known):
                yield self._flagged(frame, keys, first)
                continue
            if any(known):
                yield self._flagged(frame[known], [k for k, y in zip(keys, known) if y], first)
                frame = frame[[not y for y in known]]
            waiting.append(frame)
        if least:
            first = {k: msg_id for k, (_, msg_id) in least.items()}
            for k, msg_id in first.items():
                self.first.updateValue(k, (msg_id,))
            for frame in waiting:
                yield self._flagged(frame, self.keys_of(frame), first)

    def _flagged(self, frame: pd.DataFrame, keys: list[tuple], first: dict[tuple, str]) -> pd.DataFrame:
        return frame.assign(is_near_duplicate=[m != first[k] for m, k in zip(frame["msg_id"].tolist(), keys)])


def _stateful(df: DataFrame, processor: _First, flag: str) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    bucket = F.pmod(F.xxhash64(*processor.keys), F.lit(BUCKETS)).cast("int")
    out = df.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(
        processor, f"{schema}, bucket int, {flag} boolean", "Append",
        "None" if processor.ttl_ms is None else "ProcessingTime")
    return out.drop("bucket")


def keyed_flags(messages: DataFrame, rows: int = config.LSH_ROWS, ttl_ms: int | None = None) -> DataFrame:
    """(seq, msg_id, is_duplicate, is_near_duplicate) of a stream of ``seq, message``."""
    keys = [f"k{j}" for j in range(rows)]
    keyed = dedup.with_band(dedup.with_message_keys(messages.select("seq", "message")), rows)
    narrow = keyed.select("seq", "msg_id", *keys)
    exact = _stateful(narrow, ExactFlag(["msg_id"], ttl_ms), "is_duplicate")
    near = _stateful(exact, NearFlag(keys, ttl_ms), "is_near_duplicate")
    return near.select("seq", "msg_id", "is_duplicate", "is_near_duplicate")


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """Settings that a stateful stream takes over when it starts: the RocksDB store, and the number of
    state partitions, which stays for the life of its checkpoint."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_keyed_flags(messages: DataFrame, root: str, trigger: dict | None = None, ttl_ms: int | None = None,
                      partitions: int | None = None, query_name: str = "keyed-flags"):
    """Start the stream into parquet files under ``root`` (each epoch's rows exactly once)."""
    with state_settings(messages.sparkSession, partitions):
        writer = (keyed_flags(messages, ttl_ms=ttl_ms).writeStream.format("parquet").outputMode("append")
                  .option("path", os.path.join(root, "flags")).queryName(query_name)
                  .option("checkpointLocation", os.path.join(root, "_checkpoints", query_name)))
        return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()
