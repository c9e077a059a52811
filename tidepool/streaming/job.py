"""Micro-batch job: wire records -> processed rows, replies, counters, dedup state.

Per epoch N (``foreachBatch``), all set-based and executor-side:

1. decode JSON; rejected rows go to ``quarantine/epoch=N`` with a reason;
2. empty epoch -> nothing is written (no counter rows);
3. contiguous ids continue from the last committed epoch (arrival order = source partition
   order, then row order within a partition, as with a partition-by-partition walk);
4. classify, hash the user, normalise, derive Bloom bits and band counts;
5. flags against state of committed epochs < N unioned with this batch's firsts;
6. write ``processed``, ``outbox``, ``metrics`` and the *new* state rows under ``epoch=N``
   (overwrite), then ``epoch_log/epoch=N`` last as the commit marker.

Replaying an epoch rewrites the same partitions from the same input and the same prior state, so
it is idempotent. State survives restarts because it lives in tables, not in driver memory.

The flags depend on the filter size, hash count, band rows and mode, so these are stored beside
the state, and a job with other settings refuses the folder. Finished epochs are listed once per
job object; state is read by the paths of the few epochs since the last snapshot, and epochs and
snapshots that a later committed snapshot covers are removed.

A snapshot is split into buckets by key hash, about ``bucket_rows`` rows each, so their number grows
with the state and an epoch reads only the buckets its keys fall into. Folding merges per bucket: the
manifest of a snapshot (``<state>_manifest/upto=N``) names for each bucket the snapshot that holds it, and
only buckets with new rows are written again; when the state outgrows its buckets, their number doubles.

Dashboard counts come from the epochs' cube deltas (``incremental``), not from the rows. A deletion
(``delete``) writes the ids as tombstones, and what they take from the cube as a negative delta; readers of
processed rows and replies leave them out. ``fold_deletes`` writes the epochs concerned again without
them and drops the tombstones. Each request is applied once, however often it is sent.
"""

from __future__ import annotations

import os
import uuid
from bisect import bisect_left
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing
from tidepool.operators import decode, dedup, monitoring, replies
from tidepool.plans.joins import delete_paths, materialize, path_exists, scratch_scope
from tidepool.sources import tables
from tidepool.streaming import incremental

Predictor = Callable[[DataFrame], DataFrame]

_ROW_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits

#: Rows aimed at per bucket of a state snapshot, and the most buckets (beyond them buckets grow).
BUCKET_ROWS = 200_000
MAX_BUCKETS = 4096

#: Tables that a deleted message's rows vanish from, and the column that names the message.
CASCADE = {"processed": "id", "outbox": "processed_id"}


def bucket_col(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def assign_ids(df: DataFrame, base: int) -> DataFrame:
    """seq = base + rank in (partition, row) order, contiguous. Input must be persisted."""
    tagged = df.withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn("seq", F.lit(base) + F.col("_off") + F.col("_row"))
            .drop("_pid", "_row", "_off"))


class MessageJob:
    def __init__(self, root: str, predictor: Predictor,
                 bloom_size: int = config.BLOOM_SIZE, num_hashes: int = config.BLOOM_HASHES,
                 lsh_rows: int = config.LSH_ROWS, compact_every: int = 50,
                 exact: bool = False, bucket_rows: int = BUCKET_ROWS):
        self.root = root
        self.predictor = predictor
        self.bloom_size = bloom_size
        self.num_hashes = num_hashes
        self.lsh_rows = lsh_rows
        self.compact_every = compact_every
        # exact=False: is_duplicate is the Bloom flag (false positives included, as the reference);
        # exact=True: the error-free flag from a per-message-id state table.
        self.exact = exact
        self.bucket_rows = bucket_rows
        self.state_keys = {"state/bloom_bits": ["bit_idx"], "state/msg_first": ["msg_id"],
                           "state/band_first": [f"k{j}" for j in range(lsh_rows)]}
        self._epochs: list[int] | None = None
        self._snaps: dict[str, list[int]] = {}
        self._manifests: dict[tuple[str, int], dict[int, tuple[int, int]]] = {}
        self._checked = False

    # ------------------------------------------------------------ table access
    def path(self, name: str, epoch: int | None = None) -> str:
        p = os.path.join(self.root, name)
        return p if epoch is None else os.path.join(p, f"epoch={epoch}")

    def _list(self, spark: SparkSession, root: str, prefix: str) -> list[int]:
        """Sorted values of ``prefix=<n>`` sub-folders; the last one only if its write finished
        (the others did, or a later one would not have begun). One listing, one exists call."""
        if not path_exists(spark, root):
            return []
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(root)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
        out = sorted(int(x.split("=", 1)[1]) for x in names if x.startswith(prefix + "="))
        if out and not path_exists(spark, os.path.join(root, f"{prefix}={out[-1]}", "_SUCCESS")):
            out.pop()
        return out

    def committed(self, spark: SparkSession, before: int | None = None) -> list[int]:
        """Epochs whose commit marker (epoch log entry) exists. Listed once per job object; this
        job's own commits are added as they are made."""
        if self._epochs is None:
            self._epochs = self._list(spark, self.path("epoch_log"), "epoch")
        if before is None or not self._epochs or self._epochs[-1] < before:
            return self._epochs
        return self._epochs[:bisect_left(self._epochs, before)]

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        """Rows of committed epochs (all up to the last one: epochs are written in order), without
        those of deleted messages."""
        rows = self._read_stored(spark, name)
        if rows is None or name not in CASCADE:
            return rows
        gone = self._tombstones(spark)
        if gone is None:
            return rows
        return rows.join(gone.select(F.col("id").alias(CASCADE[name])).distinct(), CASCADE[name], "left_anti") \
            .select(rows.columns)

    def _read_stored(self, spark: SparkSession, name: str, only: list[int] | None = None) -> DataFrame | None:
        """Stored rows, an epoch's from the last fold that wrote it again, if any."""
        eps = self.committed(spark)
        if not eps or not path_exists(spark, self.path(name)):
            return None
        rows = spark.read.parquet(self.path(name)).filter(F.col("epoch") <= eps[-1])
        folds = self._folds(spark) if name in CASCADE else {}
        if only is not None:
            rows = rows.where(F.col("epoch").isin(only))
            folds = {e: k for e, k in folds.items() if e in only}
        if not folds:
            return rows
        rows = rows.where(~F.col("epoch").isin(list(folds)))
        for k in sorted(set(folds.values())):
            again = spark.read.schema(rows.schema).parquet(self.path(f"folded/{name}/fold={k}"))
            rows = rows.unionByName(again.where(F.col("epoch").isin([e for e, at in folds.items() if at == k])))
        return rows

    # ------------------------------------------------------------ deletions
    def _requests(self, spark: SparkSession) -> list[str]:
        """Finished deletion requests."""
        root = self.path("delete_log")
        if not path_exists(spark, root):
            return []
        return [r.request for r in spark.read.schema("request string").parquet(os.path.join(root, "*")).collect()]

    def _folds(self, spark: SparkSession) -> dict[int, int]:
        """Epoch -> the last finished fold that holds its processed rows and replies."""
        root = self.path("fold_log")
        if not path_exists(spark, root):
            return {}
        rows = spark.read.schema("epoch int, fold int").parquet(os.path.join(root, "*")).collect()
        return {r.epoch: r.fold for r in sorted(rows, key=lambda r: r.fold)}

    def _tombstones(self, spark: SparkSession) -> DataFrame | None:
        """(id, epoch) of deleted messages whose rows are still stored."""
        paths = [p for p in (self.path(f"tombstones/request={r}") for r in self._requests(spark)) if path_exists(spark, p)]
        return spark.read.schema("id bigint, epoch int").parquet(*paths) if paths else None

    def delete(self, spark: SparkSession, ids: DataFrame, request: str) -> None:
        """Delete messages by ``id``, their replies with them. A finished request changes nothing when
        it is sent again; an unfinished one is made good."""
        if request in self._requests(spark):
            return
        alive = self.read(spark, "processed")
        if alive is None:
            return
        with scratch_scope(spark):
            hit = materialize(alive.select("id", *incremental.CUBE_KEYS[:-1], "confidence", "epoch")
                              .join(ids.select("id").distinct(), "id", "left_semi"))
            hit.select("id", "epoch").coalesce(1).write.mode("overwrite").parquet(self.path(f"tombstones/request={request}"))
            incremental.cube_delta(hit, -1).coalesce(1).write.mode("overwrite") \
                .parquet(self.path(f"cube_retracted/request={request}"))
        spark.createDataFrame([(request,)], "request string").coalesce(1).write.mode("overwrite") \
            .parquet(self.path(f"delete_log/request={request}"))

    def fold_deletes(self, spark: SparkSession) -> list[int]:
        """Write the epochs that hold deleted rows again without them, the latest one (which may be
        replayed) excepted; returns those epochs."""
        gone, eps = self._tombstones(spark), self.committed(spark)
        if gone is None or not eps:
            return []
        stored = self._read_stored(spark, "processed").where(F.col("epoch") < eps[-1]).select("id", "epoch")
        found = stored.join(gone.select("id").distinct(), "id", "left_semi").select("epoch").distinct()
        epochs = sorted(r.epoch for r in found.collect())
        before = self._folds(spark)
        if epochs:
            fold = max(before.values(), default=-1) + 1
            for name, key in CASCADE.items():
                rows = self._read_stored(spark, name, only=epochs)
                rows.join(gone.select(F.col("id").alias(key)).distinct(), key, "left_anti").select(rows.columns) \
                    .repartition("epoch").write.mode("overwrite").partitionBy("epoch").parquet(self.path(f"folded/{name}/fold={fold}"))
            spark.createDataFrame([(e, fold) for e in epochs], "epoch int, fold int").coalesce(1) \
                .write.mode("overwrite").parquet(self.path(f"fold_log/fold={fold}"))
        # from here on nobody reads what is removed
        old = [self.path(f"folded/{name}/fold={before[e]}/epoch={e}") if e in before else self.path(name, e)
               for name in CASCADE for e in epochs]
        last = gone.where(F.col("epoch") >= eps[-1]).select("id").distinct()
        for request in self._requests(spark):
            path = self.path(f"tombstones/request={request}")
            if path_exists(spark, path) and spark.read.schema("id bigint, epoch int").parquet(path) \
                    .join(last, "id", "left_semi").isEmpty():
                old.append(path)
        delete_paths(spark, old)
        return epochs

    # ------------------------------------------------------------ dashboard counts
    def cube(self, spark: SparkSession) -> DataFrame | None:
        """Counts over the surviving rows, from the epochs' deltas and the retractions."""
        added = self.read(spark, "cube")
        if added is None:
            return None
        paths = [self.path(f"cube_retracted/request={r}") for r in self._requests(spark)]
        return incremental.merge([added, *([spark.read.schema(added.drop("epoch").schema).parquet(*paths)] if paths else [])])

    def _snapshots(self, spark: SparkSession, name: str) -> list[int]:
        if name not in self._snaps:
            self._snaps[name] = self._list(spark, self.path(f"{name}_manifest"), "upto")
        return self._snaps[name]

    def _manifest(self, spark: SparkSession, name: str, upto: int) -> dict[int, tuple[int, int]]:
        """Per bucket of a snapshot: the snapshot whose folder holds it, and its rows (at most
        ``MAX_BUCKETS`` entries, read once)."""
        if (name, upto) not in self._manifests:
            rows = spark.read.parquet(os.path.join(self.path(f"{name}_manifest"), f"upto={upto}")).collect()
            self._manifests[name, upto] = {r.bucket: (r.upto, r.n_rows) for r in rows}
        return self._manifests[name, upto]

    def _bucket_path(self, name: str, upto: int, bucket: int) -> str:
        return os.path.join(self.path(f"{name}_snapshot"), f"upto={upto}", f"bucket={bucket}")

    def _check_settings(self, spark: SparkSession) -> None:
        """Refuse state that was made under other settings; store them with the first epoch."""
        if self._checked:
            return
        mine = {"bloom_size": self.bloom_size, "num_hashes": self.num_hashes,
                "lsh_rows": self.lsh_rows, "exact": self.exact}
        path = self.path("state/settings")
        if path_exists(spark, os.path.join(path, "_SUCCESS")):
            stored = spark.read.parquet(path).first().asDict()
            if stored != mine:
                raise RuntimeError(f"{self.root} holds state made with {stored}, this job has {mine}; "
                                   "use the same settings or a new output folder")
        else:
            if self.committed(spark):
                raise RuntimeError(f"{self.root} holds epochs without stored settings")
            spark.createDataFrame([tuple(mine.values())],
                                  "bloom_size int, num_hashes int, lsh_rows int, exact boolean") \
                .write.mode("overwrite").parquet(path)
        self._checked = True

    def _read_buckets(self, spark: SparkSession, name: str, upto: int, buckets) -> list[DataFrame]:
        held = self._manifest(spark, name, upto)
        paths = [self._bucket_path(name, held[b][0], b) for b in sorted(buckets) if held[b][1]]
        return [spark.read.parquet(*paths)] if paths else []

    def _tail(self, spark: SparkSession, name: str, before: int) -> tuple[int | None, list[DataFrame]]:
        """The latest snapshot before an epoch (or None), and the state of the epochs after it."""
        snaps = [u for u in self._snapshots(spark, name) if u < before]
        eps = self.committed(spark, before)
        tail = [self.path(name, e) for e in eps[bisect_left(eps, (snaps[-1] if snaps else -1) + 1):]]
        return (snaps[-1] if snaps else None), ([spark.read.parquet(*tail)] if tail else [])

    def read_state(self, spark: SparkSession, name: str, before: int,
                   hit: DataFrame | None = None) -> DataFrame | None:
        """Committed state of epochs < ``before``: latest snapshot plus the epochs after it. With
        ``hit`` (rows with the state's key columns) only the snapshot's buckets of those keys are read."""
        upto, parts = self._tail(spark, name, before)
        if upto is not None:
            buckets = list(self._manifest(spark, name, upto))
            if hit is not None and len(buckets) > 1:  # at most MAX_BUCKETS numbers
                col = bucket_col(self.state_keys[name], len(buckets))
                buckets = [r.bucket for r in hit.select(col.alias("bucket")).distinct().collect()]
            parts = self._read_buckets(spark, name, upto, buckets) + parts
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _compact(self, spark: SparkSession, name: str, epoch: int) -> None:
        """Fold committed state of epochs < ``epoch`` into a snapshot, bucket by bucket (a replay
        writes the same folders again). The state's keys are distinct over its epochs."""
        if epoch - 1 in self._snapshots(spark, name):  # a replay: written before
            return
        upto, tail = self._tail(spark, name, epoch)
        if not tail:
            return
        keys = self.state_keys[name]
        held = {} if upto is None else self._manifest(spark, name, upto)
        total = tail[0].count() + sum(n for _, n in held.values())
        size = max(1, len(held))
        while size < MAX_BUCKETS and size * self.bucket_rows < total:
            size *= 2
        grown = size != len(held)
        added = tail[0].withColumn("bucket", bucket_col(keys, size))
        new = {r.bucket: r["count"] for r in added.groupBy("bucket").count().collect()}
        old = self._read_buckets(spark, name, upto, held if grown else new) if held else []
        rows = added
        for part in old:
            rows = rows.unionByName(part.withColumn("bucket", bucket_col(keys, size)))
        path = os.path.join(self.path(f"{name}_snapshot"), f"upto={epoch - 1}")
        tasks = min(size, max(len(new), spark.sparkContext.defaultParallelism))
        rows.repartition(tasks, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        if grown:
            written = spark.read.parquet(path).groupBy("bucket").count().collect()
            counts = {r.bucket: r["count"] for r in written}
            manifest = {b: (epoch - 1, counts.get(b, 0)) for b in range(size)}
        else:
            manifest = {b: (epoch - 1, n + new[b]) if b in new else (at, n) for b, (at, n) in held.items()}
        spark.createDataFrame([(b, at, n) for b, (at, n) in manifest.items()], "bucket int, upto int, n_rows long") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path(f"{name}_manifest"), f"upto={epoch - 1}"))
        self._snaps[name].append(epoch - 1)
        self._manifests[name, epoch - 1] = manifest

    def _drop_folded(self, spark: SparkSession, names: list[str], epoch: int) -> None:
        """Remove state that no later epoch reads: epochs and snapshot buckets that the newest
        snapshot an already committed epoch has used replaces."""
        done = self.committed(spark, epoch)
        for name in names:
            snaps = self._snapshots(spark, name)
            used = [u for u in snaps if done and u < done[-1]]
            if not used:
                continue
            since = used[-2] if len(used) > 1 else -1
            old = [self.path(name, e) for e in done[bisect_left(done, since + 1):bisect_left(done, used[-1] + 1)]]
            kept = {(b, at) for b, (at, _) in self._manifest(spark, name, used[-1]).items()}
            for u in used[:-1]:
                gone = {(b, at) for b, (at, _) in self._manifest(spark, name, u).items()} - kept
                whole = {at for _, at in gone} - {at for _, at in kept}
                old += [os.path.join(self.path(f"{name}_snapshot"), f"upto={at}") for at in whole]
                old += [self._bucket_path(name, at, b) for b, at in gone if at not in whole]
                old.append(os.path.join(self.path(f"{name}_manifest"), f"upto={u}"))
                del self._manifests[name, u]
            delete_paths(spark, old)
            self._snaps[name] = snaps[len(used) - 1:]

    def _base_id(self, spark: SparkSession, epoch: int) -> int:
        """Next id after the latest committed epoch (reads that one log entry)."""
        eps = self.committed(spark, before=epoch)
        if not eps:
            return 0
        row = spark.read.parquet(self.path("epoch_log", eps[-1])).first()
        return int(row["first_id"] + row["n_rows"])

    def _write(self, df: DataFrame, name: str, epoch: int) -> None:
        df.write.mode("overwrite").parquet(self.path(name, epoch))

    # ------------------------------------------------------------ one epoch
    def process_batch(self, batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        epoch = int(epoch_id)
        later = [e for e in self.committed(spark) if e > epoch]
        if later:
            # Only the latest epoch can be replayed; a smaller id means a new checkpoint was
            # pointed at an output folder that already holds later epochs.
            raise RuntimeError(f"epoch {epoch} is behind committed epoch {later[-1]} in "
                               f"{self.root}; use the original checkpoint or a new output folder")
        self._check_settings(spark)
        decoded = decode.with_decoded(batch_df.select("value")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if decoded.isEmpty():
                return
            self._write(decoded.filter(F.col("reject_reason").isNotNull())
                        .select("value", "reject_reason"), "quarantine", epoch)
            kept = decoded.filter(F.col("reject_reason").isNull()).select("user_id", "message")
            base = self._base_id(spark, epoch)
            # Ids first (they follow the source's partition order), then spread the CPU-heavy
            # classify / tokenise work over all task slots if the batch has fewer partitions.
            # assign_ids keeps the batch's partitioning, so count it on the persisted batch.
            rows = tables.spread(assign_ids(kept, base), decoded.rdd.getNumPartitions())
            predicted = self.predictor(rows)
            keyed = dedup.with_message_keys(predicted)
            if not self.exact:  # exact mode needs no Bloom bits
                keyed = dedup.with_bloom_bits(keyed, self.bloom_size, self.num_hashes)
            keyed = dedup.with_band(keyed, self.lsh_rows).drop("norm") \
                .persist(StorageLevel.MEMORY_AND_DISK)
            try:
                with scratch_scope(spark):  # this epoch's lookup tables are removed afterwards
                    self._flag_and_write(spark, keyed, epoch, base)
            finally:
                keyed.unpersist()
        finally:
            decoded.unpersist()

    def _flag_and_write(self, spark: SparkSession, keyed: DataFrame, epoch: int, base: int) -> None:
        names = ["state/msg_first" if self.exact else "state/bloom_bits", "state/band_first"]
        if self.compact_every and epoch > 0 and epoch % self.compact_every == 0:
            for name in names:
                self._compact(spark, name, epoch)
        prior_bands = self.read_state(spark, "state/band_first", before=epoch, hit=keyed)
        if self.exact:
            prior_msgs = self.read_state(spark, "state/msg_first", before=epoch, hit=keyed)
            batch_msgs = dedup.message_firsts(keyed)
            new_state = batch_msgs if prior_msgs is None else \
                batch_msgs.join(prior_msgs.select("msg_id"), "msg_id", "left_anti")
            flagged = dedup.exact_flags(keyed, prior=prior_msgs, out="is_duplicate")
            flagged, new_bands = dedup.near_flags_with_state(flagged, self.lsh_rows, prior=prior_bands)
        else:
            bits = F.explode(F.array(*[F.col(f"b{i}") for i in range(self.num_hashes)]))
            prior_bits = self.read_state(spark, "state/bloom_bits", before=epoch,
                                         hit=keyed.select(bits.alias("bit_idx")))
            flagged, new_state, new_bands = dedup.flag_with_state(
                keyed, self.bloom_size, self.num_hashes, self.lsh_rows, "seq",
                prior_bits=prior_bits, prior_bands=prior_bands)
        now = F.current_timestamp().cast("timestamp_ntz")
        processed = flagged.select(
            F.col("seq").alias("id"), F.col("message").alias("original_text"),
            F.col("message").alias("cleaned_text"),
            hashing.user_hash(F.col("user_id")).alias("hashed_user_id"),
            "predicted_label", "confidence", "is_duplicate", "is_near_duplicate",
            replies.reply_text(F.col("predicted_label"), F.col("confidence")).alias("reply_text"),
            now.alias("created_at"), now.alias("updated_at"))
        # The row count is observed while the rows are written; the other outputs read what was
        # written, so each row is computed once.
        seen = Observation(f"epoch-{epoch}-{uuid.uuid4().hex}")
        self._write(processed.observe(seen, F.count(F.lit(1)).alias("n")), "processed", epoch)
        stored = spark.read.schema(processed.schema).parquet(self.path("processed", epoch))
        self._write(replies.build_outbox(stored), "outbox", epoch)
        self._write(incremental.cube_delta(stored).coalesce(1), "cube", epoch)
        self._write(monitoring.epoch_metrics(stored, epoch), "metrics", epoch)
        self._write(new_state, names[0], epoch)
        self._write(new_bands, names[1], epoch)
        log = spark.createDataFrame([(base, int(seen.get["n"]))], "first_id long, n_rows long")
        self._write(log, "epoch_log", epoch)
        if not self._epochs or self._epochs[-1] < epoch:
            self._epochs.append(epoch)
        self._drop_folded(spark, names, epoch)

    # ------------------------------------------------------------ drivers
    def start(self, source: DataFrame, checkpoint: str | None = None,
              trigger: dict | None = None, query_name: str = "messages"):
        """Start the streaming query; default trigger 30 s processing time. Without a given
        ``checkpoint`` it lies in the output folder, so a later session finds it again."""
        ckpt = checkpoint or os.path.join(self.root, "_checkpoints", query_name)
        writer = (source.writeStream.foreachBatch(self.process_batch)
                  .option("checkpointLocation", ckpt).queryName(query_name))
        writer = writer.trigger(**(trigger or {"processingTime": "30 seconds"}))
        return writer.start()

    def tables(self, spark: SparkSession) -> dict[str, DataFrame | None]:
        """Committed serving tables."""
        return {name: self.read(spark, name) for name in ("processed", "outbox", "metrics",
                                                          "quarantine")}


def model_predictor(model_path: str) -> Predictor:
    """Classifier from a saved PipelineModel, loaded once and reused by every epoch."""
    from tidepool.operators import classify
    loaded = {}

    def run(df: DataFrame) -> DataFrame:
        if "model" not in loaded:
            loaded["model"] = classify.load(model_path)
        return classify.predict(loaded["model"], df.withColumnRenamed("message", "text")) \
            .withColumnRenamed("text", "message")
    return run
