"""Join helpers: broadcast only behind a measured size, with a shuffle join beyond it."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir

# Rows of a lookup table (a few narrow columns) that may be broadcast to every executor.
BROADCAST_MAX_ROWS = 2_000_000


#: Paths materialised in the scopes of this thread or task, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


def path_exists(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_paths(spark, paths) -> None:
    """Remove scratch folders through the Hadoop file system that holds them."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


@contextmanager
def scratch_scope(spark):
    """Delete the tables materialised inside the block when it ends (e.g. once per micro-batch,
    after every output that reads them has been written). Scopes of different threads (two
    streaming queries in one driver) do not see each other's tables; a nested scope deletes only
    its own."""
    with scratch_paths() as paths:
        try:
            yield
        finally:
            delete_paths(spark, paths)


@contextmanager
def scratch_paths():
    """The list of tables materialised inside the block, for a caller that deletes them later
    (``delete_paths``), when nothing reads them any more."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)


def note_scratch(path: str) -> None:
    """Hand a path written by other means to the scope around, as ``materialize`` does with its tables."""
    if _SCOPES.get():
        _SCOPES.get()[-1].append(path)


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` once as a parquet table under the shared ``spark.checkpoint.dir`` and read it
    back: one job (an eager ``checkpoint()`` would compute the plan twice, once to count and once
    to write), lineage is cut, and the table survives executor loss. ``keep`` hands the table to
    the scope around the innermost one (it is the block's result).
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    scopes = _SCOPES.get()[:-1] if keep else _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_lookup(table: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Materialise a derived lookup table, count it, and mark it for broadcast only if small.

    Beyond ``max_rows`` the table is joined by shuffle (AQE still splits skewed partitions).
    """
    table = materialize(table)
    if table.count() <= max_rows:
        return F.broadcast(table)
    return table
