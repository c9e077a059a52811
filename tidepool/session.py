"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, AQE with skew-join splitting so a hot
# duplicate key never lands on a single reducer, last-value-wins JSON objects.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tidepool",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL settings results depend on, for sessions made elsewhere (e.g. the driver)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # pragma: no cover - static conf on some deployments
            pass
    for k, default in (("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "5.0"),
                       ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256MB")):
        if spark.conf.get(k, default) == default:  # left as it is where the session chose a value
            spark.conf.set(k, BASE_CONF[k])


#: Checkpoint folder already registered with the Spark context of each application.
_REGISTERED: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a shared file system path). Only when it is unset,
    as in local tests, a fresh local folder is created and registered.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path and _REGISTERED.get(spark.sparkContext.applicationId) == path:
        return path
    if not path:
        master = spark.sparkContext.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="tidepool-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    _REGISTERED[spark.sparkContext.applicationId] = path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
