"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every sitewatts job wants. Shuffle partition count is left to the
# caller (cluster default); AQE coalesces small partitions and splits skewed
# ones at runtime, so one number does not have to fit every stage.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Starting points for a large cluster (100 TB of readings, ~1000 executors):
# many initial shuffle partitions that AQE coalesces to ~256 MB, 512 MB scan
# splits (~200k scan tasks over 100 TB), skew splitting above 1 GB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_session(
    master: str | None = None,
    app_name: str = "sitewatts",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Build (or reuse) a SparkSession with the sitewatts defaults.

    ``cluster=True`` adds ``CLUSTER_CONF`` (sizes for the large deployment).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a local one only if unset.

    On a cluster the folder must be shared storage named by the cluster in
    ``spark.checkpoint.dir``; without it this raises. The local fallback exists for
    sessions of one machine only.
    """
    existing = checkpoint_dir(spark)
    if existing:
        spark.sparkContext.setCheckpointDir(existing)
        return existing
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sitewatts-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local
