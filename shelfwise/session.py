"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every shelfwise job relies on.  Time zone is pinned so that dates
# never shift; AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is small, split skewed partitions) and coalesces small shuffles.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts are never forced on data that grows: the plan-time check uses
    # file statistics, the runtime one the measured shuffle output.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "16MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Suggested settings for a large cluster reading ~100 TB (applied by the job
# launcher, not by tests): many initial shuffle partitions that AQE coalesces
# to ~256 MB, 256 MB scan splits, skew splitting from 5x the median.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "shelfwise", extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the shelfwise defaults.

    ``profile="cluster"`` applies ``CLUSTER_CONF`` (sizing for ~100 TB) and
    leaves ``master`` to the launcher (pass ``master=None``); ``"local"`` is
    for tests, the bench and single-machine runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    elif profile == "local":
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        raise ValueError("profile must be 'local' or 'cluster'")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint directory, setting one only if none exists.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if fallback is None and not sc.master.startswith("local"):
        # a driver-local folder is not visible to the executors
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = fallback or tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: computed once
    however often it is read, and its lineage ends there."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
