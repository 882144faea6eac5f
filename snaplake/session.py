"""Session helpers.

The library never creates a session on its own inside an operator; these
helpers are for tests, the bench and command-line use.  On a cluster the
caller's session (and its ``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every snaplake job relies on.  UTC is part of the semantics (all
# timestamps in the lake are UTC); AQE re-plans joins/aggregates at runtime
# and splits skewed shuffle partitions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # INT64 micros instead of the legacy INT96: parquet keeps min/max
    # statistics, so timestamp range filters (quota day/month, date slices)
    # skip row groups at the scan
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Starting points for a large cluster (~100 TB input, ~1000 executors).
# Shuffle partitions are an upper bound that AQE coalesces down to the
# advisory size; file splits of 256 MB keep scan tasks in the thousands;
# the skew-join thresholds let AQE split a partition 5x the median.
CLUSTER_CONF = {
    **CORE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "snaplake") -> SparkSession:
    """A local session for tests and the bench (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); without it there is no folder that all executors see, and
    this raises.  Only a local master gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="snaplake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/snaplake/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: several readers
    share one evaluation, and a lost executor never repeats what came before
    (a cache would hold the rows on the executors' own disks)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
