"""Session helper and shared-folder handling."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset in local mode (tests) a private folder is created; elsewhere that is an error,
    since a folder of one machine is lost with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for round trips and model files)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def reliable_checkpoint(df):
    """Materialize ``df`` in the shared checkpoint folder and cut its lineage (never a local,
    executor-bound checkpoint: lost executors must not lose the data)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """``df`` as a Parquet table in the shared checkpoint folder: cuts lineage, survives lost executors, and later
    reads take only the columns that they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 * 1024 * 1024,
                     max_split_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run: enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the input (AQE coalesces the small ones and splits skewed
    join partitions), at least two waves of tasks, and scan splits bounded so a task's input
    fits executor memory.  Apply with ``get_session(extra=recommended_conf(...))``."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    split = max(32 * 1024 * 1024, min(max_split_bytes, input_bytes // max(1, 2 * total_cores)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
