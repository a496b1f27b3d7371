"""Session helpers for tests, the bench and scratch output locations.

Library operators never create a session; the caller owns it.  Jobs that
write intermediate tables (streaming checkpoints, landed copies) put them
under the cluster's shared ``spark.checkpoint.dir``; only when that is
unset (local tests) do we pick a directory ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for large clusters (pass to your own session builder).  AQE sizes
# shuffle partitions from a large initial number and splits skewed joins;
# splits of 256 MB keep scan tasks few without spilling; the checkpoint
# folder must be shared storage.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.session.timeZone": "UTC",
    # streaming window state off the JVM heap, checkpointed incrementally
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "candlestack", conf: dict | None = None) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("CANDLESTACK_DRIVER_MEM", "8g"),
    }
    settings.update(conf or {})
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; a private temp folder is set only when the
    setting is absent (local tests), never overriding a cluster value.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: only the configuration is visible
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="candlestack-chk-")  # local mode only (tests)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/candlestack/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "materialized"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back.

    Used before operators that read their input twice (series positions,
    scalar subqueries): the expensive upstream plan runs once, and the
    lineage is cut, so a lost executor re-reads files in shared storage
    instead of recomputing from the raw scan.  (``Dataset.checkpoint`` would
    compute the plan twice unless cached; a written table does not.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
