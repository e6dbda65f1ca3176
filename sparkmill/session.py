"""Session helpers: a tuned local session for tests/bench and checkpoint-dir lookup."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sparkmill", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench; memory and the like are the caller's (``extra``).
    On a cluster, pass your own session instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Delete checkpoint files once their DataFrames are garbage-collected.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it and
    register it with the SparkContext.  Only a local-mode session without the
    setting (tests, the bench) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/ABFS) "
                "that every executor can reach")
        configured = tempfile.mkdtemp(prefix="sparkmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Spark removes the shuffle files of an execution begun under this setting when it ends.
FREED_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df, name: str):
    """``df`` written as Parquet to the shared folder and read back: cuts lineage like a checkpoint, in less room.

    What was shuffled on the way is not needed again and removed as soon as the table is written (else it stays on the executors' disks until
    the driver happens to collect its garbage).  ``discard`` removes the table itself."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREED_CONF, None)
    spark.conf.set(FREED_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREED_CONF)
        else:
            spark.conf.set(FREED_CONF, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables) -> None:
    """Remove the files of tables as ``written`` returned them, once nothing reads them any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
