"""Session helpers: a local session for tests/bench and the checkpoint folder.

Iterative operators cut their lineage every round by writing the state as a
Parquet table under the checkpoint folder and reading it back.  The folder
comes from the session (``spark.checkpoint.dir`` or
``SparkContext.setCheckpointDir``); on a cluster it must be a shared
filesystem, so we only invent one ourselves when Spark runs in local mode and
nothing is configured.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "graphcluster",
                  driver_memory: str = "16g") -> SparkSession:
    """A local session sized like the tests and the bench (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version", "2")
        .config("spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if it is unset.

    Order: the SparkContext's folder, then the ``spark.checkpoint.dir``
    setting; a private temp folder only in local mode.  On a cluster with
    nothing configured we refuse rather than write to a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="graphcluster-ckpt-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError(
        "graphcluster needs a shared checkpoint folder: set spark.checkpoint.dir "
        "(HDFS / object store) on the cluster")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder, for written intermediate tables.

    Only a name is made here: Spark's writers create the folder through the
    Hadoop file system that the checkpoint folder's URI names, so ``hdfs://``,
    ``dbfs:/``, ``file:/`` and plain paths all stay as they were given.
    """
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
