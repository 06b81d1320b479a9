"""Session helpers: a local session for tests and benches, and materialisation
that survives executor loss.

Stored intermediates go to the checkpoint directory that the cluster
configured (``spark.checkpoint.dir``).  A folder of our own is set only where
none is configured, as in tests and local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "weatherlake", scratch: str | None = None) -> SparkSession:
    """A local session for tests and benches.

    Sets a checkpoint directory under ``scratch`` (a fresh temporary folder
    when omitted) only if the session has none.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_dir(spark):
        base = scratch or tempfile.mkdtemp(prefix="weatherlake-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of the session, if one is configured."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return spark.sparkContext.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small intermediate used by an iterative loop.

    With a configured checkpoint folder the frame is checkpointed (reliable:
    it survives the loss of the executors that computed it).  Without one the
    frame is persisted memory-and-disk; a lost block is then recomputed from
    its (short, non-growing) lineage.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def compiled_methods(spark: SparkSession) -> None:
    """Wide projections: the JVM compiles no method above 8000 bytes and runs
    it interpreted, several times slower; Spark's own limit for whole-stage
    code is 64 KB.  Larger stages then run operator by operator, in methods
    that Spark splits.  Lower settings are kept."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key, "65535")) > 8000:
        spark.conf.set(key, "8000")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the session's checkpoint directory, which the
    driver and all executors see."""
    base = checkpoint_dir(spark)
    if not base:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weatherlake-ckpt-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base}/{name}-{uuid.uuid4().hex}"
