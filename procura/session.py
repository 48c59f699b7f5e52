"""Session helpers.

On a cluster the session comes from the platform; this module only fills in
settings that are unset, so cluster-wide values (shuffle partitions, checkpoint
folder, AQE) always win.
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings the extracts rely on; applied only where the session leaves them unset.
EXTRACT_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "procura") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Python call-site capture for error messages costs ~2 ms per Column
        # built on the driver; off for batch jobs.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in EXTRACT_DEFAULTS.items():
        builder = builder.config(k, v)
    shared = os.environ.get("SPARK_CHECKPOINT_DIR") or _scratch("procura-ckpt-")
    builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the extract defaults on an existing session where they are unset."""
    for k, v in EXTRACT_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    # The fixture and the extracts compare timestamps as UTC wall time.
    spark.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone", "UTC"))
    return spark


def drop_shuffles(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of plans that nothing holds any more.

    Spark removes them once the driver's collector finds the plans unused; a driver with memory left does not collect,
    and the disks fill with the files of jobs that are over.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) without one gets a fresh scratch folder;
    on a cluster a machine-local folder would be wrong, so the setting is
    required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster (shared stages are written there)")
    path = _scratch("procura-ckpt-")
    sc.setCheckpointDir(path)
    return path


def _scratch(prefix: str) -> str:
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("PROCURA_SCRATCH", "/tmp"))
