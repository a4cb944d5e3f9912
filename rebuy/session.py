"""Session helpers.

Library code never creates its own session: every public function takes a
DataFrame or a SparkSession.  ``local_session`` exists for tests, the bench
and the examples only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Confs the feature job relies on.  AQE re-plans joins from runtime sizes
# (broadcast only below autoBroadcastJoinThreshold, measured, never assumed),
# coalesces small shuffle partitions and splits skewed join partitions.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files of DataFrames that went out of scope are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Iterative ML runs thousands of short jobs; a small status history keeps
    # the driver's bookkeeping (and memory) flat instead of growing per job.
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "2000",
    "spark.sql.ui.retainedExecutions": "50",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rebuy") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def on_python_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (a
    cluster that has it installed needs nothing)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session, or what
    ``setCheckpointDir`` was given.  A one-process local session (tests, the
    bench) that names none gets a scratch folder; anywhere else executors
    could not see such a folder, so a missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="rebuy-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
