"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings worth having on a cluster too. The method limit makes Spark split generated
# code the JVM would refuse to compile (8,000 bytecodes) instead of interpreting it.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with the frames that use them
}


def local_session(cores: str = "8", shuffle_partitions: str = "8", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowsieve")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared checkpoint folder of the session.

    The cluster's ``spark.checkpoint.dir`` wins. A temporary folder is used
    only for a single-process local master; elsewhere a missing setting is an error, since
    executors must be able to read what other executors wrote.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        single = context.master == "local" or context.master.startswith("local[")
        if configured is None and not single:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="flowsieve-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/scratch/{label}-{uuid.uuid4().hex}"
