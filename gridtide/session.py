"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the results depend on: date and time keys are cut in UTC.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Runtime settings the physical plans rely on. AQE sizes and splits shuffle
# partitions from real statistics, also in the rebalance step before a write.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Noting the call site of every column costs several round trips to the JVM each,
# which adds up in plans that are built anew for each micro-batch.
BUILD_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "gridtide",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above.

    On a cluster leave ``master`` to spark-submit and set
    ``shuffle_partitions`` to some multiple of the executor cores: it is the
    upper bound from which AQE coalesces.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF, **BUILD_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session built elsewhere."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine find the package where the driver has it; on a
    cluster it is installed, or sent with ``--py-files``."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables and stream checkpoints.

    It lies below the shared ``spark.checkpoint.dir`` of the cluster. Only a
    local session may fall back to a temporary folder of its one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="gridtide-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return join_path(shared, "gridtide", f"{purpose}-{uuid.uuid4().hex}")


def join_path(root: str, *parts: str) -> str:
    """One slash between parts, whatever the root ends with."""
    return "/".join([root.rstrip("/"), *(part.strip("/") for part in parts)])
