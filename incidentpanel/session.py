"""Session defaults and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on.  Shuffle width is left to the cluster:
# AQE coalesces it downwards, so a cluster should start from a generous number.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffles may feed heavy work (windows, models): keep them parallel.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Fixed when the session starts: no call-site capture for every column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "incidentpanel", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: ``spark.checkpoint.dir``, or what the context was given."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    found = configured or context.getCheckpointDir()
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found


def own_scratch(spark: SparkSession) -> SparkSession:
    """For tests and trials: give a session on one machine a temporary folder if it has none.

    On a cluster nothing is set, so a missing folder is reported where it is needed.
    """
    context = spark.sparkContext
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir())
    if unset and re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="incidentpanel-"))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the scratch root."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(spark: SparkSession, df):
    """Reliable checkpoint in the shared folder (survives lost executors)."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
