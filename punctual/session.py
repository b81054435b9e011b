"""Session helpers: recommended configuration and the shared working folder."""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import SparkSession

# Nothing here fixes a degree of parallelism: adaptive execution starts from
# the cluster's own shuffle setting, merges small partitions and splits skewed
# ones at run time.
TUNING = {
    # Wide projections fused into one method pass the 8,000 bytes of code from
    # which HotSpot compiles nothing. Below this limit Spark generates one
    # projection per operator, in small methods: 3 to 13 times faster on the
    # flight rules.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
RECOMMENDED = {
    **TUNING,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # building wide plans is several times faster without call-site capture
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return configured.rstrip("/")


# Scratch tables of this process; results read them lazily, so they go last.
_SCRATCH: list[str] = []


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A path for one intermediate table, unique to this call and removed when
    the application ends."""
    if not _SCRATCH:
        atexit.register(remove_scratch)
    path = f"{shared_folder(spark)}/punctual-{label}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove_scratch() -> None:
    """Delete this process's scratch tables through Spark's file systems."""
    jvm, context = SparkContext._jvm, SparkContext._active_spark_context
    try:
        while _SCRATCH and jvm is not None:
            path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
            live = context is not None and context._jsc is not None
            settings = (
                context._jsc.hadoopConfiguration()
                if live
                else jvm.org.apache.hadoop.conf.Configuration()
            )
            path.getFileSystem(settings).delete(path, True)
    except (Py4JError, OSError):
        # at the very end the JVM may be gone; then there is nobody left to ask
        _SCRATCH.clear()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs a checkpoint folder unless the session has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
