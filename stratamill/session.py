"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession


PARTITION_BYTES = 512 * 1024**2
# Bytes of bytecode beyond which the JVM does not compile a method.
METHOD_LIMIT = 8000


def shuffle_partitions(shuffled_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """How many partitions a shuffle of that size starts with, so that each one fits a task's memory.

    AQE joins small neighbours afterwards, so the number should suit the largest shuffle of the job.
    """
    return max(2 * cores, -(-shuffled_bytes // partition_bytes))


def build_session(app_name: str = "stratamill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job relies on; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        # A number that does not fit its type stops a load instead of becoming NULL.
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join even where the next operator then needs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.ui.showConsoleProgress": "false",
        # Wide typed projections generate methods the JVM refuses to compile; beyond its limit of 8000 bytes of
        # bytecode a stage is better run from smaller generated pieces.
        "spark.sql.codegen.hugeMethodLimit": str(METHOD_LIMIT),
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder: on a cluster other executors could not
    read it back.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def observed(seen: Observation) -> dict:
    """What an observation has counted; nothing where the observed part had no rows, so that Spark left it out of the plan."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" in error.java_exception.toString():
            return {}
        raise


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Within it a stage whose generated method the JVM would only interpret is run from smaller pieces, as in a session of
    ``build_session``: rows of many columns are several times cheaper so. The session's own limit comes back afterwards."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), METHOD_LIMIT)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system it lies in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_space(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A shared scratch folder for one run's intermediate tables, removed when the run ends, also by an error."""
    path = scratch_dir(spark, purpose)
    try:
        yield path
    finally:
        remove_dir(spark, path)
