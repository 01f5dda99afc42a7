"""Session settings and the shared working folder."""

import functools
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE sizes the shuffle partitions, splits skewed join partitions and turns a shuffled join
# into a broadcast one when the measured side is under spark.sql.autoBroadcastJoinThreshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster the caller brings the session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pricemill")
    settings = SETTINGS | {"spark.sql.shuffle.partitions": str(partitions)} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary folder stands in.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


def _local_folder() -> str:
    """A folder that goes when the process ends."""
    return _temporary().name


@functools.cache
def _temporary() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="pricemill-", ignore_cleanup_errors=True)


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    return os.path.join(shared_folder(spark), purpose, uuid.uuid4().hex)
