"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings the jobs rely on. forceOptimizeSkewedJoin lets AQE split a hot key even
# when the split costs one more shuffle downstream, which is the right trade for a key that
# holds a large part of the rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # The shuffle files of a job go when it ends, not when the driver happens to collect its garbage: a report of many
    # stages holds those of its last stage only. A frame that is run a second time writes them again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Bloom filters of join keys, under the exchange of tables of 10 GB or more: up to some ten million keys, 16 MB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "10000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "10000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 27),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 27),
}

# Settings that only a new session can take. The reports build a thousand expressions, and
# recording a call site for each doubles the time that takes.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; `conf` overrides them (keys as passed to Spark)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def work_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for written intermediate tables.

    A cluster names it in spark.checkpoint.dir. Only a local session may fall back to a
    temporary folder, because there driver and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder(spark.sparkContext.applicationId)
