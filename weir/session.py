"""Spark session settings the library relies on, and the shared work folder.

Every transformation assumes a UTC session time zone (dates of instants are
taken in UTC, as the reference's warehouse did) and ANSI mode (a malformed
value in a strict parse fails the job instead of turning into NULL).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # per-date replace relies on static overwrite semantics (see sinks.tables)
    "spark.sql.sources.partitionOverwriteMode": "static",
    # INT96 (the default) stores no min/max statistics, so a day filter on a
    # stored table could never skip a row group; microsecond timestamps do
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # compressed rows take tens of times their size on disk once read: a task
    # that sorts or groups 128 MB (the default) of them would spill
    "spark.sql.files.maxPartitionBytes": "16m",
}

# Settings that only take effect when the session is created.
STARTUP_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "weir",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``shuffle_partitions`` should follow the data size: a few per core for
    local runs, thousands on a cluster (AQE coalesces small ones away).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_CONF, **RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session created elsewhere."""
    # listing many folders: a few tasks a core (10,000 tasks otherwise, most of
    # which start for a single folder on a small cluster)
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}
    for key, value in (RUNTIME_CONF | listing).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Loads, staging tables and lineage cuts go below it, so they survive the
    loss of any executor. Only a local session without the setting gets a
    folder of its own (tests); a cluster session without it is an error.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weir-ckpt-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run of ``name``."""
    return f"{shared_dir(spark)}/weir/{name}-{uuid.uuid4().hex[:12]}"
