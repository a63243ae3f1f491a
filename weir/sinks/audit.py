"""Load audits (SNK-5, SNK-6).

The run log is append-only: each state change of a load is a new row, and
the current state of a batch is its latest row (``max_by`` per batch). This
replaces the reference's UPDATE of the started row, and also records
failures, which the reference never wrote.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.sinks.tables import append

LOAD_HISTORY = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("load_type", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("load_status", T.StringType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# Load states of the run log.
STARTED, SUCCESS, FAILED = "started", "success", "failed"

# Fixed value: batch-id format of incremental loads.
INCREMENTAL_BATCH_FORMAT = "inc_%Y%m%d_%H%M%S"


def incremental_batch_id(at: dt.datetime) -> str:
    """Batch id of an incremental load started at ``at`` (DAT-7)."""
    return at.strftime(INCREMENTAL_BATCH_FORMAT)


def full_batch_id() -> str:
    """A fresh random batch id for a full load (DAT-7)."""
    return str(uuid.uuid4())


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills in while ``df`` is written: the count
    comes with the write, not from a second scan (AGG-10)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def record_full_load(spark: SparkSession, path: str, batch_id: str, records: int, at: dt.datetime) -> None:
    """One audit row per full load (SNK-5)."""
    append(spark.createDataFrame([(batch_id, int(records), at)], LOAD_HISTORY), path)


def log_event(
    spark: SparkSession,
    path: str,
    load_type: str,
    batch_id: str,
    at: dt.datetime,
    status: str,
    records: int | None = None,
    error: str | None = None,
) -> None:
    row = (load_type, batch_id, at, status, None if records is None else int(records), error)
    append(spark.createDataFrame([row], RUN_LOG), path)


@contextmanager
def audited_run(spark: SparkSession, path: str, load_type: str, batch_id: str, clock=None):
    """Log ``started``; on exit log ``success`` with the count put in the
    yielded dict under ``records``, or ``failed`` with the error (SNK-6)."""
    now = clock or (lambda: dt.datetime.now(dt.timezone.utc))
    log_event(spark, path, load_type, batch_id, now(), STARTED)
    box: dict = {}
    try:
        yield box
    except Exception as exc:  # recorded, then re-raised
        log_event(spark, path, load_type, batch_id, now(), FAILED, error=f"{type(exc).__name__}: {exc}")
        raise
    log_event(spark, path, load_type, batch_id, now(), SUCCESS, records=box.get("records"))


def run_state(log: DataFrame) -> DataFrame:
    """Current state per batch: status, counts and end time of its latest
    event; start time of its ``started`` event."""
    latest = F.max_by(
        F.struct("load_status", "records_loaded", "error_message", "event_time"),
        F.struct("event_time", F.col("load_status") != F.lit(STARTED)),
    )
    return (
        log.groupBy("load_type", "batch_id")
        .agg(
            F.min(F.when(F.col("load_status") == STARTED, F.col("event_time"))).alias("start_date"),
            latest.alias("_last"),
        )
        .select(
            "load_type",
            "batch_id",
            "start_date",
            F.when(F.col("_last.load_status") != STARTED, F.col("_last.event_time")).alias("end_date"),
            F.col("_last.records_loaded").alias("records_loaded"),
            F.col("_last.load_status").alias("load_status"),
            F.col("_last.error_message").alias("error_message"),
        )
    )
