"""Document collections -> typed raw layer (PIP-7..PIP-11).

Each function is a pure ``DataFrame -> DataFrame`` step over documents read
with the collection schema (``weir.schemas``); loading the result is
``SnapshotTable.upsert`` with ``ingest_stamps``. Nested values stay typed
(arrays/structs) in the raw layer; ``as_json_text`` gives their text form.
With ``schemas.keep_whole`` and ``Contract.whole``, nested values are kept as
VARIANT instead, with the fields that no schema knows (JSN-4).

The duplicate policy is the reference's: first document per key in source
order (``_src`` from the file scan, or any declared order columns).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schemas
from weir.functions.docs import json_text, safe_size, subscription_tier
from weir.functions.temporal import parse_instant, seconds_between
from weir.operators.contract import conform
from weir.operators.dedup import keep_first
from weir.sinks import rejects
from weir.sinks.audit import counted
from weir.sinks.dated import DatedTable
from weir.sinks.tables import SnapshotTable
from weir.sources.files import SRC

# Statuses that close a support case.
CLOSED_STATUSES = ("resolved", "closed")


def _first(df: DataFrame, key: str, order_by: Sequence[str] | None, contract) -> DataFrame:
    """First row per key, conformed to the contract."""
    return conform(keep_first(df, [key], list(order_by or [SRC])), contract)


def watch_sessions(
    docs: DataFrame, order_by: Sequence[str] | None = None, tier_delimiter: str = "_", contract=schemas.WATCH_SESSIONS_RAW
) -> DataFrame:
    """Sessions: UTC instants, whole-second duration, subscription tier (PIP-7)."""
    start, end = parse_instant("start_time"), parse_instant("end_time")
    df = docs.select(
        "session_id",
        "user_id",
        start.alias("start_time"),
        end.alias("end_time"),
        seconds_between(start, end).alias("session_duration_seconds"),
        subscription_tier("user_id", tier_delimiter).alias("subscription_type"),
        "pages_visited",
        "device",
        "actions",
        *(order_by or [SRC]),
    )
    return _first(df, "session_id", order_by, contract)


def playback_events(
    docs: DataFrame, order_by: Sequence[str] | None = None, contract=schemas.PLAYBACK_EVENTS_RAW
) -> DataFrame:
    """Playback events with a UTC instant (PIP-8)."""
    df = docs.select(
        "event_id",
        parse_instant("timestamp").alias("timestamp"),
        "event_type",
        "details",
        *(order_by or [SRC]),
    )
    return _first(df, "event_id", order_by, contract)


def support_cases(
    docs: DataFrame, order_by: Sequence[str] | None = None, contract=schemas.SUPPORT_CASES_RAW
) -> DataFrame:
    """Support cases: resolution time for closed cases, message count (PIP-9)."""
    created, updated = parse_instant("created_at"), parse_instant("updated_at")
    messages = F.col("messages")
    if docs.schema["messages"].dataType.typeName() == "variant":
        messages = F.try_variant_get("messages", "$", "array<variant>")
    df = docs.select(
        "ticket_id",
        "user_id",
        "status",
        "issue_type",
        "messages",
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(F.col("status").isin(*CLOSED_STATUSES), seconds_between(created, updated)).alias(
            "resolution_time_seconds"
        ),
        safe_size(messages).alias("messages_count"),
        *(order_by or [SRC]),
    )
    return _first(df, "ticket_id", order_by, contract)


def recommendations(docs: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Recommendations; the source's ``recommended_products`` is stored as
    ``recommended_content`` and wins over a ``recommended_content`` field (PIP-10)."""
    present = set(docs.columns)
    if "recommended_products" in present and "recommended_content" in present:
        content = F.coalesce(F.col("recommended_products"), F.col("recommended_content"))
    else:
        content = F.col("recommended_products" if "recommended_products" in present else "recommended_content")
    df = docs.select(
        "user_id",
        content.alias("recommended_content"),
        parse_instant("last_updated").alias("last_updated"),
        *(order_by or [SRC]),
    )
    return _first(df, "user_id", order_by, schemas.CONTENT_RECOMMENDATIONS_RAW)


def abuse_reports(docs: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Abuse reports; ``product_id`` is stored as ``object_id`` (PIP-11)."""
    present = set(docs.columns)
    obj = F.col("product_id") if "product_id" in present else F.lit(None).cast("string")
    if "object_id" in present:
        obj = F.coalesce(obj, F.col("object_id"))
    df = docs.select(
        "review_id",
        "user_id",
        obj.alias("object_id"),
        "review_text",
        "rating",
        "moderation_status",
        "flags",
        parse_instant("submitted_at").alias("submitted_at"),
        *(order_by or [SRC]),
    )
    return _first(df, "review_id", order_by, schemas.ABUSE_REPORTS_RAW)


def ingest_stamps(run_time: Column, contract=None) -> tuple[dict[str, Column], dict[str, Column]]:
    """``(insert_only, stamps)`` for an upsert (SNK-8): ``created_at`` set once
    and ``updated_at`` on every load, or ``loaded_at`` alone where the target's
    own columns have these names (support cases). ``run_time`` is one literal
    for the whole load."""
    own = set(contract.names) if contract is not None else set()
    if own & {"created_at", "updated_at"}:
        return {}, {"loaded_at": run_time}
    return {"created_at": run_time}, {"updated_at": run_time}


def load_id(run_time: dt.datetime) -> str:
    """The name of a load in the rejects folder."""
    return run_time.strftime("%Y%m%dT%H%M%S%f")


def load_collection(
    spark: SparkSession,
    docs: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    contract,
    table: SnapshotTable | DatedTable,
    run_time: dt.datetime,
    rejects_path: str | None = None,
) -> dict[str, int]:
    """One load of a document collection (PIP-7..PIP-11, SNK-3, SNK-7, SNK-8).

    The documents are parsed and written aside once; malformed ones and those
    without a key go to ``rejects_path`` under the name of the load, counted by
    the same write. The others are built, one per key (the first in source
    order wins within a load; across loads the later load wins), and upserted
    with the target's stamps in a single pass, which also holds them against
    the contract: a breach fails the load, and nothing is published. A load
    that runs again (same ``run_time``) replaces its rejects. Returns the
    counts of keys loaded and documents rejected.
    """
    (key,) = contract.key
    part = rejects.split(rejects.mark_documents(docs, key), contract.table)
    if rejects_path:
        rejects.store(part, rejects_path, load_id(run_time))
    rows, obs = counted(build(part.rows), f"load-{contract.table}-{uuid.uuid4().hex}")
    insert_only, stamps = ingest_stamps(F.lit(run_time).cast("timestamp"), contract)
    table.upsert(rows, [key], insert_only=insert_only, stamps=stamps, contract=contract)
    return {"loaded": int(obs.get["rows"]), "rejected": part.rejected}


def as_json_text(df: DataFrame) -> DataFrame:
    """Nested columns (arrays, structs) replaced by their JSON text (JSN-3);
    a VARIANT has its fields in alphabetical order there, whatever the order
    in its document."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("array", "struct", "map", "variant"):
            out.append(json_text(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
