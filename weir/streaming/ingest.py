"""Structured Streaming drivers over the same transformations (STM-1, STM-2).

The reference re-reads every collection each hour. Here a collection export
folder is a file stream: each run (``availableNow``) processes only files it
has not seen, and every micro-batch is upserted into the raw table. Progress
lives in a checkpoint below the shared folder, so a lost executor or driver
resumes where it stopped; the target keeps a ledger of the batches it holds,
so that a replayed one is left out.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weir.plans.raw import ingest_stamps
from weir.sinks import rejects
from weir.sinks.dated import DatedTable
from weir.sinks.tables import SnapshotTable, read_text
from weir.sources.files import CORRUPT, SRC, source_order


def collection_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A document collection folder as a stream of JSON-lines files, with
    ``_src`` (file order) and the text of malformed lines attached as in the
    batch reader."""
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    s = reader.json(path)
    # row ids are not allowed on a stream; ``ingest_stream`` completes
    # ``_src`` per micro-batch
    return s.withColumn("_src_file", F.col("_metadata.file_path")).withColumn(
        "_src_block", F.col("_metadata.file_block_start")
    )


def with_batch_order(batch: DataFrame) -> DataFrame:
    """Complete ``_src`` on a micro-batch of ``collection_stream``."""
    if "_src_file" not in batch.columns:
        return batch
    return batch.withColumn(
        SRC, source_order(F.col("_src_file"), F.col("_src_block"), F.monotonically_increasing_id())
    ).drop("_src_file", "_src_block")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to. It is made with the
    checkpoint and stays for its life, so a stream that starts over with a new
    checkpoint is another stream to the ledger of its target."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def ingest_stream(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    table: SnapshotTable | DatedTable,
    keys: Sequence[str],
    checkpoint: str,
    clock: Callable[[], dt.datetime] | None = None,
    contract=None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Run ``build`` (a raw-layer pipeline) on each new micro-batch and upsert
    the result into ``table`` with the ingestion stamps of ``contract`` (STM-1);
    a key that comes again takes the later batch. Returns the started query;
    with ``availableNow`` it stops when the backlog is done.

    A malformed line or a document without a key does not stop the stream: it
    goes to ``rejects_path`` (default: next to the checkpoint), in a folder of
    its batch that a replay writes anew. (stream, epoch) is part of the commit
    of the batch, in the marker of the table's version: a batch that Spark
    replays, also after its commit, is left out. A breach of ``contract`` fails
    the batch and stops the stream before anything of it is stored.
    """
    now = clock or (lambda: dt.datetime.now(dt.timezone.utc))
    spark = stream.sparkSession
    refused = rejects_path or f"{checkpoint.rstrip('/')}-rejects"

    def per_batch(batch: DataFrame, epoch: int) -> None:
        load = (stream_id(spark, checkpoint), epoch)
        if table.loaded(load):
            return
        part = rejects.split(rejects.mark_documents(with_batch_order(batch), keys[0]), "stream")
        rejects.store(part, refused, f"{load[0]}-{epoch:012d}")
        insert_only, stamps = ingest_stamps(F.lit(now()).cast("timestamp"), contract)
        table.upsert(build(part.rows), keys, insert_only=insert_only, stamps=stamps, contract=contract, load=load)

    return (
        stream.writeStream.foreachBatch(per_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _event_time(stream: DataFrame, ts: str) -> DataFrame:
    # ``withWatermark`` needs a TIMESTAMP column
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def first_within(stream: DataFrame, keys: Sequence[str], ts: str, delay: str = "7 days") -> DataFrame:
    """Key de-duplication bounded by event time (STM-2): the first row per key
    is kept while the key is within ``delay`` of the newest event time seen;
    state for older keys is dropped. Rows leave as they come; which row of a
    key is first depends on arrival (``last_within`` does not)."""
    return _event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def last_within(
    stream: DataFrame, keys: Sequence[str], ts: str, order_by: Sequence[str], delay: str = "7 days", width: str | None = None
) -> DataFrame:
    """The last row per key by ``order_by`` (DED-2 on a stream, STM-2): rows
    are reduced to one a key as they arrive, whatever the files of a trigger,
    and a key leaves once the watermark (newest ``ts`` less ``delay``) has
    passed it. ``ts`` is one of the keys, or ``width`` gives the windows of
    ``ts`` within which a key counts.

    A row older than the watermark comes too late: it is dropped and counted
    (``late_rows``). Keys within ``delay`` of the newest event time stay in
    the state of the checkpoint until later events close them.
    """
    if width is None and ts not in keys:
        raise ValueError("keys must include the event time, or give the width of its windows")
    s = _event_time(stream, ts).withWatermark(ts, delay)
    rest = [c for c in s.columns if c not in keys]
    group = [*keys] if width is None else [*keys, F.window(ts, width).alias("_window")]
    last = s.groupBy(*group).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_last"))
    return last.select(*keys, "_last.*")


def late_rows(query: StreamingQuery) -> int:
    """What a finished query dropped as too late, by the metric of its state
    operators: rows, or for ``last_within`` partial groups of a task. Counted
    over the progress reports that the session keeps
    (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, processing the backlog once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
