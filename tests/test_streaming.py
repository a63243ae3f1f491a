"""Streaming drivers: incremental file ingest with upsert, watermark de-dup."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import StreamingQueryException

from weir import schemas, streaming
from weir.plans import raw
import pytest

from weir.plans.queries import forget_last_commit
from weir.sinks import rejects
from weir.sinks.dated import DatedTable
from weir.sinks.tables import SnapshotTable
from weir.sources.files import read_collection

UTC = dt.timezone.utc


def _docs(spark, path, docs):
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1).write.mode("append").text(path)


def _session(sid, user, hour):
    return {"session_id": sid, "user_id": user, "start_time": f"2024-01-03T{hour:02d}:00:00+00:00",
            "end_time": f"2024-01-03T{hour:02d}:30:00+00:00", "pages_visited": ["/home"]}


@pytest.mark.parametrize("kind", ["snapshot", "dated"])
def test_ingest_stream_is_incremental_and_upserts(spark, workdir, kind):
    src, ckpt = workdir + "/src", workdir + "/ckpt"
    if kind == "snapshot":
        table = SnapshotTable(spark, workdir + "/raw")
    else:
        table = DatedTable(spark, workdir + "/raw", ["session_id"], event_time="start_time")
    state = table.version

    def run(at):
        stream = streaming.collection_stream(spark, src, schemas.WATCH_SESSIONS)
        streaming.ingest_stream(stream, raw.watch_sessions, table, ["session_id"], ckpt, clock=lambda: at).awaitTermination()

    t1, t2 = dt.datetime(2024, 2, 1, tzinfo=UTC), dt.datetime(2024, 2, 2, tzinfo=UTC)
    _docs(spark, src, [_session("s1", "user_3", 10), _session("s2", "user_4", 11)])
    run(t1)
    v1 = state()
    run(t2)  # nothing new: no micro-batch, the table stays as it is
    assert state() == v1
    _docs(spark, src, [_session("s2", "user_8", 12), _session("s3", "user_5", 13)])
    run(t2)
    got = {r.session_id: r for r in table.read().collect()}
    assert set(got) == {"s1", "s2", "s3"}
    assert got["s2"].user_id == "user_8" and got["s2"].created_at == dt.datetime(2024, 2, 1)
    assert got["s2"].updated_at == dt.datetime(2024, 2, 2)
    assert got["s1"].updated_at == dt.datetime(2024, 2, 1)


def test_first_within_watermark(spark, workdir):
    src = workdir + "/ev"
    rows = [(dt.datetime(2024, 1, 10, 1), "d1", 1), (dt.datetime(2024, 1, 10, 1), "d1", 2), (dt.datetime(2024, 1, 10, 2), "d2", 3)]
    spark.createDataFrame(rows, "ts timestamp_ntz, dev string, v int").write.parquet(src)
    stream = spark.readStream.schema("ts timestamp_ntz, dev string, v int").parquet(src)
    out = workdir + "/out"
    streaming.append_stream(streaming.first_within(stream, ["ts", "dev"], "ts"), out, workdir + "/ck").awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted((r.dev, r.ts) for r in got) == [("d1", dt.datetime(2024, 1, 10, 1)), ("d2", dt.datetime(2024, 1, 10, 2))]


def _ingest(spark, src, ckpt, table, at):
    stream = streaming.collection_stream(spark, src, schemas.WATCH_SESSIONS)
    streaming.ingest_stream(
        stream, raw.watch_sessions, table, ["session_id"], ckpt, clock=lambda: at, contract=schemas.WATCH_SESSIONS_RAW
    ).awaitTermination()


def test_bad_line_and_replay_give_the_batch_loads_table(spark, workdir):
    """A bad line, a replayed epoch and a key in two batches: the same table
    and rejects as two batch loads of the same files."""
    first = [_session("s1", "user_3", 10), _session("s2", "user_4", 11), {"user_id": "user_9"}]
    second = [_session("s2", "user_8", 12), _session("s3", "user_5", 13)]
    streamed, batch = SnapshotTable(spark, workdir + "/streamed"), SnapshotTable(spark, workdir + "/batch")
    src, ckpt = workdir + "/src", workdir + "/ckpt"
    for n, docs in enumerate((first, second), 1):
        at = dt.datetime(2024, 2, n, tzinfo=UTC)
        for path in (src, f"{workdir}/part{n}"):
            _docs(spark, path, docs)
            spark.createDataFrame([('{"session_id": "s9", "user',)], "value string").write.mode("append").text(path)
        _ingest(spark, src, ckpt, streamed, at)
        version = streamed.version()
        forget_last_commit(spark, ckpt)
        _ingest(spark, src, ckpt, streamed, at + dt.timedelta(days=9))  # the batch runs again
        assert streamed.version() == version
        raw.load_collection(
            spark, read_collection(spark, f"{workdir}/part{n}", schemas.WATCH_SESSIONS), raw.watch_sessions,
            schemas.WATCH_SESSIONS_RAW, batch, at, workdir + "/batch-rejects",
        )
    rows = lambda t: sorted(map(str, t.read().collect()))
    assert rows(streamed) == rows(batch) and len(rows(batch)) == 3
    reasons = lambda path: sorted(r.reason for r in rejects.read(spark, path).collect())
    assert reasons(ckpt + "-rejects") == reasons(workdir + "/batch-rejects") == ["malformed", "malformed", "no key"]


def test_new_checkpoint_is_another_stream(spark, workdir):
    table = SnapshotTable(spark, workdir + "/raw")
    at = dt.datetime(2024, 2, 1, tzinfo=UTC)
    _docs(spark, workdir + "/a", [_session("s1", "user_3", 10)])
    _ingest(spark, workdir + "/a", workdir + "/ckpt-a", table, at)
    _docs(spark, workdir + "/b", [_session("s2", "user_3", 10)])
    _ingest(spark, workdir + "/b", workdir + "/ckpt-b", table, at)  # epoch 0 again, of another stream
    assert {r.session_id for r in table.read().collect()} == {"s1", "s2"}


def test_breach_stops_the_stream_before_anything_is_stored(spark, workdir):
    table = SnapshotTable(spark, workdir + "/raw")
    bad = {k: v for k, v in _session("s1", "user_3", 10).items() if k != "user_id"}
    _docs(spark, workdir + "/src", [bad])
    with pytest.raises(StreamingQueryException, match="not_null"):
        _ingest(spark, workdir + "/src", workdir + "/ckpt", table, dt.datetime(2024, 2, 1, tzinfo=UTC))
    assert table.version() is None


def _readings(spark, path, rows):
    spark.createDataFrame(rows, "ts timestamp_ntz, dev string, seq int").coalesce(1).write.mode("append").parquet(path)


def test_last_within_does_not_depend_on_the_files_of_a_trigger(spark, workdir):
    hour = lambda d, h: dt.datetime(2024, 1, d, h)
    files = [
        [(hour(1, 1), "a", 1), (hour(1, 1), "a", 2), (hour(2, 1), "b", 3)],
        [(hour(1, 1), "a", 4), (hour(5, 1), "a", 5)],
        [(hour(2, 1), "b", 6), (hour(20, 1), "c", 7)],
    ]
    src = workdir + "/src"
    for rows in files:
        _readings(spark, src, rows)
    got = []
    for per_trigger in (1, 100):
        stream = spark.readStream.schema("ts timestamp_ntz, dev string, seq int").option("maxFilesPerTrigger", per_trigger).parquet(src)
        out = f"{workdir}/out-{per_trigger}"
        last = streaming.last_within(stream, ["ts", "dev"], "ts", ["seq"])
        streaming.append_stream(last, out, f"{workdir}/ckpt-{per_trigger}").awaitTermination()
        got.append(sorted((r.dev, r.ts, r.seq) for r in spark.read.parquet(out).collect()))
    # closed by the reading of the 20th; that one itself is still open
    assert got[0] == got[1] == [("a", hour(1, 1), 4), ("a", hour(5, 1), 5), ("b", hour(2, 1), 6)]


def test_late_rows_are_counted(spark, workdir):
    src = workdir + "/src"
    for rows in (
        [(dt.datetime(2024, 1, 20), "a", 1)],
        [(dt.datetime(2024, 1, 21), "a", 2)],
        [(dt.datetime(2024, 1, 2), "a", 3), (dt.datetime(2024, 1, 3), "b", 4), (dt.datetime(2024, 2, 1), "a", 5)],
    ):
        _readings(spark, src, rows)
    stream = spark.readStream.schema("ts timestamp_ntz, dev string, seq int").option("maxFilesPerTrigger", 1).parquet(src)
    query = streaming.append_stream(streaming.last_within(stream, ["ts", "dev"], "ts", ["seq"]), workdir + "/out", workdir + "/ckpt")
    query.awaitTermination()
    assert streaming.late_rows(query) == 2
    assert sorted(r.seq for r in spark.read.parquet(workdir + "/out").collect()) == [1, 2]


def test_last_within_windows_of_other_keys(spark, workdir):
    _readings(spark, workdir + "/src", [(dt.datetime(2024, 1, 1, 5), "a", 1), (dt.datetime(2024, 1, 1, 9), "a", 2), (dt.datetime(2024, 1, 30), "z", 3)])
    stream = spark.readStream.schema("ts timestamp_ntz, dev string, seq int").parquet(workdir + "/src")
    with pytest.raises(ValueError, match="width"):
        streaming.last_within(stream, ["dev"], "ts", ["seq"])
    last = streaming.last_within(stream, ["dev"], "ts", ["seq"], width="1 day")
    streaming.append_stream(last, workdir + "/out", workdir + "/ckpt").awaitTermination()
    assert [(r.dev, r.seq) for r in spark.read.parquet(workdir + "/out").collect()] == [("a", 2)]
