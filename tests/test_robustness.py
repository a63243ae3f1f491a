"""Loads that meet broken input, competing writers and failing jobs."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir import schemas, streaming
from weir.operators.bounds import percentiles
from weir.operators.dedup import keep_first
from weir.plans import marts, raw, temperature
from weir.sinks import audit
from weir.sinks.tables import KeyBucketedTable, SnapshotTable, read_partitioned, replace_date
from weir.sources.files import malformed, parse_json_column, read_collection, read_iot_csv, split_rejects

UTC = dt.timezone.utc
AT = dt.datetime(2024, 2, 1, tzinfo=UTC)
CASE = {"ticket_id": "t1", "user_id": "user_1", "status": "open", "issue_type": "x", "messages": [],
        "created_at": "2024-01-01T00:00:00+00:00", "updated_at": "2024-01-02T00:00:00+00:00"}


def _lines(path: str, *lines: str) -> str:
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.json", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _local(workdir: str, name: str) -> str:
    return f"{workdir.removeprefix('file:')}/{name}"


def test_broken_lines_are_rejected_and_counted(spark, workdir):
    src = _lines(_local(workdir, "src"), json.dumps(CASE), '{"ticket_id": "t2", "user', '{"user_id": "user_9"}', "junk")
    docs = read_collection(spark, src, schemas.SUPPORT_CASES)
    good, bad = split_rejects(docs, "ticket_id")
    assert [r.ticket_id for r in good.collect()] == ["t1"]
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "malformed", "no key"]
    table = SnapshotTable(spark, f"{workdir}/raw")
    got = raw.load_collection(spark, docs, raw.support_cases, schemas.SUPPORT_CASES_RAW, table, AT, f"{workdir}/rejects")
    assert got == {"loaded": 1, "rejected": 3}
    assert spark.read.parquet(f"{workdir}/rejects").count() == 3


def test_cases_keep_their_times_batch_and_stream(spark, workdir):
    second = CASE | {"ticket_id": "t2", "user_id": "user_2"}
    src = _lines(_local(workdir, "src"), json.dumps(CASE), json.dumps(second))
    table = SnapshotTable(spark, f"{workdir}/raw")
    stream = streaming.collection_stream(spark, src, schemas.SUPPORT_CASES)
    streaming.ingest_stream(
        stream, raw.support_cases, table, ["ticket_id"], f"{workdir}/ckpt", clock=lambda: AT, contract=schemas.SUPPORT_CASES_RAW
    ).awaitTermination()
    rows = table.read()
    assert {r.created_at.year for r in rows.collect()} == {2024} and "loaded_at" in rows.columns
    reports = spark.createDataFrame([], "user_id string, submitted_at timestamp")
    mart = marts.support_and_abuse_daily(rows, reports, "2024-01-03").collect()
    assert sum(r.support_cases_count for r in mart) == 2
    with pytest.raises(ValueError, match="stamps would replace"):
        table.upsert(rows.drop("loaded_at"), ["ticket_id"], stamps={"updated_at": F.lit(AT)})


def test_contract_breach_stores_nothing(spark, workdir):
    bad = {k: v for k, v in CASE.items() if k != "status"}
    docs = read_collection(spark, _lines(_local(workdir, "src"), json.dumps(bad)), schemas.SUPPORT_CASES)
    table = SnapshotTable(spark, f"{workdir}/raw")
    with pytest.raises(ValueError, match="not_null"):
        raw.load_collection(spark, docs, raw.support_cases, schemas.SUPPORT_CASES_RAW, table, AT)
    assert table.version() is None


def test_malformed_json_column_is_seen(spark):
    df = spark.createDataFrame([("{\"pets\": []}",), ("{oops",), (None,)], "raw string")
    parsed = parse_json_column(df, "raw", schemas.PETS if hasattr(schemas, "PETS") else spark.createDataFrame([], "pets array<string>").schema)
    assert [r.raw for r in malformed(parsed, "raw").collect()] == ["{oops"]


@pytest.mark.parametrize("kind", ["snapshot", "bucketed"])
def test_upsert_holds_its_key(spark, workdir, kind):
    make = lambda: SnapshotTable(spark, f"{workdir}/t") if kind == "snapshot" else KeyBucketedTable(spark, f"{workdir}/t", ["k"], 4)
    args = (["k"],) if kind == "snapshot" else ()
    for rows in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError, match="upsert source"):
            make().upsert(spark.createDataFrame(rows, "k long, v string"), *args)
    make().upsert(spark.createDataFrame([(1, "a")], "k long, v string"), *args)
    make().upsert(spark.createDataFrame([(1, "b")], "k long, v string"), *args)
    assert [(r.k, r.v) for r in make().read().collect()] == [(1, "b")]


def test_losing_writer_changes_nothing(spark, workdir, monkeypatch):
    a, b = SnapshotTable(spark, f"{workdir}/t"), SnapshotTable(spark, f"{workdir}/t")
    a.commit(spark.range(5))
    monkeypatch.setattr(b, "version", lambda: 1)  # read before a's next load
    a.commit(spark.range(100))
    with pytest.raises(Exception):
        b.commit(spark.range(3))
    assert a.read().count() == 100


def test_failed_day_keeps_the_old_rows(spark, workdir):
    mart = f"{workdir}/mart"
    day = dt.date(2024, 1, 1)
    rows = spark.range(4).withColumn("day", F.lit(day))
    replace_date(rows, mart, "day", day)
    fails = rows.withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        replace_date(fails, mart, "day", day)
    assert read_partitioned(spark, mart, "day").count() == 4
    replace_date(rows.where("id < 0"), mart, "day", day)
    assert read_partitioned(spark, mart, "day").count() == 0


def test_fallback_key_does_not_depend_on_splits(spark, workdir):
    random.seed(3)
    path = _local(workdir, "csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w", encoding="utf-8") as f:
        f.write("id,room_id/id,noted_date,temp,out/in\n")
        for _ in range(2000):
            f.write(f",Room Admin,{random.randint(1, 5):02d}-01-2024 10:00,{random.randint(20, 25)},In\n")
    ids = []
    for size in ("1000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            batch = temperature.incremental_batch(read_iot_csv(spark, path), "b")
            ids.append(sorted((r.noted_date, r.device_id) for r in batch.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids[0] == ids[1] and len(set(ids[0])) == 2000


def test_percentiles_of_unrounded_values(spark):
    x = np.random.default_rng(5).normal(size=5001)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(7)
    got = percentiles(df, "v", (0.0, 0.05, 0.5, 0.95, 1.0), ["a", "b", "c", "d", "e"]).first()
    assert np.allclose(list(got), np.quantile(x, [0, 0.05, 0.5, 0.95, 1]), rtol=0, atol=1e-12)
    assert percentiles(df.where("false"), "v").first().p05 is None


def test_default_audit_clock_is_aware(spark, workdir, monkeypatch):
    before = dt.datetime.now(UTC)
    with audit.audited_run(spark, f"{workdir}/log", "t", "b"):
        pass
    seen = spark.read.parquet(f"{workdir}/log").select(F.unix_timestamp(F.min("event_time")).alias("s")).first().s
    assert abs(seen - before.timestamp()) < 120


def test_dedup_plan_limits_groups_before_the_shuffle(spark, workdir):
    spark.range(1000).select((F.col("id") % 3).alias("k"), "id", F.lit("wide").alias("x")).write.parquet(f"{workdir}/t")
    df = keep_first(spark.read.parquet(f"{workdir}/t"), ["k"], ["id"]).select("k", "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "x:string" not in plan
