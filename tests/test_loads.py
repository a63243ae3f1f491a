"""Load strategies: append, replace, upsert, per-date replace, audits."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from weir.operators.dedup import keep_first, keep_last
from weir.plans.queries import QUERIES
from weir.sinks import audit
from weir.sinks.tables import BUCKET, KeyBucketedTable, SnapshotTable, append, key_bucket, merge, merge_grouped, read_partitioned, replace_date, replace_dates

UTC = dt.timezone.utc
T1 = dt.datetime(2024, 2, 1, tzinfo=UTC)
T2 = dt.datetime(2024, 2, 2, tzinfo=UTC)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, note string")


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_append_doubles(spark, workdir):
    df = _frame(spark, [("a", 1, "x"), ("b", 2, "y")])
    append(df, workdir + "/t")
    append(df, workdir + "/t")
    assert spark.read.parquet(workdir + "/t").count() == 4


def test_replace_is_whole_and_versioned(spark, workdir):
    t = SnapshotTable(spark, workdir + "/t")
    assert t.version() is None
    t.replace(_frame(spark, [("a", 1, "x")]))
    old = t.read()
    t.replace(_frame(spark, [("b", 2, "y"), ("c", 3, "z")]))
    assert t.version() == 2
    assert _sorted(t.read()) == [("b", 2, "y"), ("c", 3, "z")]
    # a reader of the previous version is not disturbed
    assert _sorted(old) == [("a", 1, "x")]


def test_upsert_semantics(spark, workdir):
    t = SnapshotTable(spark, workdir + "/t")
    ins, stamps = {"created_at": F.lit(T1).cast("timestamp")}, {"updated_at": F.lit(T1).cast("timestamp")}
    t.upsert(_frame(spark, [("a", 1, "first"), ("b", 2, "first")]), ["k"], update_cols=["v"], insert_only=ins, stamps=stamps)
    ins2, stamps2 = {"created_at": F.lit(T2).cast("timestamp")}, {"updated_at": F.lit(T2).cast("timestamp")}
    t.upsert(_frame(spark, [("b", 20, "second"), ("c", 3, "second")]), ["k"], update_cols=["v"], insert_only=ins2, stamps=stamps2)
    got = {r.k: r for r in t.read().collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].v, got["a"].note) == (1, "first")
    # listed column updated, unlisted column kept
    assert (got["b"].v, got["b"].note) == (20, "first")
    assert got["b"].created_at == dt.datetime(2024, 2, 1) and got["b"].updated_at == dt.datetime(2024, 2, 2)
    assert got["a"].updated_at == dt.datetime(2024, 2, 1)
    assert got["c"].created_at == dt.datetime(2024, 2, 2) and got["c"].note == "second"


def test_upsert_twice_equals_once(spark, workdir):
    src = _frame(spark, [("a", 1, "x"), ("b", 2, "y")])
    target = _frame(spark, [("b", 9, "old"), ("z", 0, "keep")])
    once = merge(target, src, ["k"])
    twice = merge(once, src, ["k"])
    assert _sorted(once) == _sorted(twice)


def test_vacuum_keeps_newest_versions(spark, workdir):
    t = SnapshotTable(spark, workdir + "/t")
    for i in range(4):
        t.replace(_frame(spark, [(f"k{i}", i, "x")]))
    assert t.vacuum(keep=2) == [1, 2]
    assert t.version() == 4 and _sorted(t.read()) == [("k3", 3, "x")]
    t.replace(_frame(spark, [("k4", 4, "x")]))
    assert t.vacuum(keep=2) == [3]
    assert t.vacuum(keep=2) == []
    assert _sorted(t.read()) == [("k4", 4, "x")]
    with pytest.raises(ValueError):
        t.vacuum(keep=0)


def _stamps(ts):
    return {"created_at": F.lit(ts).cast("timestamp")}, {"updated_at": F.lit(ts).cast("timestamp")}


def test_bucketed_upsert_equals_snapshot_upsert(spark, workdir):
    first = _frame(spark, [(f"k{i}", i, "first") for i in range(40)])
    second = _frame(spark, [("k3", 30, "second"), ("k7", 70, "second"), ("new", 1, "second")])
    snap = SnapshotTable(spark, workdir + "/snap")
    bucketed = KeyBucketedTable(spark, workdir + "/bucketed", ["k"], 8)
    for table in (snap, bucketed):
        ins, st = _stamps(T1)
        table.upsert(first, ["k"], update_cols=["v"], insert_only=ins, stamps=st)
        ins, st = _stamps(T2)
        table.upsert(second, ["k"], update_cols=["v"], insert_only=ins, stamps=st)
    cols = ["k", "v", "note", "created_at", "updated_at"]
    assert _sorted(bucketed.read().select(*cols)) == _sorted(snap.read().select(*cols))
    got = {r.k: r for r in bucketed.read().collect()}
    assert (got["k3"].v, got["k3"].note, got["k3"].created_at, got["k3"].updated_at) == (
        30, "first", dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2))
    assert got["new"].created_at == dt.datetime(2024, 2, 2) and len(got) == 41


def _bucket_files(spark, root):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for d in fs.listStatus(p):
        name = d.getPath().getName()
        if name.startswith(BUCKET + "="):
            out[name] = sorted(f.getPath().getName() for f in fs.listStatus(d.getPath()) if f.getPath().getName().endswith(".parquet"))
    return out


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, workdir):
    table = KeyBucketedTable(spark, workdir + "/t", ["k"], 16)
    table.upsert(_frame(spark, [(f"k{i}", i, "x") for i in range(200)]))
    before = _bucket_files(spark, table.root)
    assert len(before) == 16 and all(len(f) == 1 for f in before.values())
    src = _frame(spark, [("k5", 500, "y")])
    touched = {f"{BUCKET}={r[0]}" for r in src.select(key_bucket(["k"], 16)).collect()}
    table.upsert(src)
    after = _bucket_files(spark, table.root)
    changed = {b for b in before if before[b] != after[b]}
    assert changed == touched
    assert table.read().count() == 200
    assert table.read().filter("k = 'k5'").first().v == 500
    # the same load again leaves the table as it is
    rows = _sorted(table.read())
    table.upsert(src)
    assert _sorted(table.read()) == rows


def test_replace_date_idempotent_and_clears(spark, workdir):
    root = workdir + "/mart"
    rows = [(dt.date(2024, 1, d), f"u{u}", d * 10 + u) for d in (1, 2, 3) for u in (1, 2)]
    df = spark.createDataFrame(rows, "activity_date date, user_id string, n int")
    replace_dates(df, root, "activity_date", spread_by=["user_id"])
    before = _sorted(read_partitioned(spark, root, "activity_date"))
    replace_date(df, root, "activity_date", "2024-01-02")
    replace_date(df, root, "activity_date", "2024-01-02")
    assert _sorted(read_partitioned(spark, root, "activity_date")) == before
    replace_date(df.filter(F.lit(False)), root, "activity_date", "2024-01-03")
    after = read_partitioned(spark, root, "activity_date")
    assert {r.activity_date for r in after.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    # a backfill leaves days absent from its input alone
    replace_dates(df.filter(F.col("activity_date") == dt.date(2024, 1, 1)), root, "activity_date")
    assert read_partitioned(spark, root, "activity_date").count() == 4


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dedup_independent_of_partitioning(spark, parts):
    rows = [(f"k{i % 5}", i, f"v{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(parts)
    first = {r.k: r.o for r in keep_first(df, ["k"], ["o"]).collect()}
    last = {r.k: r.o for r in keep_last(df, ["k"], ["o"]).collect()}
    assert first == {f"k{j}": j for j in range(5)}
    assert last == {f"k{j}": 35 + j for j in range(5)}


def test_audit_run_success_and_failure(spark, workdir):
    log = workdir + "/log"
    ticks = iter([T1, T1 + dt.timedelta(minutes=5), T2, T2 + dt.timedelta(minutes=1)])
    clock = lambda: next(ticks)
    with audit.audited_run(spark, log, "incremental", "b1", clock=clock) as run:
        run["records"] = 42
    with pytest.raises(ValueError):
        with audit.audited_run(spark, log, "incremental", "b2", clock=clock):
            raise ValueError("bad input")
    state = {r.batch_id: r for r in audit.run_state(spark.read.parquet(log)).collect()}
    assert state["b1"].load_status == "success" and state["b1"].records_loaded == 42
    assert state["b1"].start_date == dt.datetime(2024, 2, 1) and state["b1"].end_date == dt.datetime(2024, 2, 1, 0, 5)
    assert state["b2"].load_status == "failed" and "bad input" in state["b2"].error_message


def test_observed_count_matches_rows_written(spark, workdir):
    df = spark.range(1234).withColumnRenamed("id", "k")
    counted, obs = audit.counted(df, "n")
    t = SnapshotTable(spark, workdir + "/t")
    t.replace(counted)
    assert obs.get["rows"] == t.read().count() == 1234


def test_batch_ids():
    assert audit.incremental_batch_id(dt.datetime(2024, 1, 31, 2, 0, 5)) == "inc_20240131_020005"
    a, b = audit.full_batch_id(), audit.full_batch_id()
    assert a != b and len(a) == 36


def test_dedup_takes_whole_rows_with_ties(spark):
    import random

    rnd = random.Random(7)
    rows = [(f"k{rnd.randrange(6)}", rnd.randrange(3), f"a{rnd.randrange(4)}", rnd.randrange(5)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, a string, b int").repartition(5)
    seen = set(rows)
    for pick in (keep_first, keep_last):
        out = pick(df, ["k"], ["o"]).collect()
        assert len(out) == len({r[0] for r in rows})
        for r in out:
            assert tuple(r) in seen  # every output row is one input row
        best = {}
        for k, o, *_ in rows:
            best[k] = o if k not in best else (min if pick is keep_first else max)(best[k], o)
        assert {r.k: r.o for r in out} == best


def test_bucketed_cluster_by_sorts_each_bucket_file(spark, workdir):
    import glob

    import pyarrow.parquet as pq

    table = KeyBucketedTable(spark, workdir + "/t", ["k"], 4, cluster_by=["v"])
    table.upsert(_frame(spark, [(f"k{i}", (i * 37) % 101, "x") for i in range(300)]))
    table.upsert(_frame(spark, [("k1", 1000, "y"), ("new", -5, "y")]))
    files = glob.glob(table.root.removeprefix("file:") + f"/{BUCKET}=*/*.parquet")
    assert len(files) == 4
    for f in files:
        v = pq.read_table(f).column("v").to_pylist()
        assert v == sorted(v)
    assert table.read().count() == 301


def test_bucketed_upsert_plan_prunes_target_and_shuffles_once(spark, workdir):
    table = KeyBucketedTable(spark, workdir + "/t", ["k"], 8)
    table.upsert(_frame(spark, [(f"k{i}", i, "x") for i in range(100)]))
    plans = []
    original = KeyBucketedTable._write
    KeyBucketedTable._write = lambda self, df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    try:
        table.upsert(_frame(spark, [("k1", 10, "y")]))
    finally:
        KeyBucketedTable._write = original
    plan = plans[0]
    touched = _frame(spark, [("k1", 10, "y")]).select(key_bucket(["k"], 8)).first()[0]
    # only the touched bucket is read from the target (a one-value IN shows as =)
    scan = next(ln for ln in plan.splitlines() if "FileScan parquet" in ln)
    assert re.search(rf"PartitionFilters: \[.*\(_bucket#\d+ = {touched}\)", scan), scan
    # one shuffle of the rows, on the bucket, and no other exchange
    exchanges = [ln for ln in plan.splitlines() if "Exchange" in ln]
    assert len(exchanges) == 1 and "hashpartitioning(_bucket" in exchanges[0], exchanges
    # an empty source writes nothing
    table.upsert(_frame(spark, []))
    assert table.read().count() == 100


def test_upsert_shuffles_each_side_once(spark):
    """A source that comes from a window on the key is not shuffled again."""
    rows = spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.lit("x").alias("note"))
    first = keep_first(rows, ["k"], ["v"])
    plan = merge_grouped(rows, first, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_reports_export_is_compressed_and_first_in_source_order_wins(spark, workdir):
    """Lines that repeat (orderkey, linenumber): the smallest by its own columns
    is loaded, whatever the order of the table's rows."""
    at = dt.datetime(1998, 1, 1)
    orders = [(o, o % 3, "F", 1.0, at, "1-URGENT") for o in range(40)]
    line = lambda o, p: (o, p, 1, 1, float(p), 1.0, 0.0, 0.0, "N", "O", at)
    lines = [line(o, p) for p in (9, 5, 7) for o in range(40)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ).write.parquet(f"{workdir}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).repartition(3).write.parquet(f"{workdir}/lineitem.parquet")
    for name in ("load_raw_reports", "stream_ingest_reports"):
        got = QUERIES[name](spark, workdir)
        exports = got.inputFiles()[0].split("/raw/")[0].removeprefix("file:")
        assert {(r.review_id, r.object_id) for r in got.collect()} == {(f"abuse_{o}_1", "vid_5") for o in range(40)}
        files = [f for d, _, fs in os.walk(exports) if "/export" in d for f in fs if f.startswith("part-")]
        assert files and all(f.endswith(".gz") for f in files)
