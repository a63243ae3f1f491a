"""Tables kept by event date, marts that follow their loads, published markers,
contracts held in the write pass."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weir import schemas
from weir.operators.contract import Col, Contract
from weir.plans import marts
from weir.sinks import dated, tables
from weir.sinks.dated import DatedTable
from weir.sinks.tables import ContractError, SnapshotTable, append_held, replace_date

SCHEMA = "k string, at timestamp, v int"
CONTRACT = Contract("facts", (Col("k", "string", False), Col("at", "timestamp", False), Col("v", "int")), ("k",))


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _day(day):
    return dt.date(2024, 1, day)


def _facts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(table):
    return sorted((r.k, r.at, r.v, r.event_date) for r in table.read().collect())


def _table(spark, workdir):
    return DatedTable(spark, workdir + "/t", ["k"], event_time="at")


def test_upsert_moves_keys_and_reports_days(spark, workdir):
    t = _table(spark, workdir)
    got = t.upsert(_facts(spark, [("a", _at(1), 1), ("b", _at(2), 2), ("c", _at(3), 3), ("d", _at(5), 4)]))
    assert got == dated.Changes([_day(1), _day(2), _day(3), _day(5)], 4, 0, 0)
    before = {day: t.folder(day) for day in t.days()}
    # a moves to day 4, b changes, c comes again as it was, e is new on day 2
    got = t.upsert(_facts(spark, [("a", _at(4), 1), ("b", _at(2), 20), ("c", _at(3), 3), ("e", _at(2, 5), 5)]))
    assert got == dated.Changes([_day(1), _day(2), _day(4)], 1, 2, 1)
    assert _rows(t) == [
        ("a", _at(4), 1, _day(4)), ("b", _at(2), 20, _day(2)), ("c", _at(3), 3, _day(3)), ("d", _at(5), 4, _day(5)), ("e", _at(2, 5), 5, _day(2))]
    assert t.days() == [_day(2), _day(3), _day(4), _day(5)]  # day 1 is empty: gone
    assert t.folder(_day(5)) == before[_day(5)]  # not touched: not rewritten
    # moved back and forth: the latest date of the index counts
    t.upsert(_facts(spark, [("a", _at(1), 7)]))
    t.upsert(_facts(spark, [("a", _at(9), 8)]))
    assert [r for r in _rows(t) if r[0] == "a"] == [("a", _at(9), 8, _day(9))]


def test_index_is_compacted(spark, workdir, monkeypatch):
    monkeypatch.setattr(dated, "INDEX_LOADS", 2)
    t = _table(spark, workdir)
    for i in range(6):
        t.upsert(_facts(spark, [("a", _at(i + 1), i), (f"k{i}", _at(9), i)]))
    assert len(t._state(t.version())["index"]) <= 2
    assert [r for r in _rows(t) if r[0] == "a"] == [("a", _at(6), 5, _day(6))] and t.read().count() == 7


def test_hot_day_is_cut_into_files(spark, workdir, monkeypatch):
    monkeypatch.setattr(dated, "ROWS_PER_FILE", 100)
    t = _table(spark, workdir)
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(_at(1)).alias("at"), F.col("id").cast("int").alias("v"))
    t.upsert(rows.unionByName(_facts(spark, [("x", _at(2), 1)])))
    files = lambda day: [n for n in tables._list_names(spark, t.folder(day)) if n.endswith(".parquet")]
    assert len(files(_day(1))) > 1 and len(files(_day(2))) == 1 and t.read().count() == 1001


def test_refused_loads_change_nothing(spark, workdir):
    t = _table(spark, workdir)
    t.upsert(_facts(spark, [("a", _at(1), 1)]), contract=CONTRACT)
    for rows, why in (
        ([("b", _at(1), 1), ("b", _at(2), 2)], "more than once"),
        ([(None, _at(1), 1)], "without a key"),
        ([("b", None, 1)], "facts: not_null|without event_date"),
    ):
        with pytest.raises(ContractError, match=why):
            t.upsert(_facts(spark, rows), contract=CONTRACT)
        assert _rows(t) == [("a", _at(1), 1, _day(1))] and t.version() == 1
    with pytest.raises(ContractError, match="without event_date"):
        t.upsert(_facts(spark, [("b", None, 1)]))


def test_lost_load_is_not_seen_and_replay_is_left_out(spark, workdir, monkeypatch):
    t = _table(spark, workdir)
    t.upsert(_facts(spark, [("a", _at(1), 1)]), load=("s", 0))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(DatedTable, "_publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            t.upsert(_facts(spark, [("a", _at(2), 2)]), load=("s", 1))
    assert _rows(t) == [("a", _at(1), 1, _day(1))] and not t.loaded(("s", 1))
    t.upsert(_facts(spark, [("a", _at(2), 2)]), load=("s", 1))
    assert t.upsert(_facts(spark, [("a", _at(3), 3)]), load=("s", 1)) == dated.Changes()
    assert _rows(t) == [("a", _at(2), 2, _day(2))] and t.loaded(("s", 0)) and not t.loaded(("other", 0))


def test_one_day_mart_reads_one_day(spark, workdir):
    t = _table(spark, workdir)
    t.upsert(_facts(spark, [(f"k{i}", _at(1 + i % 6), i) for i in range(60)]))
    plan = t.read().where(F.col("event_date") == _day(3))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert len(t.read().where(F.col("event_date") == _day(3)).inputFiles()) >= 1
    files = t.read([_day(3)]).inputFiles()
    assert files and all("event_date=2024-01-03" in f for f in files)
    assert t.read([_day(3)]).count() == 10 and t.read([_day(30)]).count() == 0


def _session(i, user, day, minutes=30):
    start = _at(day, 10)
    return (f"s{i}", user, start, start + dt.timedelta(minutes=minutes), minutes * 60, "free", ["/p"], None, None)


def _sessions(spark, rows):
    ddl = ", ".join(f"{c.name} {c.type}" for c in schemas.WATCH_SESSIONS_RAW.columns)
    return spark.createDataFrame(rows, ddl)


def test_late_session_changes_exactly_its_day(spark, workdir):
    t = DatedTable(spark, workdir + "/raw", ["session_id"], event_time="start_time")
    mart = DatedTable(spark, workdir + "/mart", ["activity_date", "user_id"], "activity_date")
    first = [_session(i, f"user_{i % 3}", 1 + i % 5) for i in range(20)]
    marts.refresh_watch_activity(t, mart, t.upsert(_sessions(spark, first)).days)
    folders = {d: mart.folder(d) for d in mart.days()}
    late = [_session(99, "user_1", 3)]
    changes = t.upsert(_sessions(spark, late + first[:2]))  # the others are equal
    assert changes.days == [_day(3)] and (changes.inserted, changes.equal) == (1, 2)
    marts.refresh_watch_activity(t, mart, changes.days)
    assert [d for d in mart.days() if mart.folder(d) != folders[d]] == [_day(3)]
    want = marts.watch_activity_daily(_sessions(spark, first + late))
    assert sorted(map(str, mart.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # the only session of a day moves away: the day is gone from the mart
    marts.refresh_watch_activity(t, mart, t.upsert(_sessions(spark, [_session(50, "user_1", 20)])).days)
    assert _day(20) in mart.days()
    marts.refresh_watch_activity(t, mart, t.upsert(_sessions(spark, [_session(50, "user_1", 21)])).days)
    assert _day(20) not in mart.days() and _day(21) in mart.days()


def test_empty_marker_is_refused(spark, workdir):
    t = SnapshotTable(spark, workdir + "/t")
    t.replace(spark.range(5))
    p, fs = tables._path(spark, f"{t.root}/_commits/{2:020d}")
    fs.create(p, False).close()
    with pytest.raises(ValueError, match="empty marker"):
        t.read()


def test_snapshot_loads_refuse_a_breach_before_publishing(spark, workdir):
    t = SnapshotTable(spark, workdir + "/t")
    short = Contract("short", (Col("k", "string", False), Col("v", "string", True, 3)), ("k",))
    good = spark.createDataFrame([("a", "abc")], "k string, v string")
    bad = spark.createDataFrame([("b", "abcd"), ("c", "abcde")], "k string, v string")
    t.upsert(good, ["k"], contract=short)
    for call in (lambda: t.upsert(bad, ["k"], contract=short), lambda: t.replace(bad, short)):
        with pytest.raises(ContractError, match=r"short: max_length\(v\) 2x"):
            call()
    assert [r.k for r in t.read().collect()] == ["a"] and t.count() == 1
    append_held(good, workdir + "/flat", short)
    with pytest.raises(ContractError):
        append_held(bad, workdir + "/flat", short)
    assert spark.read.parquet(workdir + "/flat").count() == 1
    day = spark.createDataFrame([(_day(1), "u")], "d date, user_id string")
    held = Contract("mart", (Col("d", "date", False), Col("user_id", "string", False)), ("d", "user_id"))
    replace_date(day, workdir + "/mart", "d", _day(1), held)
    with pytest.raises(ContractError):
        replace_date(day.withColumn("user_id", F.lit(None).cast("string")), workdir + "/mart", "d", _day(1), held)
    assert [r.user_id for r in tables.read_partitioned(spark, workdir + "/mart", "d").collect()] == ["u"]


def test_upsert_evaluates_its_source_once(spark, workdir):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        n = 0
        for b in rows:
            n += b.num_rows
            yield b
        seen.add(n)

    source = spark.range(100).mapInArrow(count, "id long")
    t = SnapshotTable(spark, workdir + "/t")
    t.upsert(source, ["id"])
    t.upsert(source, ["id"])
    assert seen.value == 200 and t.read().count() == 100
