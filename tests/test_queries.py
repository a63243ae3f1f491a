"""Every registered query of the base library against its DuckDB oracle on the
smallest tables, plus plan checks on the physical plans. The training-data
operators are checked in ``tests/llm``."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402
from weir.plans.oracle import ORACLE  # noqa: E402
from weir.plans.queries import QUERIES  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

# Physical operators that mean Python runs per row or per batch.
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# queries whose single-partition step is bounded by k rows or one global row
SINGLE_PARTITION_OK = {
    "temp_percentiles", "temp_trimmed", "temp_daily_stats", "temp_hottest", "temp_coldest", "temp_extremes",
    "incremental_window", "dedup_last", "temp_incremental", "incremental_fallback_key",
    "temp_incremental_summary", "contract_violations", "load_upsert_composite", "audit_run_state", "load_rejects",
    "load_rejects_counted",
}


@pytest.fixture(scope="module")
def results(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    out = {}
    for name, q in QUERIES.items():
        df = q(spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = [tuple(r) for r in df.collect()]
        res = con.execute(ORACLE[name])
        out[name] = (df.columns, rows, [d[0] for d in res.description], res.fetchall(), plan)
    return out


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["activity_date", "user_id", "sessions_count", "total_watch_time_minutes", "videos_count", "premium_ratio"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(results, name):
    s_cols, s_rows, o_cols, o_rows, _ = results[name]
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_and_no_unbounded_single_partition(results, name):
    plan = results[name][4]
    assert not any(node in plan for node in PYTHON_NODES)
    if name not in SINGLE_PARTITION_OK:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_broadcast_of_sides_that_grow(results, name):
    """Equi-joins in the queries pair sides that both grow with the data
    (orders with their lines, target with source, per-user aggregates), so
    none may be broadcast. The only broadcasts are the one-row bounds of the
    trailing window and percentile band (nested-loop joins)."""
    plan = results[name][4]
    assert "BroadcastHashJoin" not in plan


def test_day_filter_reaches_parquet_scan(spark, workdir):
    from weir.plans import marts
    from weir.plans.queries import sessions_raw
    from weir.sinks.tables import SnapshotTable

    t = SnapshotTable(spark, workdir + "/raw")
    t.replace(sessions_raw(spark, SF_SMALL))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = marts.watch_activity_daily(t.read(), "1998-06-15")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(start_time), GreaterThanOrEqual(start_time" in plan
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "pages_visited" in read_schema and "start_time" in read_schema
    for pruned in ("device", "actions", "end_time", "session_id"):
        assert pruned not in read_schema


def _row_groups_overlapping(path, col, lo, hi):
    import glob

    import pyarrow.parquet as pq

    total = hit = 0
    for f in glob.glob(path.removeprefix("file:") + "/*.parquet"):
        md = pq.ParquetFile(f).metadata
        idx = md.schema.to_arrow_schema().get_field_index(col)
        for g in range(md.num_row_groups):
            st = md.row_group(g).column(idx).statistics
            total += 1
            hit += st.min < hi and st.max >= lo
    return hit, total


def test_clustered_snapshot_lets_a_day_skip_row_groups(spark, workdir):
    import datetime as dt

    from weir.plans.queries import sessions_raw
    from weir.sinks.tables import SnapshotTable

    utc = dt.timezone.utc
    day, next_day = dt.datetime(1995, 6, 15, tzinfo=utc), dt.datetime(1995, 6, 16, tzinfo=utc)
    spark.conf.set("parquet.block.size", "4096")  # small row groups, as a big table has many
    try:
        plain = SnapshotTable(spark, workdir + "/plain")
        clustered = SnapshotTable(spark, workdir + "/clustered", cluster_by=["start_time"])
        for t in (plain, clustered):
            t.replace(sessions_raw(spark, SF_SMALL).repartition(4))
    finally:
        spark.conf.unset("parquet.block.size")
    hit_c, total_c = _row_groups_overlapping(f"{clustered.root}/v=1-*", "start_time", day, next_day)
    hit_p, total_p = _row_groups_overlapping(f"{plain.root}/v=1-*", "start_time", day, next_day)
    assert total_c >= 8 and total_p >= 8
    # a day's filter must read at most one row group per file when clustered
    assert hit_c <= 4 < hit_p
    assert sorted(clustered.read().collect()) == sorted(plain.read().collect())
