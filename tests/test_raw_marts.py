"""Raw layer and marts on hand-made documents (edge rows)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from weir import schemas
from weir.functions.docs import subscription_tier
from weir.operators.contract import violations
from weir.plans import marts, raw
from weir.sources.files import read_collection

SESSIONS = [
    {"_id": "x1", "session_id": "s1", "user_id": "user_6", "start_time": "2024-01-03T10:00:00+03:00",
     "end_time": "2024-01-03T10:30:00+03:00", "pages_visited": ["/home", "/feed", "/home"],
     "device": {"type": "tv", "os": "Tizen", "app": "SmartTV"}, "actions": ["play"]},
    {"_id": "x2", "session_id": "s1", "user_id": "user_4", "start_time": "2024-01-03T12:00:00+00:00",
     "end_time": "2024-01-03T12:10:00+00:00", "pages_visited": ["/x"]},  # duplicate key: dropped
    {"_id": "x3", "session_id": "s2", "user_id": "user_6", "start_time": "2024-01-03T11:00:00+00:00",
     "end_time": "2024-01-03T11:05:00.500000+00:00", "pages_visited": []},
    {"_id": "x4", "session_id": "s3", "user_id": "abc", "start_time": "2024-01-03T11:00:00Z",
     "end_time": "2024-01-03T12:00:00Z"},  # no pages
    {"_id": "x5", "session_id": "s4", "user_id": "user_5", "start_time": "2024-01-04T00:30:00+03:00",
     "end_time": "2024-01-04T01:30:00+03:00", "pages_visited": "not a list"},
]


def _write_lines(spark, path, docs):
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").coalesce(1).write.text(path)


def test_sessions_raw_and_marts(spark, workdir):
    _write_lines(spark, workdir + "/ws", SESSIONS)
    docs = read_collection(spark, workdir + "/ws", schemas.WATCH_SESSIONS)
    got = {r.session_id: r for r in raw.watch_sessions(docs).collect()}
    assert set(got) == {"s1", "s2", "s3", "s4"}
    assert got["s1"].user_id == "user_6"  # first in source order wins
    assert got["s1"].start_time == dt.datetime(2024, 1, 3, 7, 0)  # +03:00 to UTC
    assert got["s1"].session_duration_seconds == 1800
    assert got["s2"].session_duration_seconds == 300  # fraction truncated
    assert got["s1"].subscription_type == "premium"
    assert got["s3"].subscription_type == "free"
    assert got["s4"].pages_visited is None  # wrong shape reads as NULL, rest kept
    assert got["s4"].start_time == dt.datetime(2024, 1, 3, 21, 30)

    sessions = raw.watch_sessions(docs)
    mart = {(r.activity_date, r.user_id): r for r in marts.watch_activity_daily(sessions).collect()}
    m = mart[(dt.date(2024, 1, 3), "user_6")]
    # s1 has 3 page rows, s2 one NULL row: 4 rows, durations summed per row
    assert m.sessions_count == 4
    assert float(m.total_watch_time_minutes) == round((3 * 1800 + 300) / 60, 2)
    assert m.videos_count == 2 and float(m.premium_ratio) == 1.0
    per = {(r.activity_date, r.user_id): r for r in marts.watch_activity_daily_per_session(sessions).collect()}
    p = per[(dt.date(2024, 1, 3), "user_6")]
    assert p.sessions_count == 2 and float(p.total_watch_time_minutes) == round(2100 / 60, 2) and p.videos_count == 2
    assert per[(dt.date(2024, 1, 3), "abc")].videos_count == 0
    one_day = marts.watch_activity_daily(sessions, "2024-01-03").collect()
    assert {r.activity_date for r in one_day} == {dt.date(2024, 1, 3)}


def test_approx_distinct_is_opt_in_and_close(spark):
    from conftest import SF_SMALL
    from weir.plans.queries import sessions_raw

    sessions = sessions_raw(spark, SF_SMALL)
    for build in (marts.watch_activity_daily, marts.watch_activity_daily_per_session):
        exact = {(r.activity_date, r.user_id): r.videos_count for r in build(sessions).collect()}
        approx = {(r.activity_date, r.user_id): r.videos_count for r in build(sessions, approx_rsd=0.01).collect()}
        assert set(approx) == set(exact)
        total = sum(exact.values())
        assert abs(sum(approx.values()) - total) <= 0.02 * total


def test_tiers(spark):
    df = spark.createDataFrame([("user_6",), ("user_4",), ("user_5",), ("abc",), (None,), ("user_x_9",)], "u string")
    got = [r.t for r in df.select(subscription_tier("u").alias("t")).collect()]
    assert got == ["premium", "standard", "free", "free", "free", "premium"]


CASES = [
    {"ticket_id": "c1", "user_id": "u1", "status": "resolved", "issue_type": "billing",
     "messages": [{"sender": "user", "message": "hi", "timestamp": "2024-01-01T01:00:00+00:00"}],
     "created_at": "2024-01-01T00:00:00+00:00", "updated_at": "2024-01-01T05:00:00+00:00"},
    {"ticket_id": "c2", "user_id": "u1", "status": "open", "issue_type": "other",
     "created_at": "2024-01-02T00:00:00+00:00", "updated_at": "2024-01-09T00:00:00+00:00"},  # no messages
    {"ticket_id": "c3", "user_id": "u2", "status": "closed", "issue_type": "access", "messages": [],
     "created_at": "2024-01-08T00:00:00+00:00", "updated_at": "2024-01-08T02:00:00+00:00"},  # future case only
]
REPORTS = [
    {"review_id": "r1", "user_id": "u3", "product_id": "vid_1", "review_text": "t", "rating": 2,
     "moderation_status": "pending", "flags": [], "submitted_at": "2024-01-02T10:00:00+00:00"},
    {"review_id": "r2", "user_id": "u1", "object_id": "vid_2", "rating": 5, "flags": ["spam_suspected"],
     "submitted_at": "2024-01-03T23:30:00-02:00"},  # 2024-01-04 in UTC
]


def test_cases_reports_and_snapshot(spark, workdir):
    _write_lines(spark, workdir + "/sc", CASES)
    _write_lines(spark, workdir + "/ar", REPORTS)
    cases = raw.support_cases(read_collection(spark, workdir + "/sc", schemas.SUPPORT_CASES))
    reports = raw.abuse_reports(read_collection(spark, workdir + "/ar", schemas.ABUSE_REPORTS))
    c = {r.ticket_id: r for r in cases.collect()}
    assert c["c1"].resolution_time_seconds == 5 * 3600 and c["c1"].messages_count == 1
    assert c["c2"].resolution_time_seconds is None and c["c2"].messages_count == 0
    assert c["c3"].messages_count == 0
    r = {x.review_id: x for x in reports.collect()}
    assert r["r1"].object_id == "vid_1" and r["r2"].object_id == "vid_2"
    snap = {x.user_id: x for x in marts.support_and_abuse_daily(cases, reports, "2024-01-03").collect()}
    assert set(snap) == {"u1", "u2", "u3"}
    assert (snap["u1"].support_cases_count, snap["u1"].abuse_reports_count) == (2, 0)
    assert snap["u1"].last_support_update == dt.datetime(2024, 1, 9)  # may lie after the day
    assert (snap["u2"].support_cases_count, snap["u2"].abuse_reports_count) == (0, 0)
    assert snap["u2"].last_support_update is None and snap["u2"].last_abuse_report is None
    assert snap["u3"].abuse_reports_count == 1
    assert {x.snapshot_date for x in snap.values()} == {dt.date(2024, 1, 3)}
    assert sorted(x.user_id for x in marts.known_users(cases, reports).collect()) == ["u1", "u2", "u3"]


def test_contract_violations(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 1.0, "In", "d1", "b"), (dt.datetime(2024, 1, 1), 2.0, "Outside-long", "d1", "b"),
         (None, 3.0, "In", None, "b")],
        "noted_date timestamp, temperature double, location string, device_id string, batch_id string",
    )
    got = {(r.rule, r.column_name): r.violations for r in violations(df, schemas.TEMPERATURE_INCREMENTAL).collect()}
    assert got[("not_null", "noted_date")] == 1
    assert got[("not_null", "device_id")] == 1
    assert got[("max_length", "location")] == 1
    assert got[("unique", "noted_date,device_id")] == 1
