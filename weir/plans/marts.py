"""Daily marts over the raw layer (PIP-12, PIP-13).

``ds=None`` computes every day at once (a backfill); a date computes that
one day, which is what a daily run replaces with ``replace_date``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir import schemas
from weir.functions.docs import TIER_PREMIUM
from weir.functions.temporal import as_date, on_day, up_to_day
from weir.operators.contract import conform
from weir.operators.dedup import distinct_values
from weir.operators.setops import union_distinct
from weir.operators.unnest import unnest_outer
from weir.sinks.dated import DatedTable


def _minutes(seconds_sum):
    return (seconds_sum.cast("decimal(12,2)") / F.lit(60)).cast("decimal(12,2)")


def _premium_share():
    flag = F.when(F.col("subscription_type") == TIER_PREMIUM, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.avg(flag).cast("decimal(5,2)")


def _distinct_videos(approx_rsd: float | None):
    """Exact ``COUNT(DISTINCT video_id)``, or, only when asked for with a
    relative standard deviation, ``approx_count_distinct`` (AGG-5): fixed
    memory per group instead of the distinct values."""
    if approx_rsd is None:
        return F.count_distinct("video_id")
    return F.approx_count_distinct("video_id", approx_rsd)


def watch_activity_daily(sessions: DataFrame, ds: str | dt.date | None = None, approx_rsd: float | None = None) -> DataFrame:
    """Per day and user, as the reference computes it (Q1): pages are
    unnested *before* aggregating, so ``sessions_count`` counts session×page
    rows and the watch time is summed once per page row. ``videos_count`` is
    the number of distinct ``pages_visited`` entries (Q2)."""
    s = sessions.select("start_time", "user_id", "session_duration_seconds", "subscription_type", "pages_visited")
    if ds is not None:
        s = s.filter(on_day("start_time", ds))
    rows = unnest_outer(s, "pages_visited", "video_id")
    return rows.groupBy(F.to_date("start_time").alias("activity_date"), "user_id").agg(
        F.count(F.lit(1)).cast("int").alias("sessions_count"),
        _minutes(F.sum("session_duration_seconds")).alias("total_watch_time_minutes"),
        _distinct_videos(approx_rsd).cast("int").alias("videos_count"),
        _premium_share().alias("premium_ratio"),
    )


def watch_activity_daily_per_session(
    sessions: DataFrame, ds: str | dt.date | None = None, approx_rsd: float | None = None
) -> DataFrame:
    """Per day and user, as the mart is documented: sessions counted once,
    watch time summed once per session, distinct pages across the day's
    sessions.

    One pass: ``posexplode_outer`` gives each session's first row position
    0 (or NULL for a session without pages); session-level measures are
    taken on that row only, distinct pages on all rows. One scan of the
    sessions and one aggregate on (day, user), no join."""
    s = sessions.select("start_time", "user_id", "session_duration_seconds", "subscription_type", "pages_visited")
    if ds is not None:
        s = s.filter(on_day("start_time", ds))
    rows = s.select(
        F.to_date("start_time").alias("activity_date"),
        "user_id",
        "session_duration_seconds",
        "subscription_type",
        F.posexplode_outer("pages_visited").alias("pos", "video_id"),
    )
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    premium = F.when(F.col("subscription_type") == TIER_PREMIUM, F.lit(1.0)).otherwise(F.lit(0.0))
    return rows.groupBy("activity_date", "user_id").agg(
        F.count_if(first).cast("int").alias("sessions_count"),
        _minutes(F.sum(F.when(first, F.col("session_duration_seconds")))).alias("total_watch_time_minutes"),
        _distinct_videos(approx_rsd).cast("int").alias("videos_count"),
        F.avg(F.when(first, premium)).cast("decimal(5,2)").alias("premium_ratio"),
    )


def refresh_watch_activity(sessions: DatedTable, mart: DatedTable, days: Sequence[dt.date]) -> None:
    """Recompute the daily mart of ``days`` from the stored sessions and put
    them in place together (PIP-12, SNK-4). With the days that a load of the
    sessions changed (``DatedTable.upsert``), a session that comes late, moves
    to another day or changes its values corrects the days it belongs to and
    belonged to; other days are neither read nor written."""
    if days:
        contract = schemas.WATCH_ACTIVITY_DAILY
        stored = sessions.read(days)
        rows = {r[0]: r[1] for r in stored.groupBy(sessions.date_col).count().collect()}  # at most one a day
        mart.replace_days(conform(watch_activity_daily(stored), contract), days, contract, rows)


def known_users(cases: DataFrame, reports: DataFrame) -> DataFrame:
    """Users seen in either table at any time (SET-1, DED-4)."""
    return union_distinct(distinct_values(cases, "user_id"), distinct_values(reports, "user_id"))


def support_and_abuse_daily(cases: DataFrame, reports: DataFrame, ds: str | dt.date) -> DataFrame:
    """Snapshot as of ``ds``: for every user ever seen, cases created and
    reports submitted up to that day, with the latest update / report time.
    Users without any appear with 0, 0, NULL, NULL (Q10). The latest case
    update may lie after ``ds`` (Q11).

    One scan and one map-side-combined aggregate per table: every user gets
    a row with conditional counts, and the full outer join of the two
    aggregates on ``user_id`` yields exactly the union of users (SET-1),
    with both sides already hash-partitioned on the key.
    """
    day = as_date(ds)
    c_in = up_to_day("created_at", day)
    r_in = up_to_day("submitted_at", day)
    sc = cases.groupBy("user_id").agg(
        F.count_if(c_in).alias("sc_cnt"),
        F.max(F.when(c_in, F.col("updated_at"))).alias("last_support_update"),
    )
    ar = reports.groupBy("user_id").agg(
        F.count_if(r_in).alias("ar_cnt"),
        F.max(F.when(r_in, F.col("submitted_at"))).alias("last_abuse_report"),
    )
    return sc.join(ar, "user_id", "full_outer").select(
        F.lit(day).alias("snapshot_date"),
        "user_id",
        F.coalesce("sc_cnt", F.lit(0)).cast("int").alias("support_cases_count"),
        F.coalesce("ar_cnt", F.lit(0)).cast("int").alias("abuse_reports_count"),
        "last_support_update",
        "last_abuse_report",
    )
