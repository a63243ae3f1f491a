"""Registered queries: one per operator / pipeline of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables in ``sf_dir`` (shaped by ``weir.sources.shaped``). Loads write below
the shared folder (``spark.checkpoint.dir``) and return the table read back.
Nested values are shown as JSON text so results compare as plain values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schemas
from weir.sinks import audit, rejects
from weir.functions.docs import json_text, json_text_nonempty, number_or_null, subscription_tier, text_or_null
from weir.functions.text import prefix, suffix
from weir.functions.temporal import on_day
from weir.operators.contract import violations
from weir.operators.dedup import keep_first, keep_last
from weir.operators.unnest import unnest, unnest_outer
from weir.plans import documents, marts, raw, temperature
from weir.session import prepare, run_dir
from weir import streaming
from weir.sinks.dated import DatedTable
from weir.sinks.tables import KeyBucketedTable, SnapshotTable, _delete, _list_names, append, read_partitioned, replace_date, replace_dates
from weir.sources import shaped
from weir.sources.files import CORRUPT, SRC, read_collection, read_iot_csv

UTC = dt.timezone.utc

# Fixed run parameters of the registered queries (clock values are literals
# so that results are reproducible).
SNAPSHOT_DS = dt.date(1998, 1, 1)
RERUN_DS = dt.date(1998, 6, 15)
RETRACTED_DS = dt.date(1998, 6, 16)
FULL_BATCH = "full-20240201"
FULL_LOADED_AT = dt.datetime(2024, 2, 1, 2, 0, tzinfo=UTC)
INC_START = dt.datetime(2024, 1, 31, 2, 0, tzinfo=UTC)
INC_BATCH = audit.incremental_batch_id(INC_START)
INC_END = dt.datetime(2024, 1, 31, 2, 5, tzinfo=UTC)
INC_EARLY_BATCH = "inc_20240125_020000"
INC_EARLY_CUT = dt.date(2024, 1, 25)
LOAD_1 = dt.datetime(2024, 2, 1, tzinfo=UTC)
LOAD_2 = dt.datetime(2024, 2, 2, tzinfo=UTC)
APPEND_FIRST_END = dt.date(2024, 1, 16)
APPEND_SECOND_START = dt.date(2024, 1, 15)
UPSERT_TARGET_END = dt.date(2024, 1, 20)
UPSERT_SOURCE_START = dt.date(2024, 1, 10)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _t(spark, d, *names):
    out = shaped.tables(spark, d, *names)
    return out[0] if len(out) == 1 else out


def _lit_ts(value: dt.datetime):
    return F.lit(value).cast("timestamp")


# ---- raw layer -------------------------------------------------------------


def sessions_raw(spark, d) -> DataFrame:
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    return raw.watch_sessions(shaped.watch_session_docs(orders, lineitem))


def cases_raw(spark, d) -> DataFrame:
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    return raw.support_cases(shaped.support_case_docs(orders, lineitem))


def reports_raw(spark, d) -> DataFrame:
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    return raw.abuse_reports(shaped.abuse_report_docs(orders, lineitem))


@query
def raw_watch_sessions(spark, d):
    """PIP-7: sessions collection -> raw layer."""
    return raw.as_json_text(sessions_raw(spark, d))


@query
def raw_playback_events(spark, d):
    """PIP-8: playback events -> raw layer."""
    return raw.as_json_text(raw.playback_events(shaped.playback_event_docs(_t(spark, d, "events"))))


@query
def raw_support_cases(spark, d):
    """PIP-9: support cases -> raw layer (resolution time, message count)."""
    return raw.as_json_text(cases_raw(spark, d))


@query
def raw_recommendations(spark, d):
    """PIP-10: recommendations -> raw layer (field rename, first per user)."""
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    return raw.as_json_text(raw.recommendations(shaped.recommendation_docs(orders, lineitem)))


@query
def raw_reports(spark, d):
    """PIP-11: abuse reports -> raw layer (rename, first per review id)."""
    return raw.as_json_text(reports_raw(spark, d))


@query
def subscription_tier_q(spark, d):
    """CON-1, STR-3, MAT-1: tier from the numeric suffix of a user name."""
    c = _t(spark, d, "customer")
    return c.select("c_custkey", F.col("c_name").alias("user_id"), subscription_tier("c_name", "#").alias("subscription_type"))


@query
def str_suffix_prefix(spark, d):
    """STR-1, STR-2: last / first n characters."""
    c = _t(spark, d, "customer")
    return c.select(
        "c_custkey",
        suffix("c_name", 10).alias("suffix_10"),
        suffix("c_name", 15).alias("suffix_15"),
        prefix("c_name", 10).alias("prefix_10"),
    )


@query
def dedup_first(spark, d):
    """DED-1: first row per (l_orderkey, l_linenumber) by the other columns."""
    li = _t(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return keep_first(li, keys, [c for c in li.columns if c not in keys])


@query
def explode_inner(spark, d):
    """JOI-2 / ARR-3: one row per visited page; sessions without pages vanish."""
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    docs = shaped.watch_session_docs(orders, lineitem)
    return unnest(docs, "pages_visited", "video_id", keep=["session_id"])


@query
def explode_outer(spark, d):
    """JOI-3: sessions without pages keep one row with a NULL page."""
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    docs = shaped.watch_session_docs(orders, lineitem)
    return unnest_outer(docs, "pages_visited", "video_id", keep=["session_id"])


@query
def to_json_arrays(spark, d):
    """JSN-3: arrays and structs to JSON text, NULL kept, empty-as-NULL variant."""
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    docs = shaped.watch_session_docs(orders, lineitem)
    return docs.select(
        "session_id",
        json_text("pages_visited").alias("pages_json"),
        json_text_nonempty("pages_visited").alias("pages_json_nonempty"),
        json_text("device").alias("device_json"),
        json_text("actions").alias("actions_json"),
    )


@query
def src_json_docs(spark, d):
    """SRC-2: a collection exported as JSON lines, read back with its schema
    (``_id`` dropped)."""
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    docs = shaped.watch_session_docs(orders, lineitem)
    path = run_dir(spark, "collections") + "/WatchSessions"
    docs.withColumn("_id", F.concat(F.lit("oid"), F.col(f"{SRC}.row").cast("string"))).drop(SRC).write.json(path)
    back = read_collection(spark, path, schemas.WATCH_SESSIONS)
    return raw.as_json_text(back.drop(SRC, CORRUPT))


# ---- marts ---------------------------------------------------------------------


@query
def watch_activity_daily(spark, d):
    """PIP-12 as the reference computes it, every day (backfill)."""
    return marts.watch_activity_daily(sessions_raw(spark, d))


@query
def watch_activity_daily_per_session(spark, d):
    """PIP-12 as documented: sessions counted once."""
    return marts.watch_activity_daily_per_session(sessions_raw(spark, d))


@query
def support_and_abuse_daily(spark, d):
    """PIP-13: per-user snapshot as of a day."""
    return marts.support_and_abuse_daily(cases_raw(spark, d), reports_raw(spark, d), SNAPSHOT_DS)


@query
def user_union(spark, d):
    """SET-1 / DED-4: users of either raw table."""
    return marts.known_users(cases_raw(spark, d), reports_raw(spark, d))


# ---- documents -----------------------------------------------------------------


@query
def flat_pets(spark, d):
    """PIP-1: JSON documents in a column -> one row per pet."""
    return documents.flat_pets(shaped.pets_json_rows(_t(spark, d, "conversations")))


@query
def flat_foods(spark, d):
    """PIP-2: XML documents in a column -> one row per food."""
    return documents.flat_foods(shaped.foods_xml_rows(_t(spark, d, "part")))


# ---- temperature ------------------------------------------------------------------


def iot(spark, d, missing_ids: bool = False) -> DataFrame:
    return shaped.iot_readings(_t(spark, d, "events"), missing_ids)


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query
def temp_percentiles(spark, d):
    """AGG-2: exact 5th / 95th percentile of indoor temperatures."""
    return _r6(temperature.temp_percentiles(iot(spark, d)), "p_low", "p_high")


@query
def temp_trimmed(spark, d):
    """FIL-3 / JOI-4: indoor readings inside the percentile band."""
    return temperature.temp_trimmed(iot(spark, d))


@query
def temp_daily_stats(spark, d):
    """AGG-1: daily mean / min / max of the trimmed readings."""
    return _r6(temperature.temp_daily_stats(iot(spark, d)), "avg_temp")


@query
def temp_hottest(spark, d):
    """TOP-1: five hottest days."""
    return _r6(temperature.hottest_days(temperature.temp_daily_stats(iot(spark, d))), "avg_temp")


@query
def temp_coldest(spark, d):
    """TOP-2: five coldest days."""
    return _r6(temperature.coldest_days(temperature.temp_daily_stats(iot(spark, d))), "avg_temp")


@query
def temp_extremes(spark, d):
    """PIP-3: hottest and coldest days, each day once."""
    return _r6(temperature.temperature_extremes(iot(spark, d)), "avg_temp")


@query
def temp_extremes_upsert(spark, d):
    """PIP-3 load: extremes of an earlier run (readings before the cut), then
    of today's run, upserted by day; days that stop being extreme stay (Q13)."""
    readings = iot(spark, d)
    earlier = readings.filter(F.to_timestamp("noted_date", "dd-MM-yyyy HH:mm") < F.lit(APPEND_FIRST_END))
    table = SnapshotTable(spark, run_dir(spark, "extremes") + "/temperature_daily_stats")
    temperature.load_extremes(table, temperature.temperature_extremes(earlier))
    temperature.load_extremes(table, temperature.temperature_extremes(readings))
    return _r6(table.read(), "avg_temp")


def _csv_round_trip(spark, d, name: str) -> DataFrame:
    path = run_dir(spark, name) + "/iot.csv"
    iot(spark, d).drop(SRC).write.option("header", True).csv(path)
    return read_iot_csv(spark, path)


@query
def src_csv_scan(spark, d):
    """SRC-1: CSV export read by header name, every column text."""
    return _csv_round_trip(spark, d, "csv_scan").drop(SRC)


@query
def temp_full_clean(spark, d):
    """PIP-4 rows: names normalised, lenient parse, 10-char device ids."""
    return temperature.full_clean(_csv_round_trip(spark, d, "full_clean"))


@query
def incremental_window(spark, d):
    """FIL-4: readings within 7 days of the newest one."""
    return temperature.incremental_window(iot(spark, d)).select("noted_date", "id", "temp", "out_in")


@query
def dedup_last(spark, d):
    """DED-2: last reading per (noted_date, device_id) in source order."""
    rows = temperature.incremental_rows(temperature.incremental_window(iot(spark, d)), INC_BATCH)
    last = keep_last(rows, ["noted_date", "device_id"], [SRC])
    return last.select("noted_date", "device_id", "temperature", F.col(f"{SRC}.row").alias("seq"))


@query
def temp_incremental(spark, d):
    """PIP-5 batch: window, device ids, de-duplicated."""
    return temperature.incremental_batch(iot(spark, d), INC_BATCH)


@query
def incremental_fallback_key(spark, d):
    """STR-5: readings without a device id get a stable ``row_<n>`` key."""
    return temperature.incremental_batch(iot(spark, d, missing_ids=True), INC_BATCH)


@query
def temp_incremental_summary(spark, d):
    """PIP-6: count, period, mean / min / max of the loaded table."""
    return temperature.incremental_summary(temperature.incremental_batch(iot(spark, d), INC_BATCH))


@query
def normalise_nulls(spark, d):
    """PRJ-6: text spellings of missing values and NaN become NULL."""
    r = iot(spark, d)
    return r.select(
        F.col(f"{SRC}.row").alias("seq"),
        number_or_null("temp").alias("temperature"),
        text_or_null("out/in").alias("location"),
        text_or_null("id").alias("device"),
    )


@query
def contract_violations(spark, d):
    """SNK-7: contract checks on an un-deduplicated batch and on raw sessions."""
    rows = temperature.incremental_rows(temperature.incremental_window(iot(spark, d)), INC_BATCH).drop(SRC)
    a = violations(rows, schemas.TEMPERATURE_INCREMENTAL)
    b = violations(sessions_raw(spark, d), schemas.WATCH_SESSIONS_RAW)
    return a.unionByName(b)


# ---- loads ----------------------------------------------------------------------------


def _event_rows(spark, d) -> DataFrame:
    return _t(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query
def load_append(spark, d):
    """SNK-1: two appends with overlapping days; the overlap appears twice."""
    ev = _event_rows(spark, d)
    path = run_dir(spark, "append") + "/events"
    append(ev.filter(F.col("ts") < F.lit(APPEND_FIRST_END)), path)
    append(ev.filter(F.col("ts") >= F.lit(APPEND_SECOND_START)), path)
    return spark.read.parquet(path)


@query
def load_full_replace(spark, d):
    """SNK-2: a second full load replaces the first as a whole."""
    ev = _event_rows(spark, d)
    table = SnapshotTable(spark, run_dir(spark, "replace") + "/events")
    table.replace(ev.filter(F.col("ts") < F.lit(APPEND_FIRST_END)))
    table.replace(ev)
    return table.read()


@query
def load_upsert(spark, d):
    """SNK-3 / SNK-8: keyed upsert with created_at kept and updated_at refreshed."""
    ev = _event_rows(spark, d)
    table = SnapshotTable(spark, run_dir(spark, "upsert") + "/events")
    ins, stamps = raw.ingest_stamps(_lit_ts(LOAD_1))
    table.upsert(ev.filter(F.col("ts") < F.lit(UPSERT_TARGET_END)), ["event_id"], insert_only=ins, stamps=stamps)
    changed = ev.filter(F.col("ts") >= F.lit(UPSERT_SOURCE_START)).withColumn("value", F.col("value") + 1)
    ins, stamps = raw.ingest_stamps(_lit_ts(LOAD_2))
    table.upsert(changed, ["event_id"], insert_only=ins, stamps=stamps)
    return table.read()


# buckets of the key-bucketed upsert target in the registered query
UPSERT_BUCKETS = 16


@query
def load_upsert_bucketed(spark, d):
    """SNK-3 / SNK-8 at scale: the same two loads as ``load_upsert`` into a
    key-bucketed table; the second load reads and rewrites only the buckets
    its keys fall in."""
    ev = _event_rows(spark, d)
    table = KeyBucketedTable(spark, run_dir(spark, "upsert_bucketed") + "/events", ["event_id"], UPSERT_BUCKETS)
    ins, stamps = raw.ingest_stamps(_lit_ts(LOAD_1))
    table.upsert(ev.filter(F.col("ts") < F.lit(UPSERT_TARGET_END)), insert_only=ins, stamps=stamps)
    changed = ev.filter(F.col("ts") >= F.lit(UPSERT_SOURCE_START)).withColumn("value", F.col("value") + 1)
    ins, stamps = raw.ingest_stamps(_lit_ts(LOAD_2))
    table.upsert(changed, insert_only=ins, stamps=stamps)
    return table.read()


@query
def load_upsert_composite(spark, d):
    """SNK-3 on (noted_date, device_id): an earlier incremental run, then today's."""
    readings = iot(spark, d)
    early = readings.filter(F.to_timestamp("noted_date", "dd-MM-yyyy HH:mm") < F.lit(INC_EARLY_CUT))
    table = SnapshotTable(spark, run_dir(spark, "incremental") + "/temperature_incremental")
    temperature.load_incremental(table, temperature.incremental_batch(early, INC_EARLY_BATCH), LOAD_1)
    temperature.load_incremental(table, temperature.incremental_batch(readings, INC_BATCH), LOAD_2)
    return table.read()


@query
def load_partition_replace(spark, d):
    """SNK-4: backfill every day, rerun one day (idempotent), rerun a day whose
    sessions were retracted (the day is cleared). The marts read the stored
    raw layer (SRC-5), so a day's rerun prunes to that day in the scan."""
    root = run_dir(spark, "warehouse")
    stored = SnapshotTable(spark, f"{root}/raw/watch_sessions_raw", cluster_by=["start_time"])
    stored.replace(sessions_raw(spark, d))
    sessions = stored.read()
    mart = f"{root}/marts/watch_activity_daily"
    replace_dates(marts.watch_activity_daily(sessions), mart, "activity_date", spread_by=["user_id"])
    for _ in range(2):
        replace_date(marts.watch_activity_daily(sessions, RERUN_DS), mart, "activity_date", RERUN_DS, schemas.WATCH_ACTIVITY_DAILY)
    kept = sessions.filter(~on_day("start_time", RETRACTED_DS))
    replace_date(marts.watch_activity_daily(kept, RETRACTED_DS), mart, "activity_date", RETRACTED_DS)
    return read_partitioned(spark, mart, "activity_date")


@query
def audit_full_load(spark, d):
    """SNK-5 / SNK-9 / AGG-10: full load via staging, one audit row."""
    root = run_dir(spark, "full_load")
    temperature.full_load(spark, iot(spark, d), root, FULL_BATCH, FULL_LOADED_AT)
    return spark.read.parquet(f"{root}/load_history")


@query
def audit_run_state(spark, d):
    """SNK-6 / AGG-11: started -> success with the count of keys loaded."""
    root = run_dir(spark, "incremental_audit")
    table = SnapshotTable(spark, f"{root}/temperature_incremental")
    clock = iter([INC_START, INC_END])
    log = f"{root}/load_history_incremental"
    with audit.audited_run(spark, log, "incremental", INC_BATCH, clock=lambda: next(clock)) as run:
        batch, obs = audit.counted(temperature.incremental_batch(iot(spark, d), INC_BATCH), "batch_rows")
        temperature.load_incremental(table, batch, INC_START)
        run["records"] = obs.get["rows"]
    return audit.run_state(spark.read.parquet(log))


#: Keys of the first of two overlapping loads end in one of these digits.
FIRST_LOAD = ("0", "1", "2", "3", "4")


#: Exports are compressed: as plain text they are several times the tables
#: they come from. A file is one task's rows, and is read by one task.
EXPORT = {"compression": "gzip"}


def _load_raw(spark, docs, schema, build, contract) -> DataFrame:
    """Two loads of a collection export: a part of the documents, then all of
    them; stamps tell which load brought a key first. ``docs`` have the rows of
    a key in one partition and in source order, so that the first of them wins;
    the order among keys is free."""
    root = run_dir(spark, f"load_{contract.table}")
    (key,) = contract.key
    table = SnapshotTable(spark, f"{root}/raw")
    part = F.substring(key, -1, 1).isin(*FIRST_LOAD)
    for n, (some, at) in enumerate(((docs.where(part), LOAD_1), (docs, LOAD_2))):  # the second load updates the first's keys
        some.drop(SRC).write.options(**EXPORT).json(f"{root}/export-{n}")
        raw.load_collection(spark, read_collection(spark, f"{root}/export-{n}", schema), build, contract, table, at, f"{root}/rejects")
    return raw.as_json_text(table.read())


def _by_key(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the rows of a key in one partition and in source order."""
    return docs.repartition(key).sortWithinPartitions(SRC)


@query
def load_raw_sessions(spark, d):
    """PIP-7 load: sessions export -> raw by keyed upsert, twice."""
    docs = shaped.watch_session_docs(*_t(spark, d, "orders", "lineitem"))
    return _load_raw(spark, docs, schemas.WATCH_SESSIONS, raw.watch_sessions, schemas.WATCH_SESSIONS_RAW)


@query
def load_raw_events(spark, d):
    """PIP-8 load."""
    docs = shaped.playback_event_docs(_t(spark, d, "events"))
    return _load_raw(spark, docs, schemas.PLAYBACK_EVENTS, raw.playback_events, schemas.PLAYBACK_EVENTS_RAW)


@query
def load_raw_cases(spark, d):
    """PIP-9 load: source times kept, load time in ``loaded_at``."""
    docs = shaped.support_case_docs(*_t(spark, d, "orders", "lineitem"))
    return _load_raw(spark, docs, schemas.SUPPORT_CASES, raw.support_cases, schemas.SUPPORT_CASES_RAW)


@query
def load_raw_recommendations(spark, d):
    """PIP-10 load."""
    docs = _by_key(shaped.recommendation_docs(*_t(spark, d, "orders", "lineitem")), "user_id")
    return _load_raw(spark, docs, schemas.CONTENT_RECOMMENDATIONS, raw.recommendations, schemas.CONTENT_RECOMMENDATIONS_RAW)


@query
def load_raw_reports(spark, d):
    """PIP-11 load."""
    docs = shaped.abuse_report_docs(*_t(spark, d, "orders", "lineitem"), in_order=True)
    return _load_raw(spark, docs, schemas.ABUSE_REPORTS, raw.abuse_reports, schemas.ABUSE_REPORTS_RAW)


@query
def load_rejects(spark, d):
    """SRC-2: an export in which event ids that end in 7 are cut lines and
    those that end in 9 have no key; both are counted, none is loaded."""
    docs = shaped.playback_event_docs(_t(spark, d, "events")).drop(SRC)
    root = run_dir(spark, "load_rejects")
    end = F.substring("event_id", -1, 1)
    line = F.to_json(F.struct(F.when(end != "9", F.col("event_id")).alias("event_id"), *[c for c in docs.columns if c != "event_id"]))
    cut = F.when(end == "7", F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    docs.select(end.alias("end"), line.alias("line"), "event_id").select(cut.alias("value")).write.text(f"{root}/export")
    table = SnapshotTable(spark, f"{root}/raw")
    export = read_collection(spark, f"{root}/export", schemas.PLAYBACK_EVENTS)
    raw.load_collection(spark, export, raw.playback_events, schemas.PLAYBACK_EVENTS_RAW, table, LOAD_1, f"{root}/rejects")
    refused = spark.read.parquet(f"{root}/rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    return refused.unionByName(table.read().agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("records")))


@query
def load_raw_unknown_fields(spark, d):
    """JSN-4: playback events whose details have fields that no schema knows,
    kept whole through the raw load and a second one; the text form has the
    fields in alphabetical order."""
    docs = shaped.playback_event_docs(_t(spark, d, "events"))
    contract = schemas.PLAYBACK_EVENTS_RAW.whole("details")
    build = partial(raw.playback_events, contract=contract)
    root = run_dir(spark, "load_unknown")
    digit = F.substring("event_id", -1, 1)
    more = [
        F.when(digit.isin("1", "3"), F.col("event_type")).alias("codec"),
        F.when(digit == "3", F.struct(F.col("details.position_seconds").alias("z"), F.lit(True).alias("a"))).alias("buffer"),
    ]
    table = SnapshotTable(spark, f"{root}/raw")
    for n, (part, at) in enumerate(((docs.where(digit.isin(*FIRST_LOAD)), LOAD_1), (docs, LOAD_2))):
        line = part.select("event_id", "timestamp", "event_type", F.struct("details.*", *more).alias("details"))
        line.write.json(f"{root}/export-{n}")
        export = read_collection(spark, f"{root}/export-{n}", schemas.keep_whole(schemas.PLAYBACK_EVENTS, "details"))
        raw.load_collection(spark, export, build, contract, table, at, f"{root}/rejects")
    return raw.as_json_text(table.read()).select("event_id", "details", "created_at")


@query
def load_support_abuse_daily(spark, d):
    """PIP-13 load (SNK-4): the snapshot of a day replaced per date, twice."""
    cases, reports = cases_raw(spark, d), reports_raw(spark, d)
    mart = run_dir(spark, "support_abuse") + "/support_and_abuse_daily"
    for _ in range(2):
        rows = marts.support_and_abuse_daily(cases, reports, SNAPSHOT_DS)
        replace_date(rows, mart, rows.columns[0], SNAPSHOT_DS, schemas.SUPPORT_AND_ABUSE_DAILY)
    return read_partitioned(spark, mart, rows.columns[0])


def _pets_rejects(spark, d, root: str) -> dict[str, int]:
    docs = shaped.pets_json_rows(_t(spark, d, "conversations"), cut=True)
    return documents.load_pets(docs, f"{root}/pets", f"{root}/rejects/pets", FULL_BATCH)


def _foods_rejects(spark, d, root: str) -> dict[str, int]:
    docs = shaped.foods_xml_rows(_t(spark, d, "part"), nested=True, cut=True)
    return documents.load_foods(docs, f"{root}/foods", f"{root}/rejects/foods", FULL_BATCH)


@query
def load_flat_pets(spark, d):
    """PIP-1 / SNK-1 load: pets appended, cut documents put aside."""
    root = run_dir(spark, "load_flat_pets")
    _pets_rejects(spark, d, root)
    return spark.read.parquet(f"{root}/pets")


@query
def load_flat_foods(spark, d):
    """PIP-2 / SNK-1 load (XML-1): foods at any depth appended, cut documents
    put aside."""
    root = run_dir(spark, "load_flat_foods")
    _foods_rejects(spark, d, root)
    return spark.read.parquet(f"{root}/foods")


@query
def load_rejects_counted(spark, d):
    """SRC-3, SRC-4, DAT-2, FIL-2: cut JSON, cut XML and days that do not exist,
    each counted and stored as rejects; every load runs twice, which leaves
    its rejects as they are."""
    root = run_dir(spark, "load_rejects_counted")
    readings = shaped.iot_readings(_t(spark, d, "events"), bad_dates=True)
    out = []
    for _ in range(2):
        pets, foods = _pets_rejects(spark, d, root), _foods_rejects(spark, d, root)
        full = temperature.full_load(spark, readings, f"{root}/full", FULL_BATCH, FULL_LOADED_AT)
        run = temperature.incremental_load(spark, readings, f"{root}/inc", INC_START, clock=lambda: INC_END)
        out = [("pets", pets["loaded"]), ("foods", foods["loaded"]), ("full", full), ("incremental", run["loaded"])]
    paths = {"pets": "rejects/pets", "foods": "rejects/foods", "full": "full/rejects", "incremental": "inc/rejects"}
    counted = spark.createDataFrame([(s, "loaded", n) for s, n in out], "source string, reason string, records long")
    for source, path in paths.items():
        refused = rejects.read(spark, f"{root}/{path}").where("record is not null")
        counted = counted.unionByName(
            refused.groupBy(F.lit(source).alias("source"), "reason").agg(F.count(F.lit(1)).alias("records"))
        )
    return counted


#: Orders from this day on come late or a day off in the first export.
LATE_FROM = dt.date(1998, 6, 1)


def _late_sessions(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two exports of the sessions: of the orders since ``LATE_FROM``, the first
    lacks those whose key ends in 3 and has those ending in 5 a day late; the
    second has these two, right."""
    orders, lineitem = _t(spark, d, "orders", "lineitem")
    recent, digit = F.col("o_orderdate") >= F.lit(LATE_FROM), F.pmod("o_orderkey", F.lit(10))
    moved = F.when(recent & (digit == 5), F.col("o_orderdate") + F.make_dt_interval(F.lit(1))).otherwise(F.col("o_orderdate"))
    first = orders.where(~(recent & (digit == 3))).withColumn("o_orderdate", moved.cast(orders.schema["o_orderdate"].dataType))
    second = orders.where(recent & digit.isin(3, 5))
    return shaped.watch_session_docs(first, lineitem), shaped.watch_session_docs(second, lineitem)


@query
def load_dated_events(spark, d):
    """SRC-5 / SNK-3: playback events kept by event date; the second load
    brings events that were missing and moves others to the day before, each
    of which is there once."""
    docs = shaped.playback_event_docs(_t(spark, d, "events"))
    digit = F.substring("event_id", -1, 1)
    at = F.col("timestamp").cast("timestamp")
    late = F.when(digit == "5", shaped.iso_text(at + F.make_dt_interval(F.lit(1)), F.lit(0))).otherwise(F.col("timestamp"))
    table = DatedTable(spark, run_dir(spark, "load_dated") + "/playback_events_raw", ["event_id"], event_time="timestamp")
    contract = schemas.PLAYBACK_EVENTS_RAW
    for part, load in ((docs.where(digit != "3").withColumn("timestamp", late), LOAD_1), (docs.where(digit.isin("3", "5")), LOAD_2)):
        insert_only, stamps = raw.ingest_stamps(_lit_ts(load), contract)
        table.upsert(raw.playback_events(part), insert_only=insert_only, stamps=stamps, contract=contract)
    return raw.as_json_text(table.read())


@query
def refresh_watch_activity(spark, d):
    """PIP-12 / SNK-4: the mart follows the loads of the sessions, recomputing
    the days that each of them changed."""
    root = run_dir(spark, "refresh")
    contract = schemas.WATCH_SESSIONS_RAW
    table = DatedTable(spark, f"{root}/raw/watch_sessions_raw", ["session_id"], event_time="start_time", cluster_by=["user_id"])
    mart = DatedTable(spark, f"{root}/marts/watch_activity_daily", ["activity_date", "user_id"], "activity_date")
    for docs, at in zip(_late_sessions(spark, d), (LOAD_1, LOAD_2)):
        insert_only, stamps = raw.ingest_stamps(_lit_ts(at), contract)
        changes = table.upsert(raw.watch_sessions(docs), insert_only=insert_only, stamps=stamps, contract=contract)
        marts.refresh_watch_activity(table, mart, changes.days)
    return mart.read()


# ---- streaming drivers -----------------------------------------------------------


def _stream_raw(spark, name: str, parts, schema, build, contract, table, replay: bool = False) -> tuple[DataFrame, str]:
    """Exports written and ingested one after the other; with ``replay``, the
    stream forgets its last commit and runs again after each."""
    root = run_dir(spark, name)
    table = table(f"{root}/raw")
    src, ckpt = f"{root}/export", f"{root}/_checkpoint"
    for lines, load_time in zip(parts, (LOAD_1, LOAD_2)):
        lines.write.mode("append").options(**EXPORT).text(src)
        for again in range(2 if replay else 1):
            at = load_time + again * dt.timedelta(days=30)
            stream = streaming.collection_stream(spark, src, schema)
            streaming.ingest_stream(
                stream, build, table, contract.key, ckpt, clock=lambda t=at: t, contract=contract, rejects_path=f"{root}/rejects"
            ).awaitTermination()
            if replay:
                forget_last_commit(spark, ckpt)
    return table.read(), f"{root}/rejects"


def forget_last_commit(spark, checkpoint: str) -> None:
    """Leave a stream as a driver does that is lost after a batch was stored
    and before Spark noted it: the batch is run again."""
    last = max((int(n) for n in _list_names(spark, f"{checkpoint}/commits") if n.isdigit()), default=None)
    if last is not None:
        _delete(spark, f"{checkpoint}/commits/{last}")
        _delete(spark, f"{checkpoint}/commits/.{last}.crc")


def _export_lines(docs: DataFrame, key: str) -> list[DataFrame]:
    """Documents, as ``_load_raw`` has them, as JSON lines in two exports by the
    last digit of their key, with a cut copy of every tenth key's line between
    them."""
    line = F.to_json(F.struct(*[c for c in docs.columns if c != SRC]))
    digit = F.substring(key, -1, 1)
    texts = F.when(digit == "7", F.array(F.left(line, F.length(line) - 2), line)).otherwise(F.array(line))
    both = docs.select(digit.isin(*FIRST_LOAD).alias("early"), F.explode(texts).alias("value"))
    return [both.where("early").select("value"), both.where("not early").select("value")]


def _snapshot(spark):
    return lambda path: SnapshotTable(spark, path)


@query
def stream_ingest_sessions(spark, d):
    """STM-1: the sessions export as a file stream; two runs, the second
    picks up only the files exported since the first, each micro-batch
    upserted into the raw table."""
    docs = shaped.watch_session_docs(*_t(spark, d, "orders", "lineitem"))
    parts = _export_lines(docs, "session_id")
    rows, _ = _stream_raw(spark, "stream_sessions", parts, schemas.WATCH_SESSIONS, raw.watch_sessions, schemas.WATCH_SESSIONS_RAW, _snapshot(spark))
    return raw.as_json_text(rows.drop("created_at", "updated_at"))


@query
def stream_ingest_events(spark, d):
    """STM-1, PIP-8: playback events, into a table kept by event date."""
    docs = shaped.playback_event_docs(_t(spark, d, "events"))
    parts = _export_lines(docs, "event_id")
    table = lambda path: DatedTable(spark, path, ["event_id"], event_time="timestamp")
    rows, _ = _stream_raw(spark, "stream_events", parts, schemas.PLAYBACK_EVENTS, raw.playback_events, schemas.PLAYBACK_EVENTS_RAW, table)
    return raw.as_json_text(rows.drop("event_date", "updated_at"))


@query
def stream_ingest_cases(spark, d):
    """STM-1, PIP-9: support cases."""
    docs = shaped.support_case_docs(*_t(spark, d, "orders", "lineitem"))
    parts = _export_lines(docs, "ticket_id")
    rows, _ = _stream_raw(spark, "stream_cases", parts, schemas.SUPPORT_CASES, raw.support_cases, schemas.SUPPORT_CASES_RAW, _snapshot(spark))
    return raw.as_json_text(rows)


@query
def stream_ingest_recommendations(spark, d):
    """STM-1, PIP-10: recommendations."""
    docs = _by_key(shaped.recommendation_docs(*_t(spark, d, "orders", "lineitem")), "user_id")
    parts = _export_lines(docs, "user_id")
    contract = schemas.CONTENT_RECOMMENDATIONS_RAW
    rows, _ = _stream_raw(spark, "stream_recommendations", parts, schemas.CONTENT_RECOMMENDATIONS, raw.recommendations, contract, _snapshot(spark))
    return raw.as_json_text(rows.drop("updated_at"))


@query
def stream_ingest_reports(spark, d):
    """STM-1, PIP-11: abuse reports."""
    docs = shaped.abuse_report_docs(*_t(spark, d, "orders", "lineitem"), in_order=True)
    parts = _export_lines(docs, "review_id")
    rows, _ = _stream_raw(spark, "stream_reports", parts, schemas.ABUSE_REPORTS, raw.abuse_reports, schemas.ABUSE_REPORTS_RAW, _snapshot(spark))
    return raw.as_json_text(rows.drop("updated_at"))


@query
def stream_ingest_replayed(spark, d):
    """STM-1: cut lines are refused and counted, a key that comes again takes
    the later batch, and a batch that Spark runs again after it was stored
    changes nothing, its stamps included."""
    docs = shaped.playback_event_docs(_t(spark, d, "events"))
    line = F.to_json(F.struct(*[c for c in docs.columns if c != SRC]))
    changed = F.to_json(F.struct("event_id", "timestamp", F.lit("changed").alias("event_type"), "details"))
    digit = F.substring("event_id", -1, 1)
    parts = [
        docs.select(F.when(digit == "7", F.left(line, F.length(line) - 2)).otherwise(line).alias("value")),
        docs.where(digit.isin("1", "7")).select(changed.alias("value")),
    ]
    rows, refused = _stream_raw(
        spark, "stream_replayed", parts, schemas.PLAYBACK_EVENTS, raw.playback_events, schemas.PLAYBACK_EVENTS_RAW, _snapshot(spark), replay=True
    )
    loaded = rows.groupBy("event_type", "created_at", "updated_at").agg(F.count(F.lit(1)).alias("records"))
    cut = rejects.read(spark, refused).groupBy(F.col("reason").alias("event_type")).agg(F.count(F.lit(1)).alias("records"))
    return loaded.unionByName(cut, allowMissingColumns=True)


@query
def stream_last_readings(spark, d):
    """STM-2 / DED-2: the last reading per (hour, device) of a stream, once the
    watermark has passed the hour; the export comes in four files by day, one a
    trigger."""
    root = run_dir(spark, "stream_last")
    src, out = f"{root}/readings", f"{root}/last"
    readings = _t(spark, d, "events").select(
        F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("noted_date"),
        F.concat(F.lit("dev_"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("value").alias("temperature"),
        F.col("event_id").alias("seq"),
    )
    for lo, hi in zip((1, 9, 17, 25), (9, 17, 25, 32)):
        readings.where((F.dayofmonth("noted_date") >= lo) & (F.dayofmonth("noted_date") < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(src)
    last = streaming.last_within(stream, ["noted_date", "device_id"], "noted_date", ["seq"])
    streaming.append_stream(last, out, f"{root}/_checkpoint").awaitTermination()
    return spark.read.parquet(out)


@query
def stream_dedup_readings(spark, d):
    """STM-2: readings as a stream, one row per (hour, device) kept while
    within 7 days of the newest reading (watermark de-duplication)."""
    events_schema = _t(spark, d, "events").schema
    stream = spark.readStream.schema(events_schema).option("pathGlobFilter", "events.parquet").parquet(d)
    readings = stream.select(
        F.date_trunc("hour", F.col("ts")).alias("noted_date"),
        F.concat(F.lit("dev_"), F.col("user_id").cast("string")).alias("device_id"),
    )
    root = run_dir(spark, "stream_dedup")
    out = root + "/readings"
    streaming.append_stream(streaming.first_within(readings, ["noted_date", "device_id"], "noted_date"), out, root + "/_ckpt").awaitTermination()
    return spark.read.parquet(out)


# the inventory names the tier query ``subscription_tier``
QUERIES["subscription_tier"] = QUERIES.pop("subscription_tier_q")
