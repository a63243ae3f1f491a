"""Source schemas (documents as they arrive) and target contracts (as stored).

Timestamps in source documents are ISO-8601 text with an offset; the raw
layer stores UTC instants. Field names are fixed by the source collections
and target tables and must stay as written here.
"""

from __future__ import annotations

from pyspark.sql import types as T

from weir.operators.contract import Col, Contract

S = T.StringType()

# ---- document collections (JSON lines) -------------------------------------

WATCH_SESSIONS = T.StructType(
    [
        T.StructField("session_id", S),
        T.StructField("user_id", S),
        T.StructField("start_time", S),
        T.StructField("end_time", S),
        T.StructField("pages_visited", T.ArrayType(S)),
        T.StructField(
            "device",
            T.StructType([T.StructField("type", S), T.StructField("os", S), T.StructField("app", S)]),
        ),
        T.StructField("actions", T.ArrayType(S)),
    ]
)

PLAYBACK_EVENTS = T.StructType(
    [
        T.StructField("event_id", S),
        T.StructField("timestamp", S),
        T.StructField("event_type", S),
        T.StructField(
            "details",
            T.StructType(
                [
                    T.StructField("video_id", S),
                    T.StructField("position_seconds", T.IntegerType()),
                    T.StructField("quality", S),
                ]
            ),
        ),
    ]
)

MESSAGE = T.StructType(
    [T.StructField("sender", S), T.StructField("message", S), T.StructField("timestamp", S)]
)

SUPPORT_CASES = T.StructType(
    [
        T.StructField("ticket_id", S),
        T.StructField("user_id", S),
        T.StructField("status", S),
        T.StructField("issue_type", S),
        T.StructField("messages", T.ArrayType(MESSAGE)),
        T.StructField("created_at", S),
        T.StructField("updated_at", S),
    ]
)

CONTENT_RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user_id", S),
        T.StructField("recommended_products", T.ArrayType(S)),
        T.StructField("recommended_content", T.ArrayType(S)),
        T.StructField("last_updated", S),
    ]
)

ABUSE_REPORTS = T.StructType(
    [
        T.StructField("review_id", S),
        T.StructField("user_id", S),
        T.StructField("product_id", S),
        T.StructField("object_id", S),
        T.StructField("review_text", S),
        T.StructField("rating", T.IntegerType()),
        T.StructField("moderation_status", S),
        T.StructField("flags", T.ArrayType(S)),
        T.StructField("submitted_at", S),
    ]
)

COLLECTIONS = {
    "WatchSessions": WATCH_SESSIONS,
    "PlaybackEvents": PLAYBACK_EVENTS,
    "SupportCases": SUPPORT_CASES,
    "ContentRecommendations": CONTENT_RECOMMENDATIONS,
    "AbuseReports": ABUSE_REPORTS,
}

# ---- documents held in table columns ---------------------------------------

PETS_DOC = T.StructType(
    [
        T.StructField(
            "pets",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", S),
                        T.StructField("species", S),
                        T.StructField("favFoods", T.ArrayType(S)),
                        # a JSON number read as text, as ->> does
                        T.StructField("birthYear", S),
                        T.StructField("photo", S),
                    ]
                )
            ),
        )
    ]
)

_TEXT_WITH_UNITS = T.StructType([T.StructField("_VALUE", S), T.StructField("_units", S)])

FOODS_DOC = T.StructType(
    [
        T.StructField(
            "food",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", S),
                        T.StructField("mfr", S),
                        T.StructField("serving", _TEXT_WITH_UNITS),
                        T.StructField(
                            "calories", T.StructType([T.StructField("_total", S), T.StructField("_fat", S)])
                        ),
                        T.StructField("total-fat", S),
                        T.StructField("saturated-fat", S),
                        T.StructField("cholesterol", S),
                        T.StructField("sodium", S),
                        T.StructField("carb", S),
                        T.StructField("fiber", S),
                        T.StructField("protein", S),
                        T.StructField("vitamins", T.StructType([T.StructField("a", S), T.StructField("c", S)])),
                        T.StructField("minerals", T.StructType([T.StructField("ca", S), T.StructField("fe", S)])),
                    ]
                )
            ),
        )
    ]
)



def keep_whole(schema: T.StructType, *names: str) -> T.StructType:
    """``schema`` with the nested fields ``names`` read as VARIANT: whole, with
    whatever fields a document has there (JSN-4)."""
    return T.StructType([T.StructField(f.name, T.VariantType()) if f.name in names else f for f in schema.fields])


# ---- target contracts --------------------------------------------------------

TS = "timestamp"

WATCH_SESSIONS_RAW = Contract(
    "watch_sessions_raw",
    (
        Col("session_id", "string", False),
        Col("user_id", "string", False),
        Col("start_time", TS, False),
        Col("end_time", TS, False),
        Col("session_duration_seconds", "int", False),
        Col("subscription_type", "string"),
        Col("pages_visited", "array<string>"),
        Col("device", "struct<type:string,os:string,app:string>"),
        Col("actions", "array<string>"),
    ),
    ("session_id",),
)

PLAYBACK_EVENTS_RAW = Contract(
    "playback_events_raw",
    (
        Col("event_id", "string", False),
        Col("timestamp", TS, False),
        Col("event_type", "string", False),
        Col("details", "struct<video_id:string,position_seconds:int,quality:string>"),
    ),
    ("event_id",),
)

SUPPORT_CASES_RAW = Contract(
    "support_cases_raw",
    (
        Col("ticket_id", "string", False),
        Col("user_id", "string", False),
        Col("status", "string", False),
        Col("issue_type", "string", False),
        Col("messages", "array<struct<sender:string,message:string,timestamp:string>>"),
        Col("created_at", TS, False),
        Col("updated_at", TS, False),
        Col("resolution_time_seconds", "int"),
        Col("messages_count", "int"),
    ),
    ("ticket_id",),
)

CONTENT_RECOMMENDATIONS_RAW = Contract(
    "content_recommendations_raw",
    (
        Col("user_id", "string", False),
        Col("recommended_content", "array<string>"),
        Col("last_updated", TS, False),
    ),
    ("user_id",),
)

ABUSE_REPORTS_RAW = Contract(
    "abuse_reports_raw",
    (
        Col("review_id", "string", False),
        Col("user_id", "string", False),
        Col("object_id", "string", False),
        Col("review_text", "string"),
        Col("rating", "int"),
        Col("moderation_status", "string"),
        Col("flags", "array<string>"),
        Col("submitted_at", TS, False),
    ),
    ("review_id",),
)

WATCH_ACTIVITY_DAILY = Contract(
    "watch_activity_daily",
    (
        Col("activity_date", "date", False),
        Col("user_id", "string", False),
        Col("sessions_count", "int", False),
        Col("total_watch_time_minutes", "decimal(12,2)"),
        Col("videos_count", "int"),
        Col("premium_ratio", "decimal(5,2)"),
    ),
    ("activity_date", "user_id"),
)

SUPPORT_AND_ABUSE_DAILY = Contract(
    "support_and_abuse_daily",
    (
        Col("snapshot_date", "date", False),
        Col("user_id", "string", False),
        Col("support_cases_count", "int", False),
        Col("abuse_reports_count", "int", False),
        Col("last_support_update", TS),
        Col("last_abuse_report", TS),
    ),
    ("snapshot_date", "user_id"),
)

TEMPERATURE_DAILY_STATS = Contract(
    "temperature_daily_stats",
    (
        Col("day", "date", False),
        Col("avg_temp", "double"),
        Col("min_temp", "double"),
        Col("max_temp", "double"),
    ),
    ("day",),
)

TEMPERATURE_FULL = Contract(
    "temperature_full",
    (
        Col("noted_date", TS),
        Col("temperature", "double"),
        Col("location", "string"),
        Col("device_id", "string"),
    ),
)

TEMPERATURE_INCREMENTAL = Contract(
    "temperature_incremental",
    (
        Col("noted_date", TS),
        Col("temperature", "double"),
        Col("location", "string", True, 10),
        Col("device_id", "string", True, 50),
        Col("batch_id", "string", True, 50),
    ),
    ("noted_date", "device_id"),
)

FLAT_PETS = Contract(
    "flat_pets",
    (
        Col("name", "string"),
        Col("species", "string"),
        Col("fav_foods", "string"),
        Col("birth_year", "int"),
        Col("photo", "string"),
    ),
)

FLAT_FOODS = Contract(
    "flat_foods",
    tuple(
        Col(n, "int" if n.startswith("calories_") else "string")
        for n in (
            "food_name", "manufacturer", "serving_size", "calories_total", "calories_fat",
            "total_fat", "saturated_fat", "cholesterol", "sodium", "carb", "fiber", "protein",
            "vitamin_a", "vitamin_c", "calcium", "iron",
        )
    ),
)
