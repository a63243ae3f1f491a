"""IoT temperature pipelines (PIP-3..PIP-6).

Input is the CSV export as read by ``read_iot_csv``: every column text,
addressed by header name (``id``, ``noted_date``, ``temp``, ``out/in`` and
any others), plus ``_src`` for file order.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schemas
from weir.functions.docs import number_or_null
from weir.functions.temporal import IOT_TS_FORMAT, parse_ts_lenient, parse_ts_strict
from weir.functions.text import normalise_name, prefix, suffix
from weir.operators.bounds import percentiles, trailing_window, within_bounds
from weir.operators.contract import conform
from weir.operators.dedup import keep_last
from weir.operators.ranking import bottom_k, top_k
from weir.operators.setops import union_distinct
from weir.sinks import audit, rejects
from weir.sinks.tables import SnapshotTable
from weir.sources.files import SRC

# Location value of indoor readings; default location text.
INDOOR = "In"
UNKNOWN_LOCATION = "unknown"

# ---- extremes (PIP-3) --------------------------------------------------------


def indoor_readings(csv: DataFrame, fmt: str = IOT_TS_FORMAT) -> DataFrame:
    """Indoor rows with the reading day (strict parse: a bad date fails the
    run) and the temperature as a number (FIL-1, DAT-1, DAT-5)."""
    return csv.filter(F.col("`out/in`") == INDOOR).select(
        "id",
        F.to_date(parse_ts_strict("noted_date", fmt)).alias("day"),
        number_or_null("temp").alias("temp"),
    )


def _band(readings: DataFrame, qs, approx_accuracy) -> DataFrame:
    # The band is taken over readings with a parsed day. The strict parse
    # never yields NULL, so this changes no value, but it makes the parse run
    # over every indoor row (a bad date fails the run, as in the reference)
    # instead of only over rows that survive the band.
    banded = readings.select(F.when(F.col("day").isNotNull(), F.col("temp")).alias("temp"))
    return percentiles(banded, "temp", qs, ("p_low", "p_high"), approx_accuracy)


def temp_percentiles(csv: DataFrame, qs=(0.05, 0.95), fmt: str = IOT_TS_FORMAT, approx_accuracy=None) -> DataFrame:
    """Global percentiles of indoor temperatures (AGG-2, Q12: after the
    indoor filter, over all days)."""
    return _band(indoor_readings(csv, fmt), qs, approx_accuracy)


def temp_trimmed(csv: DataFrame, qs=(0.05, 0.95), fmt: str = IOT_TS_FORMAT, approx_accuracy=None) -> DataFrame:
    """Indoor readings inside the percentile band, inclusive (FIL-3, JOI-4)."""
    readings = indoor_readings(csv, fmt)
    bounds = _band(readings, qs, approx_accuracy)
    return within_bounds(readings, "temp", bounds, "p_low", "p_high")


def temp_daily_stats(csv: DataFrame, qs=(0.05, 0.95), fmt: str = IOT_TS_FORMAT, approx_accuracy=None) -> DataFrame:
    """Mean / min / max per day of the trimmed readings (AGG-1)."""
    return (
        temp_trimmed(csv, qs, fmt, approx_accuracy)
        .groupBy("day")
        .agg(
            F.avg("temp").alias("avg_temp"),
            F.min("temp").alias("min_temp"),
            F.max("temp").alias("max_temp"),
        )
    )


def hottest_days(daily: DataFrame, k: int = 5) -> DataFrame:
    return top_k(daily, "avg_temp", k, tie_break=("day",))


def coldest_days(daily: DataFrame, k: int = 5) -> DataFrame:
    return bottom_k(daily, "avg_temp", k, tie_break=("day",))


def temperature_extremes(csv: DataFrame, k: int = 5, qs=(0.05, 0.95), fmt: str = IOT_TS_FORMAT) -> DataFrame:
    """The ``k`` hottest and ``k`` coldest days, a day listed once (PIP-3).
    A day in both lists carries the same values in both, so de-duplicating
    by day is a set union."""
    daily = temp_daily_stats(csv, qs, fmt)
    return union_distinct(hottest_days(daily, k), coldest_days(daily, k))


def load_extremes(table: SnapshotTable, extremes: DataFrame) -> int:
    """Upsert by day; days that stop being extreme stay (Q13)."""
    contract = schemas.TEMPERATURE_DAILY_STATS
    return table.upsert(conform(extremes, contract), ["day"], contract=contract)


# ---- shared cleaning ---------------------------------------------------------


def normalised(csv: DataFrame, strip: bool = True) -> DataFrame:
    """Header names lower-cased, spaces and slashes to ``_`` (PRJ-1)."""
    return csv.toDF(*[c if c == SRC else normalise_name(c, strip) for c in csv.columns])


def _opt(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def marked(csv: DataFrame, fmt: str = IOT_TS_FORMAT, strip: bool = True) -> DataFrame:
    """Normalised names and the timestamp parsed leniently; a row without a
    valid timestamp gets ``_reason`` and, as ``_record``, its columns (PRJ-1, DAT-2, FIL-2)."""
    df = normalised(csv, strip)
    body = F.to_json(F.struct(*[c for c in df.columns if c != SRC]))
    df = df.withColumn("_body", body).withColumn("noted_date", parse_ts_lenient("noted_date", fmt))
    return rejects.mark(df, F.when(F.col("noted_date").isNull(), rejects.BAD_DATE), F.col("_body")).drop("_body")


def parsed(csv: DataFrame, fmt: str = IOT_TS_FORMAT, strip: bool = True) -> DataFrame:
    """The rows of ``marked`` with a timestamp; the loads count the others."""
    df = normalised(csv, strip)
    return df.withColumn("noted_date", parse_ts_lenient("noted_date", fmt)).dropna(subset=["noted_date"])


# ---- full load (PIP-4) -------------------------------------------------------


def _clean(df: DataFrame, id_suffix: int) -> list[Column]:
    return [
        F.col("noted_date"),
        number_or_null(_opt(df, "temp")).alias("temperature"),
        F.coalesce(_opt(df, "out_in"), F.lit(UNKNOWN_LOCATION)).alias("location"),
        suffix(_opt(df, "id"), id_suffix).alias("device_id"),
    ]


def full_clean(csv: DataFrame, fmt: str = IOT_TS_FORMAT, id_suffix: int = 10) -> DataFrame:
    """Rows for the full load: timestamp, temperature, location, device id
    (last ``id_suffix`` characters of ``id``) (STR-1, STR-4, Q7, Q8, Q18)."""
    df = parsed(csv, fmt, strip=False)
    return df.select(*_clean(df, id_suffix))


def full_load(
    spark: SparkSession,
    csv: DataFrame,
    root: str,
    batch_id: str,
    loaded_at: dt.datetime,
    fmt: str = IOT_TS_FORMAT,
    id_suffix: int = 10,
) -> int:
    """Parse -> staging -> final table, atomically replaced, plus one audit row
    with the staging row count (SNK-2, SNK-5, SNK-9). Rows without a valid
    timestamp go to ``rejects`` under the batch, counted by the staging write;
    a breach of the contract publishes nothing. Returns the rows loaded."""
    part = rejects.split(marked(csv, fmt, strip=False), "temperature-full")
    rejects.store(part, f"{root}/rejects", batch_id)
    contract = schemas.TEMPERATURE_FULL
    rows = conform(part.rows.select(*_clean(part.rows, id_suffix)), contract)
    final = SnapshotTable(spark, f"{root}/temperature_full")
    final.replace(rows.withColumn("load_timestamp", F.lit(loaded_at).cast("timestamp")), contract)
    audit.record_full_load(spark, f"{root}/load_history", batch_id, part.loaded, loaded_at)
    return part.loaded


# ---- incremental load (PIP-5, PIP-6) ----------------------------------------


def incremental_window(csv: DataFrame, days: int = 7, fmt: str = IOT_TS_FORMAT) -> DataFrame:
    """Readings no older than ``days`` before the newest reading (FIL-4)."""
    return trailing_window(parsed(csv, fmt), "noted_date", days)


def batch_of(
    readings: DataFrame, batch_id: str, days: int = 7, order_by: Sequence[str] = (SRC,)
) -> DataFrame:
    """One incremental batch of parsed readings: the window's rows, last one
    per (noted_date, device_id) in source order (DED-2)."""
    rows = incremental_rows(trailing_window(readings, "noted_date", days), batch_id)
    return conform(keep_last(rows, ["noted_date", "device_id"], list(order_by)), schemas.TEMPERATURE_INCREMENTAL)


def with_fallback_id(window: DataFrame) -> DataFrame:
    """``_fallback``: ``row_<hash of the row's content>-<number among identical
    rows>`` for rows without an id (STR-5, Q9). It depends on content alone,
    so it is the same for any split, file order or number of cores. Identical
    rows are counted and numbered, never gathered by row."""
    content = ["noted_date", "temp", "out_in"]
    named = window.where(F.col("id").isNotNull()).withColumn("_fallback", F.lit(None).cast("string"))
    text = [F.date_format("noted_date", "yyyy-MM-dd HH:mm:ss"), F.coalesce("temp", F.lit("")), F.coalesce("out_in", F.lit(""))]
    hashed = F.md5(F.concat_ws("|", *text))
    order = F.min(SRC).alias(SRC)
    alike = window.where(F.col("id").isNull()).groupBy(*content).agg(F.count(F.lit(1)).alias("_n"), order)
    numbered = alike.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    fallback = F.concat(F.lit("row_"), hashed, F.lit("-"), F.col("_k").cast("string"))
    missing = numbered.withColumn("_fallback", fallback).drop("_n", "_k")
    return named.unionByName(missing, allowMissingColumns=True)


def incremental_rows(
    window: DataFrame, batch_id: str, id_suffix: int = 15, location_len: int = 10
) -> DataFrame:
    """Target rows: device id is the last ``id_suffix`` characters of ``id``,
    or the content-based fallback when ``id`` is missing; location cut to
    ``location_len``."""
    for c in ("id", "temp", "out_in"):
        if c not in window.columns:
            window = window.withColumn(c, F.lit(None).cast("string"))
    window = with_fallback_id(window)
    return window.select(
        "noted_date",
        number_or_null(F.col("temp")).alias("temperature"),
        prefix(F.coalesce(F.col("out_in"), F.lit(UNKNOWN_LOCATION)), location_len).alias("location"),
        F.coalesce(suffix(F.col("id"), id_suffix), F.col("_fallback")).alias("device_id"),
        F.lit(batch_id).alias("batch_id"),
        SRC,
    )


def incremental_batch(
    csv: DataFrame,
    batch_id: str,
    days: int = 7,
    fmt: str = IOT_TS_FORMAT,
    order_by: Sequence[str] = (SRC,),
) -> DataFrame:
    """``batch_of`` the readings of an export that have a timestamp."""
    return batch_of(parsed(csv, fmt), batch_id, days, order_by)


def load_incremental(table: SnapshotTable, batch: DataFrame, loaded_at: dt.datetime) -> int:
    """Upsert on (noted_date, device_id); ``load_timestamp`` refreshed (SNK-3)."""
    stamp = F.lit(loaded_at).cast("timestamp")
    return table.upsert(
        batch,
        ["noted_date", "device_id"],
        update_cols=["temperature", "location", "batch_id"],
        stamps={"load_timestamp": stamp},
        contract=schemas.TEMPERATURE_INCREMENTAL,
    )


def incremental_load(
    spark: SparkSession,
    csv: DataFrame,
    root: str,
    started: dt.datetime,
    days: int = 7,
    fmt: str = IOT_TS_FORMAT,
    clock=None,
) -> dict[str, int]:
    """One run of the incremental load (PIP-5): the export is parsed once,
    rows without a valid timestamp go to ``rejects`` under the batch, the
    window's last rows are upserted by (noted_date, device_id), and the run is
    logged. Returns the keys loaded and the rows rejected."""
    batch_id = audit.incremental_batch_id(started)
    table = SnapshotTable(spark, f"{root}/temperature_incremental")
    with audit.audited_run(spark, f"{root}/load_history_incremental", "incremental", batch_id, clock=clock) as run:
        part = rejects.split(marked(csv, fmt), "temperature-incremental")
        rejects.store(part, f"{root}/rejects", batch_id)
        batch, obs = audit.counted(batch_of(part.rows, batch_id, days), f"incremental-{batch_id}-{uuid.uuid4().hex}")
        load_incremental(table, batch, started)
        run["records"] = int(obs.get["rows"])
    return {"loaded": run["records"], "rejected": part.rejected}


def incremental_summary(target: DataFrame) -> DataFrame:
    """Row count, period, and mean / min / max temperature to 2 decimals, in
    one aggregate (PIP-6, AGG-8). An empty table gives a count of 0 and NULLs."""
    return target.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("noted_date").alias("period_start"),
        F.max("noted_date").alias("period_end"),
        F.round(F.avg("temperature"), 2).alias("avg_temperature"),
        F.round(F.min("temperature"), 2).alias("min_temperature"),
        F.round(F.max("temperature"), 2).alias("max_temperature"),
    )
