"""Date and time helpers. The session time zone must be UTC (see weir.session)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reading format of the IoT temperature export.
IOT_TS_FORMAT = "dd-MM-yyyy HH:mm"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts_strict(col: Column | str, fmt: str = IOT_TS_FORMAT) -> Column:
    """Parse with an explicit format; a malformed value fails the job (DAT-1, ANSI)."""
    return F.to_timestamp(_c(col), fmt)


def parse_ts_lenient(col: Column | str, fmt: str = IOT_TS_FORMAT) -> Column:
    """Parse with an explicit format; a malformed value becomes NULL (DAT-2)."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def parse_instant(col: Column | str) -> Column:
    """ISO-8601 text with an offset (``+03:00``, ``Z``) to a UTC instant (DAT-3)."""
    return _c(col).cast("timestamp")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end``, fractions truncated toward zero (DAT-4)."""
    micros = F.unix_micros(_c(end)) - F.unix_micros(_c(start))
    return (micros / F.lit(1_000_000)).cast("bigint").cast("int")


def as_date(ds: str | dt.date) -> dt.date:
    return ds if isinstance(ds, dt.date) else dt.date.fromisoformat(str(ds))


def on_day(ts: Column | str, ds: str | dt.date) -> Column:
    """``ts`` falls on day ``ds`` (FIL-6).

    Written as a half-open range against DATE literals (midnight in the
    session zone after coercion), so Parquet row groups are pruned by it for
    both TIMESTAMP and TIMESTAMP_NTZ columns.
    """
    day = as_date(ds)
    c = _c(ts)
    return (c >= F.lit(day)) & (c < F.lit(day + dt.timedelta(days=1)))


def up_to_day(ts: Column | str, ds: str | dt.date) -> Column:
    """The day of ``ts`` is ``ds`` or earlier (FIL-7)."""
    return _c(ts) < F.lit(as_date(ds) + dt.timedelta(days=1))


def minus_days(col: Column | str, days: int) -> Column:
    """``col - INTERVAL days DAYS`` (DAT-6)."""
    return _c(col) - F.make_dt_interval(F.lit(days))
