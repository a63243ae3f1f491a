"""Nested-value helpers: JSON text, array sizes, NULL normalisation, tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weir.functions.text import last_token_int


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def json_text(col: Column | str) -> Column:
    """Serialise an array/struct to compact JSON text; NULL stays NULL (JSN-3)."""
    c = _c(col)
    return F.when(c.isNotNull(), F.to_json(c))


def json_text_nonempty(col: Column | str) -> Column:
    """As ``json_text`` but an empty array is NULL too (flattened pets, JSN-3)."""
    c = _c(col)
    return F.when(F.size(c) > 0, F.to_json(c))


def safe_size(col: Column | str) -> Column:
    """Array length, 0 when the value is absent (ARR-1)."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def nan_to_null(col: Column | str) -> Column:
    """Floating NaN becomes NULL (PRJ-6)."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


# Text spellings of a missing value in exported frames.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null", "NaT",
)


def text_or_null(col: Column | str) -> Column:
    """A text spelling of a missing value becomes NULL (PRJ-6, Q7)."""
    c = _c(col)
    return F.when(~c.isin(*MISSING_TEXT), c)


def number_or_null(col: Column | str) -> Column:
    """Text to double; NaN and missing spellings become NULL, other junk fails (ANSI)."""
    t = text_or_null(F.trim(_c(col)))
    return nan_to_null(t.cast("double"))


# Subscription tiers by the numeric suffix of a user id.
TIER_PREMIUM, TIER_STANDARD, TIER_FREE = "premium", "standard", "free"


def subscription_tier(user_id: Column | str, delimiter: str = "_") -> Column:
    """Suffix divisible by 3 is premium, else by 2 standard, else free;
    an unparsable or missing suffix is free (CON-1)."""
    n = last_token_int(user_id, delimiter)
    return (
        F.when(F.pmod(n, F.lit(3)) == 0, F.lit(TIER_PREMIUM))
        .when(F.pmod(n, F.lit(2)) == 0, F.lit(TIER_STANDARD))
        .otherwise(F.lit(TIER_FREE))
    )
