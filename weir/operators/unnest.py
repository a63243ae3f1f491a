"""Array unnesting, the lateral joins of the reference (JOI-2, JOI-3, ARR-2, ARR-3).

A ``Generate`` node: narrow, no shuffle, no correlation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array_col: str, as_name: str, keep: Sequence[str] | None = None) -> DataFrame:
    """CROSS JOIN LATERAL: a row per element; parents without elements vanish."""
    keep = list(keep if keep is not None else [c for c in df.columns if c != array_col])
    return df.select(*keep, F.explode(array_col).alias(as_name))


def unnest_outer(df: DataFrame, array_col: str, as_name: str, keep: Sequence[str] | None = None) -> DataFrame:
    """LEFT JOIN LATERAL: parents with a NULL or empty array keep one row, element NULL."""
    keep = list(keep if keep is not None else [c for c in df.columns if c != array_col])
    return df.select(*keep, F.explode_outer(array_col).alias(as_name))


def unnest_structs(df: DataFrame, array_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Array of structs to rows with one column per struct field (``inline``)."""
    return df.select(*keep, F.inline(F.col(array_col)))
