"""Top-k / bottom-k (TOP-1, TOP-2).

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition
keeps its own k best rows and only those k×partitions rows meet in one task,
so the single-partition step is bounded by k, never by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties broken by ``tie_break`` ascending."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc() for c in tie_break]).limit(k)


def bottom_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the smallest ``by``; ties broken by ``tie_break`` ascending."""
    return df.orderBy(F.col(by).asc_nulls_last(), *[F.col(c).asc() for c in tie_break]).limit(k)
