"""Set operations (SET-1, SET-2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SQL ``UNION``: rows of all inputs, duplicates removed (SET-1)."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def concat(*frames: DataFrame) -> DataFrame:
    """SQL ``UNION ALL`` by column name (SET-2)."""
    return reduce(lambda a, b: a.unionByName(b), frames)
