"""Key de-duplication with a declared order (DED-1, DED-2, DED-4).

Spark has no source order, so "first"/"last" take an explicit list of order
columns (sources attach ``_src`` for file order). The survivor is the row with
``row_number() = 1``: Spark plans a partial window group limit before the
shuffle, so a hot key shrinks to one row per input partition, and columns that
nobody reads are pruned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool) -> DataFrame:
    if not keys:
        raise ValueError("keys must not be empty")
    if not order_by:
        raise ValueError("order_by must name at least one column")
    # NULL order values sort first, as in an ascending sort
    order = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_first() for c in order_by]
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order_by`` (DED-1)."""
    return _pick(df, keys, order_by, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order_by`` (DED-2)."""
    return _pick(df, keys, order_by, last=True)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """``SELECT DISTINCT cols`` (DED-4); partial aggregation before the shuffle."""
    return df.select(*cols).distinct()
