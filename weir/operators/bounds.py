"""Filters against bounds computed from the data itself (FIL-3, FIL-4, AGG-2, AGG-9).

The bounds are a global aggregate: exactly one row. Joining that row back is
a broadcast nested-loop join whose broadcast side is one row by
construction, so no size check is needed and the big side is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.functions.temporal import minus_days


#: Bins of one narrowing step of ``percentiles``.
BINS = 4096


def _narrowed(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target (i, at, rank, lo, hi: the value of this rank among those in
    ``[lo, hi]``) moved to the one of ``BINS`` equal bins that holds it, its
    range being the values that occur there."""
    bins = counts.join(F.broadcast(targets), F.col("v").between(F.col("lo"), F.col("hi")))
    # halves, as the difference of two doubles may be infinite
    share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    number = F.when(F.col("hi") > F.col("lo"), F.least(F.floor(share * BINS), F.lit(BINS - 1))).otherwise(F.lit(0))
    sums = bins.groupBy("i", "at", "rank", number.alias("bin")).agg(
        F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    # at most BINS rows a target
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    below = F.col("upto") - F.col("n")
    hit = sums.withColumn("upto", upto).where((below <= F.col("rank")) & (F.col("upto") > F.col("rank")))
    return hit.select("i", "at", (F.col("rank") - below).alias("rank"), "lo", "hi")


def percentiles(
    df: DataFrame,
    col: str,
    qs: Sequence[float] = (0.05, 0.95),
    names: Sequence[str] | None = None,
    approx_accuracy: int | None = None,
    steps: int = 2,
) -> DataFrame:
    """One row with the ``qs`` percentiles of ``col``; NULLs skipped (AGG-2).

    Exact by default (linear interpolation, as pandas ``quantile`` and DuckDB
    ``quantile_cont``), by distributed selection: the values are counted once
    (partial counts before the shuffle, which later steps reuse), ``steps``
    histograms of ``BINS`` bins narrow the range of each rank that is asked
    for, two a quantile, and only the values of its last bin are sorted. All of
    it is one lazy plan. ``approx_accuracy`` switches to the
    ``percentile_approx`` sketch explicitly.
    """
    names = list(names or [f"p{int(round(q * 100)):02d}" for q in qs])
    if approx_accuracy:
        agg = F.percentile_approx(F.col(col), list(qs), approx_accuracy)
        return df.agg(agg.alias("_q")).select(*[F.col("_q").getItem(i).alias(n) for i, n in enumerate(names)])
    counts = df.select(F.col(col).cast("double").alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    span = counts.agg(F.sum("n").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = []
    for k, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("total") - 1)
        for i, rank in ((2 * k, F.floor(at)), (2 * k + 1, F.ceil(at))):
            wanted.append(F.struct(F.lit(i).alias("i"), at.alias("at"), rank.alias("rank"), "lo", "hi"))
    targets = span.where("total > 0").select(F.inline(F.array(*wanted)))
    for _ in range(steps):
        targets = _narrowed(counts, targets)
    rest = counts.join(F.broadcast(targets), F.col("v").between(F.col("lo"), F.col("hi")))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    below = F.col("upto") - F.col("n")
    found = rest.withColumn("upto", upto).where((below <= F.col("rank")) & (F.col("upto") > F.col("rank")))
    out = []
    for k, name in enumerate(names):
        low, high = (F.max(F.when(F.col("i") == 2 * k + j, F.col("v"))) for j in (0, 1))
        at = F.max(F.when(F.col("i") == 2 * k, F.col("at")))
        part = at - F.floor(at)
        out.append(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(name))
    return found.agg(*out)


def within_bounds(df: DataFrame, col: str, bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """Rows whose ``col`` lies in ``[lo, hi]`` of the one-row ``bounds``; NULLs fall out (FIL-3)."""
    b = bounds.select(F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    return (
        df.join(F.broadcast(b), (F.col(col) >= F.col("_lo")) & (F.col(col) <= F.col("_hi")), "inner")
        .drop("_lo", "_hi")
    )


def trailing_window(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows with ``ts >= max(ts) - days`` — relative to the data's own latest
    reading, not the wall clock (FIL-4, AGG-9, DAT-6)."""
    cutoff = df.agg(minus_days(F.max(ts), days).alias("_cutoff"))
    return df.join(F.broadcast(cutoff), F.col(ts) >= F.col("_cutoff"), "inner").drop("_cutoff")
