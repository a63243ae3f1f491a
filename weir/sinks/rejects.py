"""Rejects counted in the load's own pass (SRC-2..SRC-4, DAT-2, FIL-2).

A load marks what it cannot take: ``_reason`` says why (NULL for rows to
load), ``_record`` holds the refused text. ``split`` writes such a frame once,
rows and rejects side by side; the counts are metrics of that write, so the
source is scanned and parsed a single time. Rejects are stored under the name
of their load: a load that runs again replaces its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.session import run_dir

REASON, RECORD = "_reason", "_record"
_SIDE = "_rejected"

REJECTS = T.StructType([T.StructField("reason", T.StringType()), T.StructField("file", T.StringType()), T.StructField("record", T.StringType())])

# Why a load refuses a record.
MALFORMED, NO_KEY, BAD_DATE = "malformed", "no key", "bad date"
REASONS = (MALFORMED, NO_KEY, BAD_DATE)


@dataclass
class Split:
    """Staged rows, staged rejects (reason, file, record) and their counts."""

    rows: DataFrame
    rejects: DataFrame
    loaded: int
    refused: dict[str, int]

    @property
    def rejected(self) -> int:
        return sum(self.refused.values())


def mark(df: DataFrame, reason: Column, record: Column) -> DataFrame:
    """``df`` with ``_reason`` and, for what is refused, ``_record``."""
    return df.withColumn(REASON, reason).withColumn(RECORD, F.when(F.col(REASON).isNotNull(), record))


def mark_documents(docs: DataFrame, key: str, corrupt: str = "_corrupt_record") -> DataFrame:
    """Documents as read by ``read_collection``: a line that does not parse is
    ``malformed``, a document without a key has ``no key``; both are refused."""
    text = F.col(corrupt) if corrupt in docs.columns else F.lit(None).cast("string")
    body = F.to_json(F.struct(*[c for c in docs.columns if c not in (corrupt, "_src")]))
    why = F.when(text.isNotNull(), MALFORMED).otherwise(NO_KEY)
    return mark(docs, F.when(F.col(key).isNull(), why), F.coalesce(text, body)).drop(corrupt)


def split(marked: DataFrame, name: str, reasons: Sequence[str] = REASONS) -> Split:
    """Write a marked frame once below the shared folder and read its two
    sides back (the file of a record is taken from ``_src``, where there is one)."""
    spark = marked.sparkSession
    path = run_dir(spark, f"split-{name}")
    obs = Observation(f"split-{uuid.uuid4().hex}")
    counts = [F.count_if(F.col(REASON) == r).alias(f"r{i}") for i, r in enumerate(reasons)]
    loaded, refused = F.count_if(F.col(REASON).isNull()).alias("loaded"), F.count(REASON).alias("refused")
    out = marked.observe(obs, loaded, refused, *counts).withColumn(_SIDE, F.col(REASON).isNotNull())
    out.write.partitionBy(_SIDE).option("compression", "zstd").parquet(path)
    got = obs.get
    by_reason = {r: int(got[f"r{i}"]) for i, r in enumerate(reasons) if got[f"r{i}"]}
    if sum(by_reason.values()) != got["refused"]:
        raise ValueError(f"{name}: a reason other than {', '.join(reasons)}")
    back = spark.read.schema(out.schema).parquet(path)
    file = F.col("_src.file") if "_src" in marked.columns else F.lit(None).cast("string")
    return Split(
        rows=back.where(~F.col(_SIDE)).drop(_SIDE, REASON, RECORD),
        rejects=back.where(_SIDE).select(F.col(REASON).alias("reason"), file.alias("file"), F.col(RECORD).alias("record")),
        loaded=int(got["loaded"]),
        refused=by_reason,
    )


def store(part: Split, root: str, load_id: str) -> None:
    """Keep the rejects of load ``load_id`` below ``root``, in place of those
    that an earlier attempt of the same load left."""
    folder = f"{root.rstrip('/')}/load_id={load_id}"
    part.rejects.write.mode("overwrite").parquet(folder)


def read(spark: SparkSession, root: str) -> DataFrame:
    """All rejects below ``root``: reason, file, record, load_id."""
    schema = T.StructType([*REJECTS.fields, T.StructField("load_id", T.StringType())])
    return spark.read.schema(schema).parquet(root)
