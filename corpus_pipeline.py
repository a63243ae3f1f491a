"""The corpus pipeline: five stages over ``documents``, each by one of the
operators in ``weir.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet below the shared folder and rereads as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import op4_jaccard, op5_quality, op7_mixing, op8_packing, op10_lines
from weir.llm.common import Stage, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(table(sf_dir, "labels"))
    return op5_quality.quality(docs.select(*COLUMNS), labels).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that stand earlier in the corpus; those
    of which no line is left go. ``n_chars`` follows the text."""
    out = op10_lines.line_dedup(docs.select(*COLUMNS)).where("n_lines > n_removed")
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*COLUMNS)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest doc_id) of each group of near copies, with
    every document that has none."""
    joined = op4_jaccard.jaccard_join(docs.select("doc_id", "text"), with_text_hash=True)
    firsts = joined.where("first").select(F.col("doc_id").alias("f_id"), F.col("th").alias("f_th")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & F.xxhash64("text").eqNullSafe(F.col("f_th"))
    # rows equal in id and text are copies of each other: one of them stays
    return docs.select(*COLUMNS).join(firsts, same, "left_semi").dropDuplicates(["doc_id", "text"])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it."""
    times = op7_mixing.mix(docs.select(*COLUMNS), keep=COLUMNS)
    return times.where("copies > 0").withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 2048."""
    import public_tokenizers

    return op8_packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_dedup", jaccard_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Hashing, tokenising and packing have no SQL form; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(table(sf_dir, "documents"))
    for name, step in STAGES:
        docs = stage.write(step(spark, docs, sf_dir), name)
    return docs
