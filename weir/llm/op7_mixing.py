"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (by hash of the
id), repeated for at most ``max_epochs``. A document's virtual finish time is
the words of its source up to and including it, divided by the source's
weight. All copies are range-sorted by finish time, and the mix ends at the
total budget; the document in service when it ends is kept when that brings
its source nearer to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import Stage, ranked, table

WORD = "[^\\x20\\x09-\\x0D]+"


def targets(stage: Stage, sources: DataFrame, weights: Sequence[float], share: float, max_epochs: int) -> DataFrame:
    """source, source_size, weight, target: ``share`` of all sizes dealt by
    weight; a target stops at ``max_epochs`` times its source's size and the
    excess is dealt again among the others until none is above its stop."""
    n = len(weights)
    order = [F.col("source").isNull(), F.col("source")]
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % n + 1).cast("int"))
    src = stage.write(ranked(stage, sources, order, "source-order").withColumn("weight", w).drop("rank"), "sources")
    cap = F.col("source_size") * max_epochs
    total = src.agg(F.sum("source_size").alias("s")).first().s or 0
    budget = share * float(total)
    level, capped = 0.0, -1
    while True:  # the set of sources at their stop only grows, so this ends
        at_stop = F.col("weight") * F.lit(level) >= cap
        r = src.agg(
            F.count(F.when(at_stop, 1)).alias("n"),
            F.sum(F.when(at_stop, cap)).alias("used"),
            F.sum(F.when(~at_stop, F.col("weight"))).alias("w"),
        ).first()
        if not r.w or r.n == capped:
            break
        capped, level = r.n, max(level, (budget - float(r.used or 0)) / r.w)
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return src.withColumn("target", target)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target,
    copies (times the mix takes it), taken (its words in the mix), and the
    columns ``keep`` of ``docs``, joined back by id and text hash.

    Sources in code point order, a null source last, get ``weights`` in turn.
    Null text has size 0; a document without words is never taken. Repeated
    rows are documents of their own, also when they share an id. An empty
    table gives no rows. Reruns agree: the shuffle is a hash of the id and
    text, ties are broken by id, then by row content.
    """
    stage = Stage(docs.sparkSession, "mixing")
    sized = stage.write(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"))).alias("shuffle"),
            F.xxhash64("text").alias("content"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "sizes",
    )
    goals = stage.write(
        targets(stage, sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs),
        "targets",
    )
    # words of the source before each document, in its shuffled order
    order = [F.col(c) for c in ("source", "shuffle", "doc_id", "content", "row")]
    queued = ranked(stage, sized, order, "queues", group=["source"], weight=F.col("size"), out="before")
    g = goals.withColumnRenamed("source", "g_source")
    timed = queued.join(g, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
    timed = stage.write(timed, "timed")
    # each epoch's copy: words of the source until it starts / ends, and its virtual times
    copies = timed.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch")
    ).withColumn("end", F.col("epoch") * F.col("source_size") + F.col("before") + F.col("size"))
    copies = copies.withColumn("finish", F.col("end") / F.col("weight"))
    budget = goals.agg(F.sum("target").alias("b")).first().b or 0.0
    served = ranked(
        stage,
        copies.where("size > 0").select("row", "epoch", "size", "end", "target", "finish", "doc_id"),
        [F.col(c) for c in ("finish", "doc_id", "epoch", "row")],
        "served",
        weight=F.col("size"),
        out="position",
    )
    # the sorted mix is cut at the budget (`position`: words served before);
    # of the copies that the sources have in service there, those are kept
    # that lie within their source's target by half or more
    middle = F.col("end") - F.col("size") / 2.0
    inside = (F.col("position") <= F.lit(float(budget)) + F.col("size")) & (middle <= F.col("target"))
    took = served.where(inside).groupBy("row").agg(F.count(F.lit(1)).alias("copies"), F.min("position").alias("position"))
    out = timed.join(took, "row", "left").select(
        "row",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "content",
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
        (F.coalesce("copies", F.lit(0)) * F.col("size")).cast("long").alias("taken"),
    )
    if not keep:
        return out.drop("row", "content")
    # rows equal in id, source and text are told apart by a number within them
    same = ["doc_id", "source", "content"]
    facts = stage.write(out, "facts").select(
        *[F.col(c).alias(f"_f_{c}") for c in same],
        F.row_number().over(Window.partitionBy(*same).orderBy("row")).alias("_f_n"),
        "copies",
    )
    rows = docs.select(*keep, F.xxhash64("text").alias("_content"))
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("doc_id", "source", "_content").orderBy(F.lit(0))))
    on = [
        F.col("doc_id").eqNullSafe(F.col("_f_doc_id")),
        F.col("source").eqNullSafe(F.col("_f_source")),
        F.col("_content") == F.col("_f_content"),
        F.col("_n") == F.col("_f_n"),
    ]
    return rows.join(facts, on).select(*keep, "copies")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
