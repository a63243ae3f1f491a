"""Quality rules: hashed n-gram log-likelihood ratio with fixed thresholds.

Two multinomials over hashed word 1- and 2-grams: the trusted target (documents
labelled good) and the raw corpus (all documents). A
document's score is its log-likelihood ratio divided by its number of n-grams;
documents below the threshold go, as do those that fail the base rules. Built
from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stage, table
from weir.operators.bounds import percentiles

SPACE = "[\\x20\\x09-\\x0D]+"
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"

BUCKETS = 1 << 14


def word_array(text: Column) -> Column:
    """Words of a text; null and empty text have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _shifted(a: Column, by: int, fn) -> Column:
    """``fn(a[i], a[i + by])`` for every i that has both."""
    n = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + by), n), fn)


def base_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed and ``_h1`` / ``_h2``, the hashes of its
    words and of its 2-grams.

    Columns that lambdas read are projections of their own with two uses or
    more, which Spark does not inline into the lambdas."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("_words", word_array(F.col("text")))
    d = d.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR)))
    d = d.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"),
    ).drop("_lines", "_words")
    # hash of every 8-word window, by doubling the window length three times
    for col, prev, by in (("_h2", "_h1", 1), ("_h4", "_h2", 2), ("_h8", "_h4", 4)):
        d = d.withColumn(col, _shifted(F.col(prev), by, lambda a, b: F.xxhash64(a, b)))
    repeated = F.size("_h8") > F.size(F.array_distinct("_h8"))
    at = F.sort_array(F.transform("_h8", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    none = F.expr("cast(array() as array<struct<x:bigint,i:int>>)")
    d = d.withColumn("_at", F.when(repeated, at).otherwise(none))
    twins = _shifted(
        F.col("_at"), 1, lambda a, b: F.when(a.x == b.x, F.array(a.i, b.i)).otherwise(F.expr("cast(array() as array<int>)"))
    )
    d = d.withColumn("_pos", F.sort_array(F.array_distinct(F.flatten(twins))))
    gaps = _shifted(F.col("_pos"), 1, lambda a, b: F.least(b - a, F.lit(8)))
    covered = F.aggregate(gaps, F.lit(8).cast("long"), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", F.when(F.size("_pos") > 0, covered).otherwise(F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return d.drop("_h4", "_h8", "_at", "_pos").withColumn("base_failed", failed)


def with_grams(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_h1`` and ``_h2`` alone, as ``base_columns`` has them."""
    d = docs.withColumn("_h1", F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)))
    return d.withColumn("_h2", _shifted(F.col("_h1"), 1, lambda a, b: F.xxhash64(a, b)))


def labelled_ids(labels: DataFrame) -> DataFrame:
    """Every labelled id (t_id, good, half). An id labelled both ways counts as
    good. One half of the ids fits the target, the other the threshold: scores
    of documents that the target was fitted on are too high."""
    return (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("t_id"))
        .agg((F.max("quality") == 1).alias("good"))
        .withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "t_id"), F.lit(2)))
    )


def log_ratios(docs: DataFrame, fit: DataFrame, buckets: int) -> list[float] | None:
    """log p_target - log p_raw per bucket, add-one smoothed; the raw counts
    cover every document. ``buckets`` numbers reach the driver. None when
    nothing is trusted."""
    # the labels grow with the documents: a shuffle join at every size
    trusted = fit.where("good and half = 0").hint("merge")
    marked = docs.join(trusted, docs["doc_id"] == trusted["t_id"], "left").select(
        "text", F.col("t_id").isNotNull().alias("good")
    )
    # explode_outer: explode would add a filter on the array's size below the
    # projections, which computes the array a second time
    counted = (
        with_grams(marked)
        .select("good", F.explode_outer(F.concat("_h1", "_h2")).alias("h"))
        .where("h is not null")
        .groupBy(F.pmod("h", F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.count(F.when(F.col("good"), 1)).alias("target"))
        .collect()
    )
    raw, target = [1] * buckets, [1] * buckets
    for r in counted:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if sum(target) == buckets:
        return None
    from math import log

    n_raw, n_target = sum(raw), sum(target)
    return [log(t / n_target) - log(r / n_raw) for r, t in zip(raw, target)]


def score(ratios: list[float], buckets: int) -> Column:
    """Mean log ratio over a document's 1- and 2-grams; null without any."""
    # one text literal, folded to an array once per plan
    lookup = F.split(F.lit(",".join(repr(round(x, 9)) for x in ratios)), ",").cast("array<double>")

    def total(grams: str) -> Column:
        step = lambda s, h: s + F.element_at(lookup, F.pmod(h, F.lit(buckets)).cast("int") + 1)
        return F.aggregate(grams, F.lit(0.0), step)

    n = F.size("_h1") + F.size("_h2")
    return F.when(n > 0, (total("_h1") + total("_h2")) / n)


def threshold(docs: DataFrame, fit: DataFrame, ratios: list[float], buckets: int, stage: Stage) -> float | None:
    """Midway between the 1 % quantile of the good sample's scores and the 90 %
    quantile of the bad one's, never above the former. Null without a good
    score. The quantiles are exact, over every score of the threshold's half.

    Every document is scored where it lies: only ids and scores are shuffled
    to the labels, no text."""
    scored = with_grams(docs.select("doc_id", "text")).select("doc_id", score(ratios, buckets).alias("s"), F.size("_h1").alias("n"))
    scored = stage.write(scored, "scored")
    half = fit.where("half = 1").hint("merge")
    labelled = scored.where("n >= 20").join(half, scored["doc_id"] == half["t_id"])
    scores = stage.write(labelled.select("good", "s"), "scores")
    good = percentiles(scores.where("good"), "s", [0.01], ["q"]).first().q
    bad = percentiles(scores.where("not good"), "s", [0.9], ["q"]).first().q
    if good is None or bad is None:
        return good
    return min(good, (good + bad) / 2)


def quality(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with the base columns, ``score`` (double) and ``kept``.

    kept: the base rules hold and the score is at least the threshold. Null or
    empty text has no words, fails the base rules and is not kept. Without
    trusted labels every document that passes the base rules is kept. Null ids
    are never in the fit; repeated rows are judged alike; extra columns pass
    through (names that start with an underscore are reserved).
    """
    stage = Stage(docs.sparkSession, "quality")
    fit = stage.write(labelled_ids(labels), "fit")
    ratios = log_ratios(docs, fit, buckets)
    stage.release()
    based = base_columns(docs)
    if ratios is None:
        return _judged(based.withColumn("score", F.lit(None).cast("double")), F.lit(True))
    level = threshold(docs, fit, ratios, buckets, stage)
    passes = F.lit(True) if level is None else F.coalesce(F.col("score") >= F.lit(level), F.lit(False))
    return _judged(based.withColumn("score", score(ratios, buckets)), passes)


def _judged(scored: DataFrame, passes: Column) -> DataFrame:
    """``scored`` with ``kept``. The verdict comes out of a generator: Spark
    would push a filter on a plain column below the projections and compute
    the arrays inside the lambdas over and over."""
    kept = F.explode_outer(F.array(~F.col("base_failed") & passes)).alias("kept")
    return scored.drop("_h1", "_h2").select("*", kept)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    labels = spark.read.parquet(table(sf_dir, "labels"))
    return quality(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )
