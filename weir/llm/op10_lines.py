"""Line de-duplication by a suffix array over line identifiers.

Every document is the sequence of its non-blank lines, a line standing for the
hash of its text. Distributed prefix doubling ranks all suffixes of these
sequences by their first 1, 2, 4, ... lines: the rank at 2k is that of the
pair (rank at k here, rank at k k lines on). Suffixes of equal rank at k form
an interval whose longest common prefix has at least k lines; suffixes that
are alone leave the doubling, which ends when nothing repeats. A run of lines
that also stands earlier in the corpus is deleted. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import Stage, ranked, table

WORD_CHAR = "[^\\x20\\x09-\\x0D]"
WORD = WORD_CHAR + "+"
#: A repeated run counts with this many lines ...
MIN_LINES = 2
#: ... or as a single line with this many words, or this many characters (scripts
#: without spaces).
MIN_WORDS, MIN_CHARS = 20, 200

_PLACE = ["doc", "key", "seq"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: rows equal in id and text share it and count as
    one document."""
    return docs.withColumn("_key", F.xxhash64(F.col("doc_id").cast("string"), F.lit("\x00"), "text"))


def line_table(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: doc (null ids last), key, seq (number among
    the non-blank lines), line (number among all), h1, h2, n_words, n_chars."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("text")))
    # posexplode_outer: posexplode would compute the array once more in a filter
    return (
        keyed(docs)
        .select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
            F.col("_key").alias("key"),
            F.posexplode_outer(F.filter(lines, lambda x: x.text.rlike(WORD_CHAR))).alias("seq", "x"),
        )
        .where("x is not null")
        .select(
            "doc",
            "key",
            F.col("seq").cast("long").alias("seq"),
            F.col("x.line").alias("line"),
            F.xxhash64("x.text").alias("h1"),
            F.xxhash64(F.lit("second"), "x.text").alias("h2"),
            F.regexp_count("x.text", F.lit(WORD)).alias("n_words"),
            F.char_length("x.text").alias("n_chars"),
        )
    )


def _intervals(stage: Stage, suffixes: DataFrame, by: list[str], name: str) -> DataFrame:
    """Suffixes whose key ``by`` repeats, with ``rank`` (suffixes with a smaller
    key, among those that repeat) and ``later`` (not the first of its interval)."""
    cols = [c for c in suffixes.columns if c not in by]
    place = F.struct(*_PLACE)
    intervals = (
        suffixes.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
    )
    order = [F.col(c) for c in by]
    ranks = ranked(stage, intervals, order, f"{name}-intervals", weight=F.col("n"))
    return stage.write(
        suffixes.join(ranks, by).select(*cols, "rank", (F.struct(*_PLACE) > F.col("first")).alias("later")), name
    )


def repeated_runs(stage: Stage, lines: DataFrame, min_lines: int) -> DataFrame:
    """(doc, key, seq, run), staged: a run of ``run`` lines from ``seq`` on that
    also stands earlier, ``run`` being 1, ``min_lines`` and every larger power
    of two up to the longest repeat.

    The ranks at a power of two give those at any length up to its double: a
    run of ``m`` lines is one of ``k`` lines here and one ``m - k`` lines on."""

    def at_distance(level: DataFrame, ahead: int) -> DataFrame:
        other = F.max("rank").over(Window.partitionBy("doc", "key").orderBy("seq").rangeBetween(ahead, ahead))
        return level.select(*_PLACE, F.col("rank").alias("r1"), other.alias("r2")).where("r2 is not null")

    level = _intervals(stage, lines.select(*_PLACE, "h1", "h2"), ["h1", "h2"], "ranks-1")
    found = [level.where("later").select(*_PLACE, F.lit(1).alias("run"))]
    k = 1
    while True:
        if k < min_lines < 2 * k:
            exact = _intervals(stage, at_distance(level, min_lines - k), ["r1", "r2"], "ranks-least")
            found.append(exact.where("later").select(*_PLACE, F.lit(min_lines).alias("run")))
        pairs = at_distance(level, k)
        k *= 2
        level = _intervals(stage, pairs, ["r1", "r2"], f"ranks-{k}")
        if k == 2:  # the rounds get smaller; the first two hold nearly all rows
            stage.release()
        if level.isEmpty():
            break
        if k >= min_lines:
            found.append(level.where("later").select(*_PLACE, F.lit(k).alias("run")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    out = stage.write(out, "runs")
    for name in [f"ranks-{1 << i}" for i in range(k.bit_length())] + ["ranks-least"]:
        stage.drop(name)
        stage.drop(f"{name}-intervals")
    return out


def line_dedup(
    docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` with the kept lines as ``text`` and n_lines (non-blank),
    n_removed, n_runs (maximal deleted runs), longest_run (``min_lines`` or the
    largest power of two above it of lines in a row that also stand earlier; 0
    without).

    A line goes when it belongs to a run of ``min_lines`` lines that also
    stands earlier in the corpus (by doc_id, then line; within a document
    too), or when it has ``min_words`` words or ``min_chars`` characters and
    stands earlier itself; runs are judged on the input. Texts and lines of any
    length are taken whole. Blank lines are not part of the sequences and
    stay. Null text stays null with 0 lines; null ids come last; rows equal
    in id and text are one document and get the same result; an empty table
    gives no rows; other columns pass through (the added names replace
    columns of the same name).
    """
    if min_lines < 1:
        raise ValueError("min_lines must be positive")
    stage = Stage(docs.sparkSession, "line-dedup")
    lines = stage.write(line_table(docs), "lines")
    runs = repeated_runs(stage, lines, min_lines)
    window = runs.where(F.col("run") == min_lines).select(
        "key", F.explode(F.sequence(F.col("seq"), F.col("seq") + min_lines - 1)).alias("seq")
    )
    single = (
        runs.where("run = 1")
        .join(lines.where((F.col("n_words") >= min_words) | (F.col("n_chars") >= min_chars)).select(*_PLACE), _PLACE, "left_semi")
        .select("key", "seq")
    )
    gone = lines.select("key", "seq", "line").distinct().join(window.unionByName(single).distinct(), ["key", "seq"], "left_semi")
    fresh = F.coalesce(F.col("seq") - F.lag("seq").over(Window.partitionBy("key").orderBy("seq")) != 1, F.lit(True))
    per_doc = gone.select("key", "line", fresh.alias("fresh")).groupBy("key").agg(
        F.collect_list("line").alias("_gone"), F.count(F.when(F.col("fresh"), 1)).alias("n_runs")
    )
    longest = runs.where(F.col("run") >= min_lines).groupBy("key").agg(F.max("run").cast("long").alias("longest_run"))
    facts = stage.write(per_doc.join(longest, "key", "left").withColumnRenamed("key", "_key"), "removed")
    # what follows reads the documents and the facts alone
    stage.drop("lines")
    stage.drop("runs")
    stage.release()
    added = ["n_lines", "n_removed", "n_runs", "longest_run"]
    cols = [c for c in docs.columns if c not in added]
    # facts grow with the documents: a shuffle join at every size, never a broadcast
    d = keyed(docs.select(*cols)).join(facts.hint("merge"), "_key", "left")
    d = d.withColumn("_lines", F.split("text", "\n"))
    d = d.withColumn("_kept", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone"))
    kept = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    zero = F.lit(0).cast("long")
    filled = F.coalesce(F.size(F.filter("_lines", lambda x: x.rlike(WORD_CHAR))).cast("long"), zero)
    return d.select(
        *[F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c) for c in cols],
        F.when(F.col("text").isNull(), zero).otherwise(filled).alias("n_lines"),
        F.when(F.col("_gone").isNull(), zero).otherwise(F.size("_gone").cast("long")).alias("n_removed"),
        F.coalesce("n_runs", zero).alias("n_runs"),
        F.coalesce("longest_run", zero).alias("longest_run"),
    )


def op10_lines(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", "n_lines", "n_removed", "n_runs", "longest_run", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )
