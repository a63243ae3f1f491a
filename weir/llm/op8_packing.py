"""Packing: shortest-pack-first over the length histogram.

Token documents are cut into pieces of at most ``length`` ids (full pieces
first, the rest last). The histogram of piece lengths (at most ``length``
numbers, whatever the corpus) is packed on the driver: lengths are placed
longest first, each into the shortest open packs that have room for it, many
at a time, by updating the counts of packing patterns. Patterns are joined
back to the pieces by the rank of each piece among those of its length, a
distributed running count, so nothing else passes the driver.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stage, map_batches, ranked
from weir.llm.tokens import encoder

PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece of each document's ids (end id included), little-endian
    uint32 in ``ids`` (null unless ``with_ids``). Null or empty text: the end
    id alone. Repeated rows are separate documents."""

    end = int(end_id).to_bytes(4, "little")

    def cut(batch: pa.RecordBatch):
        enc = encoder(tokenizer)
        doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        at = 0
        while at < len(texts):
            # bounded output batches: at most about SLICE_CHARS of text each
            to, chars = at, 0
            while to < len(texts) and (to == at or chars + len(texts[to]) < 4_000_000):
                chars += len(texts[to])
                to += 1
            cols = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids")}
            for doc, ids in zip(doc_ids[at:to], enc.batch(texts[at:to])):
                raw = memoryview(ids.astype("<u4", copy=False).tobytes() + end)
                n = len(raw) // 4
                for s in range(0, n, length):
                    part = raw[4 * s : 4 * (s + length)]
                    cols["doc_id"].append(doc)
                    cols["start"].append(s)
                    cols["length"].append(len(part) // 4)
                    cols["doc_tokens"].append(n)
                    cols["ids_crc32"].append(zlib.crc32(part))
                    cols["ids"].append(part.tobytes() if with_ids else None)
            yield cols
            at = to

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, PIECES)


def plan(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order, how many sequences use them).

    Lengths are placed longest first into the open pack kind that is shortest
    so far and has room; what finds no room opens packs of its own. A step
    either uses up a length or a pack kind, so there are at most a few times
    ``length`` patterns whatever the counts.
    """
    kinds: dict[int, list[list]] = defaultdict(list)  # filled -> [[lengths, count]]
    for size in sorted((s for s, c in histogram.items() if c > 0), reverse=True):
        left = histogram[size]
        placed: list[tuple[int, list]] = []
        for filled in sorted(f for f in kinds if f + size <= length):
            while left and kinds[filled]:
                lengths, count = kinds[filled].pop()
                take = min(left, count)
                if take < count:
                    kinds[filled].append([lengths, count - take])
                placed.append((filled + size, [(*lengths, size), take]))
                left -= take
            if not kinds[filled]:
                del kinds[filled]
            if not left:
                break
        while left:
            # new packs, each with as many of this length as one may hold: with
            # `left` equal lengths, packs of one are refilled by the same rule
            per = max(1, length // size)
            packs, rest = divmod(left, per)
            if packs:
                placed.append((per * size, [(size,) * per, packs]))
            if rest:
                placed.append((rest * size, [(size,) * rest, 1]))
            left = 0
        for filled, kind in placed:
            kinds[filled].append(kind)
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for group in kinds.values():
        for lengths, count in group:
            merged[lengths] += count
    return sorted(merged.items(), key=lambda x: (x[0], x[1]), reverse=True)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) runs: the pieces
    of a length with ranks in the run go to consecutive sequences."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for lengths, count in patterns:
        offset = 0
        for size in lengths:
            out.append((size, used[size], used[size] + count, sequence, offset))
            used[size] += count
            offset += size
        sequence += count
    return out


def assign(stage: Stage, cut: DataFrame, length: int = 2048) -> DataFrame:
    """``cut`` (staged pieces) with ``sequence_id`` and ``offset``."""
    spark = stage.spark
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = slots(plan(histogram, length))
    # bounded by the pattern count, i.e. by `length`, not by the corpus
    table = spark.createDataFrame(runs or [(0, 0, 0, 0, 0)], "r_length long, r_from long, r_to long, r_seq long, r_offset long")
    order = [F.col("length"), F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    rank = ranked(
        stage, cut.drop("ids"), order, "ranked", group=["length"], out="rank"
    )
    return (
        rank.join(
            F.broadcast(table),
            (F.col("length") == F.col("r_length")) & (F.col("rank") >= F.col("r_from")) & (F.col("rank") < F.col("r_to")),
        )
        .withColumn("sequence_id", F.col("r_seq") + F.col("rank") - F.col("r_from"))
        .withColumn("offset", F.col("r_offset"))
        .drop("r_length", "r_from", "r_to", "r_seq", "r_offset", "rank")
    )


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences:
    doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset.

    Null or empty text packs its end id alone; rows with a null or repeated
    doc_id are documents of their own; an empty table gives no rows; extra
    columns are ignored.
    """
    stage = Stage(docs.sparkSession, "packing")
    cut = stage.write(pieces(docs, tokenizer, length, end_id, with_ids=False).drop("ids"), "pieces")
    return assign(stage, cut, length)


def sequences(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, ids (little-endian
    uint32, unpadded), doc_ids. A sequence holds at most ``length`` ids, so a
    group is bounded."""
    stage = Stage(docs.sparkSession, "packing")
    cut = stage.write(pieces(docs, tokenizer, length, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = assign(stage, cut, length).select("row", "sequence_id", "offset")
    parts = cut.select("row", "doc_id", "ids").join(placed, "row")
    item = F.struct("offset", "doc_id", "ids")
    return (
        parts.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(item)).alias("p"))
        .select(
            "sequence_id",
            F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + (F.octet_length(x.ids) / 4).cast("long")).alias("n_tokens"),
            F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x.ids)).alias("ids"),
            F.transform("p", lambda x: x.doc_id).alias("doc_ids"),
        )
    )


def op8_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from weir.llm.common import table

    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
