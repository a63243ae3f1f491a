"""Token-id files with a minimal perfect hash index.

Format: a folder of Parquet part files, written by Spark's committer, whose
rows are *segments* in ascending document order. A segment holds

* ``payload``: the raw little-endian ids (uint16 when the vocabulary fits,
  else uint32) of a run of documents, end ids included;
* ``bounds``: first id of each document and the end of the last (int64);
* an index of its keys: the bit arrays of a minimal perfect hash
  (``mph_sizes``, ``mph_bits``), and per hash slot a 32-bit fingerprint of the
  key, the number of its first document in the segment and how many rows
  share it (``slots``).

A key is found in constant time: its range partition by the partitions' first
keys, its segment by the segments' first keys, its slot by the hash; the
fingerprint rejects keys that are not there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import Stage, arrow_schema, map_batches, struct, table, to_batch
from weir.llm.text import mix
from weir.llm.tokens import encoder

SEGMENT = (
    "part long, segment long, first_key long, last_key long, n_null long, n_docs long, n_tokens long, part_start long, "
    "width int, payload binary, bounds binary, keys binary, mph_sizes binary, mph_bits binary, slots binary"
)
#: A segment ends with the document that takes its payload to this many bytes.
SEGMENT_BYTES = 4 << 20
SLOT = np.dtype([("fingerprint", "<u4"), ("first", "<u4"), ("rows", "<u4")])


# ---- minimal perfect hash ----------------------------------------------------


def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    return mix(keys + salt) % np.uint64(size)


def build_mph(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits per level, their concatenated bits as bytes) for distinct uint64
    ``keys``: each level sets the bits that exactly one key hits, the others
    go on to the next level."""
    sizes, bits = [], []
    left = keys
    while len(left):
        size = max(8, 2 * len(left))
        at = _level(left, len(sizes), size)
        once = np.bincount(at.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        bits.append(once)
        left = left[~once[at.astype(np.int64)]]
        if len(sizes) > 200:
            raise ValueError("keys are not distinct")
    return np.array(sizes, dtype="<i8"), np.packbits(np.concatenate(bits)) if bits else np.empty(0, np.uint8)


class Mph:
    def __init__(self, sizes: bytes, bits: bytes):
        self.sizes = np.frombuffer(sizes, dtype="<i8")
        total = int(self.sizes.sum())
        self.bits = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[:total].astype(bool)
        self.rank = np.cumsum(self.bits) - self.bits

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 when no level has a bit for it (a key that was
        not indexed may also get some slot: compare the fingerprint)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + _level(keys[left], level, size).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
            if not len(left):
                break
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype("<u4")


# ---- writing -----------------------------------------------------------------


def _segment(part: int, number: int, start: int, docs: list, ids: list[np.ndarray], width: int) -> dict:
    """``docs`` ascending, nulls first (they have no key and no index entry)."""
    n_null = sum(d is None for d in docs)
    keys = np.array(docs[n_null:], dtype="<i8")
    distinct, first, rows = np.unique(keys, return_index=True, return_counts=True)
    sizes, bits = build_mph(distinct.astype(np.uint64))
    slots = np.zeros(len(distinct), dtype=SLOT)
    if len(distinct):
        at = Mph(sizes.tobytes(), bits.tobytes()).slot(distinct.astype(np.uint64))
        slots["fingerprint"][at] = fingerprint(distinct.astype(np.uint64))
        slots["first"][at], slots["rows"][at] = first + n_null, rows
    bounds = np.zeros(len(ids) + 1, dtype="<i8")
    np.cumsum([len(x) for x in ids], out=bounds[1:])
    return {
        "part": part,
        "segment": number,
        "first_key": int(keys[0]) if len(keys) else None,
        "last_key": int(keys[-1]) if len(keys) else None,
        "n_null": n_null,
        "n_docs": len(docs),
        "n_tokens": int(bounds[-1]),
        "part_start": start,
        "width": width,
        "payload": np.concatenate(ids).astype(f"<u{width}").tobytes(),
        "bounds": bounds.tobytes(),
        "keys": keys.tobytes(),
        "mph_sizes": sizes.tobytes(),
        "mph_bits": bits.tobytes(),
        "slots": slots.tobytes(),
    }


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, width: int = 2, segment_bytes: int = SEGMENT_BYTES
) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write the
    ids in ascending doc_id order (nulls first; repeated ids are kept, in the
    order of their text hashes). An empty table writes an empty folder."""
    schema = struct(SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        enc = encoder(tokenizer)
        keys: list = []
        held: list[np.ndarray] = []
        size = number = start = 0
        part = None

        def flush():
            nonlocal keys, held, size, number, start
            seg = _segment(part, number, start, keys, held, width)
            number, start = number + 1, start + seg["n_tokens"]
            keys, held, size = [], [], 0
            return to_batch({k: [v] for k, v in seg.items()}, out)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts, part = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)[0].as_py()
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars < 4_000_000):
                    chars += len(texts[to] or "")
                    to += 1
                for key, x in zip(ids[at:to], enc.batch([t or "" for t in texts[at:to]])):
                    if len(x) and int(x.max()) >> (8 * width):
                        raise ValueError(f"an id does not fit in {width} bytes")
                    keys.append(key)
                    held.append(np.append(x, np.uint32(end_id)))
                    size += (len(x) + 1) * width
                    if size >= segment_bytes:
                        yield flush()
                at = to
        if keys:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .withColumn("part", F.spark_partition_id().cast("long"))
    )
    ordered.mapInArrow(run, schema).write.mode("overwrite").parquet(path)


# ---- reading -----------------------------------------------------------------


def _with_starts(segments: DataFrame) -> DataFrame:
    """Segments with ``base``, the number of ids before their range partition:
    a running sum over one row per partition."""
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return segments.join(bases, F.col("part") == F.col("b_part")).drop("b_part")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files, each found through its segment's index:
    doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            payload = np.frombuffer(row["payload"], dtype=f"<u{row['width']}").astype("<u4")
            bounds = np.frombuffer(row["bounds"], dtype="<i8")
            keys = np.frombuffer(row["keys"], dtype="<i8")
            docs: list = [None] * row["n_null"]
            at = list(range(row["n_null"]))
            distinct = np.unique(keys)
            for key, first, n in zip(distinct.tolist(), *_look_up(row, distinct)):
                docs += [key] * n
                at += range(first, first + n)
            if at != list(range(row["n_docs"])):
                raise ValueError(f"index and payload disagree in segment {row['part']}/{row['segment']}")
            cuts = bounds.tolist()
            yield {
                "doc_id": docs,
                "start": [row["base"] + row["part_start"] + cuts[i] for i in at],
                "n_tokens": [cuts[i + 1] - cuts[i] for i in at],
                "ids_crc32": [zlib.crc32(payload[cuts[i] : cuts[i + 1]].tobytes()) for i in at],
            }

    segments = _with_starts(spark.read.schema(struct(SEGMENT)).parquet(path))
    return map_batches(segments, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _look_up(row: dict, keys: np.ndarray) -> tuple[list[int], list[int]]:
    """(first document, rows) of each key in a segment; rows 0 when absent."""
    slots = np.frombuffer(row["slots"], dtype=SLOT)
    k = keys.astype(np.uint64)
    at = Mph(row["mph_sizes"], row["mph_bits"]).slot(k)
    known = at >= 0
    known[known] = slots["fingerprint"][at[known]] == fingerprint(k[known])
    first = np.where(known, slots["first"][at] if len(slots) else 0, 0)
    rows = np.where(known, slots["rows"][at] if len(slots) else 0, 0)
    return first.tolist(), rows.tolist()


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Rows (doc_id, ids: little-endian uint32) for the keys in column
    ``doc_id`` of ``keys`` that the files hold; unknown and null keys give none.

    The partitions' first keys (one per range partition) place a key in its
    partition; a join on it finds the segments, and only segments that a key
    may lie in are read."""
    seg = spark.read.schema(struct(SEGMENT)).parquet(path)
    heads = [
        (r.part, r.k)
        for r in seg.where("first_key is not null").groupBy("part").agg(F.min("first_key").alias("k")).orderBy("k").collect()
    ]
    asked = keys.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("key")).distinct()
    if not heads:
        return asked.where("false").select(F.col("key").alias("doc_id"), F.lit(b"").alias("ids"))
    starts = F.array(*[F.lit(k).cast("long") for _, k in heads])
    parts = F.array(*[F.lit(p).cast("long") for p, _ in heads])
    number = F.size(F.filter(starts, lambda s: s <= F.col("key")))
    asked = asked.withColumn("part", F.get(parts, F.greatest(number - 1, F.lit(0))))
    directory = seg.select("part", "segment", "first_key", "last_key")
    # repeated rows of one id may run on into the next segments
    placed = asked.join(directory, "part").where("key between first_key and last_key")
    wanted = placed.groupBy("part", "segment").agg(F.collect_list("key").alias("asked"))
    hits = wanted.join(seg, ["part", "segment"])

    def read(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            payload = np.frombuffer(row["payload"], dtype=f"<u{row['width']}").astype("<u4")
            cuts = np.frombuffer(row["bounds"], dtype="<i8").tolist()
            ask = np.array(row["asked"], dtype=np.int64)
            found = [
                (key, payload[cuts[i] : cuts[i + 1]].tobytes())
                for key, first, n in zip(ask.tolist(), *_look_up(row, ask))
                for i in range(first, first + n)
            ]
            yield {"doc_id": [f[0] for f in found], "ids": [f[1] for f in found]}

    return map_batches(hits, read, "doc_id long, ids binary")


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    path = f"{Stage(spark, 'token-files').root}/files"
    write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return scan(spark, path)
