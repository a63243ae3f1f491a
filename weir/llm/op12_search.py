"""Ranked lexical search by MaxScore with term-pair bounds.

The documents are dealt into shards as they are scanned; a shard is one row of
the index: the postings of the query log's terms, grouped by term. Nothing is
shuffled to build it, and a frequent term is spread over all shards.

For pairs of rarer terms that the log asks for together, a shard also stores
the *intersection list*: the documents that hold both, with their joint
impact. A document outside the list has at most the larger of the two single
maxima, so a pair adds at most max(joint maximum, either maximum) to a score,
where independent maxima would add their sum.

A query first takes its threshold from documents on the intersection lists.
Then, in every shard, the units of the query (pairs and left-over terms) are
ordered by bound; those whose bounds together stay below the threshold are not
essential: only documents on the other units' lists are looked at, and these
leave as soon as their score and the bounds of what is left cannot reach it.
What is cut off is provably below the result, which is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weir.llm.common import Stage, arrow_schema, struct, table, to_batch

K = 10
#: A shard is closed at this many documents with a term, or bytes of text.
SHARD_DOCS, SHARD_BYTES = 8192, 32_000_000
#: Pairs are made of terms that at most one document in this many holds.
PAIR_SHARE = 8
#: Queries are answered in blocks of at most about this many items and terms,
#: so that what a task holds of them is bounded.
BLOCK_ITEMS, BLOCK_TERMS = 20_000, 1_000_000

_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Bytes of terms as they are, A-Z lower-cased, all others a space.
_TERMS = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _KEPT else 0x20 for c in range(256))

_NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    """The terms of a text: maximal runs of ASCII letters and digits and of
    other than ASCII characters, A-Z lower-cased."""
    return text.translate(_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ratio(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that occurs ``tf`` times gives in a document of ``n`` terms,
    before its weight."""
    m = 100 - 90 + (90 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ---- index --------------------------------------------------------------------

_POSTINGS = (
    "n_docs long, n_terms long, ids array<long>, no_id array<boolean>, lens array<long>, "
    "term array<int>, cnt array<int>, post array<int>, tf array<int>"
)
_INDEX = (
    "ids array<long>, no_id array<boolean>, term array<int>, cnt array<int>, post array<int>, ratio array<int>, "
    "top array<int>, pair array<int>, pair_cnt array<int>, pair_post array<int>, joint array<long>, pair_top array<long>"
)


class _ShardBuilder:
    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.ids, self.no_id, self.lens, self.held, self.size = [], [], [], [], 0
        self.n_docs = self.n_terms = 0

    def add(self, doc_id, text: bytes) -> None:
        words = terms(text)
        self.size += len(text)
        if not words:
            return
        self.n_docs += 1
        self.n_terms += len(words)
        known = self.vocabulary
        found = [(known[w], c) for w, c in Counter(words).items() if w in known]
        if found:
            a = np.array(found, dtype=np.int64)
            self.held.append(np.column_stack([a, np.full(len(a), len(self.ids))]))
            self.ids.append(_NO_ID if doc_id is None else doc_id)
            self.no_id.append(doc_id is None)
            self.lens.append(len(words))

    @property
    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.size >= SHARD_BYTES

    def row(self) -> dict:
        a = np.concatenate(self.held) if self.held else np.empty((0, 3), dtype=np.int64)
        a = a[np.argsort(a[:, 0], kind="stable")]
        term, cnt = np.unique(a[:, 0], return_counts=True)
        out = {
            "n_docs": self.n_docs, "n_terms": self.n_terms, "ids": [self.ids], "no_id": [self.no_id], "lens": [self.lens],
            "term": [term], "cnt": [cnt], "post": [a[:, 2]], "tf": [a[:, 1]],
        }
        self.clear()
        return {k: v if isinstance(v, list) else [v] for k, v in out.items()}


def shard_rows(docs: DataFrame, id_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """One row per shard of the documents that a task scans."""
    schema = struct(_POSTINGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard = arrow_schema(schema), _ShardBuilder(vocabulary)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                b = text.as_buffer() if text.is_valid else None
                shard.add(doc_id.as_py(), b.to_pybytes() if b is not None else b"")
                if shard.full:
                    yield to_batch(shard.row(), out)
        if shard.n_docs:
            yield to_batch(shard.row(), out)

    return docs.select(F.col(id_col).cast("long"), F.col("text").cast("binary")).mapInArrow(run, schema)


@dataclass
class Query:
    """Terms (numbers in the vocabulary), their weights, and the units they
    form: pairs (places of the two terms, number of the pair) and singles."""

    terms: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray = field(default_factory=lambda: np.empty((0, 3), dtype=np.int64))
    singles: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))


def plan_pairs(items: list[list[int]], df: dict[int, int], n_docs: int) -> tuple[list[Query], np.ndarray]:
    """The queries of the log with their pairs, and the (first, second) terms
    of all pairs: within an item, the rarer terms two by two, rarest first."""
    numbers: dict[tuple[int, int], int] = {}
    queries = []
    for ids in items:
        known = sorted((i for i in ids if df.get(i, 0)), key=lambda i: (df[i], i))
        rare = sum(df[i] * PAIR_SHARE <= n_docs for i in known)
        rare -= rare % 2
        pairs = []
        for a in range(0, rare, 2):
            key = (min(known[a], known[a + 1]), max(known[a], known[a + 1]))
            pairs.append((a, a + 1, numbers.setdefault(key, len(numbers))))
        queries.append(
            Query(
                np.array(known, dtype=np.int64),
                np.array([weight(n_docs, df[i]) for i in known], dtype=np.int64),
                np.array(pairs, dtype=np.int64).reshape(-1, 3),
                np.arange(rare, len(known)),
            )
        )
    return queries, np.array(list(numbers), dtype=np.int64).reshape(-1, 2)


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the ascending ``keys``, -1 where missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Shard:
    """An index row: postings by term with ratios and their maximum, and the
    intersection lists of pairs with their joint maximum."""

    def __init__(self, row: dict):
        self.__dict__ |= row
        self.start = np.concatenate([[0], np.cumsum(self.cnt)]).astype(np.int64)
        if "pair_cnt" in row:
            self.pair_start = np.concatenate([[0], np.cumsum(self.pair_cnt)]).astype(np.int64)

    def postings(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.start[slot], self.start[slot + 1]
        return self.post[a:b], self.ratio[a:b]

    def add_pairs(self, pairs: np.ndarray, weights: dict[int, int]) -> None:
        """Intersect the lists of every pair that has documents here."""
        first, second = _lookup(self.term, pairs[:, 0]), _lookup(self.term, pairs[:, 1])
        number, posts, joints = [], [], []
        for p in np.flatnonzero((first >= 0) & (second >= 0)):
            (d1, r1), (d2, r2) = self.postings(first[p]), self.postings(second[p])
            if len(d1) > len(d2):
                d1, r1, d2, r2, w1, w2 = d2, r2, d1, r1, weights[pairs[p, 1]], weights[pairs[p, 0]]
            else:
                w1, w2 = weights[pairs[p, 0]], weights[pairs[p, 1]]
            at = _lookup(d2, d1)
            both = at >= 0
            if both.any():
                number.append(p)
                posts.append(d1[both])
                joints.append(w1 * r1[both].astype(np.int64) + w2 * r2[at[both]].astype(np.int64))
        self.pair = np.array(number, dtype=np.int64)
        self.pair_cnt = np.array([len(x) for x in posts], dtype=np.int64)
        self.pair_post = np.concatenate(posts) if posts else np.empty(0, dtype=np.int64)
        self.joint = np.concatenate(joints) if joints else np.empty(0, dtype=np.int64)
        self.pair_top = np.array([x.max() for x in joints], dtype=np.int64)
        self.pair_start = np.concatenate([[0], np.cumsum(self.pair_cnt)]).astype(np.int64)

    # ---- queries ----

    def add(self, score: np.ndarray, slot: int, w: int, among: np.ndarray) -> None:
        """Add a term's impacts to the documents ``among`` (ascending)."""
        docs, ratios = self.postings(slot)
        at = _lookup(docs, among)
        hit = at >= 0
        score[among[hit]] += w * ratios[at[hit]].astype(np.int64)

    def seeds(self, q: Query, k: int) -> np.ndarray:
        """Scores of up to ``k`` documents that are likely to score high: the
        best on the intersection lists and on the rarest term's list."""
        slot = _lookup(self.term, q.terms)
        best = np.zeros(len(self.ids), dtype=np.int64)
        for p in _lookup(self.pair, q.pairs[:, 2]):
            if p >= 0:
                a, b = self.pair_start[p], self.pair_start[p + 1]
                d = self.pair_post[a:b]
                best[d] += self.joint[a:b]
        for i in np.flatnonzero(slot >= 0)[:1]:
            docs, ratios = self.postings(slot[i])
            best[docs] = np.maximum(best[docs], q.weights[i] * ratios.astype(np.int64))
        found = np.flatnonzero(best)
        if len(found) > k:
            found = np.sort(found[np.argpartition(-best[found], k - 1)[:k]])
        score = np.zeros(len(self.ids), dtype=np.int64)
        for i in np.flatnonzero(slot >= 0):
            self.add(score, slot[i], int(q.weights[i]), found)
        return score[found]

    def search(self, q: Query, least: int) -> tuple[np.ndarray, np.ndarray]:
        """All documents that score ``least`` (> 0) or more, with their scores."""
        none = np.empty(0, dtype=np.int64)
        slot = _lookup(self.term, q.terms)
        tops = np.where(slot >= 0, q.weights * self.top[slot], 0) if len(self.top) else np.zeros(len(slot), dtype=np.int64)
        in_pair = _lookup(self.pair, q.pairs[:, 2])
        joint = np.where(in_pair >= 0, self.pair_top[in_pair], 0) if len(self.pair) else np.zeros(len(in_pair), dtype=np.int64)
        of_pairs = np.maximum(joint, np.maximum(tops[q.pairs[:, 0]], tops[q.pairs[:, 1]]))
        bounds = np.concatenate([of_pairs, tops[q.singles]]).astype(np.int64)
        order = np.argsort(bounds, kind="stable")
        upto = np.cumsum(bounds[order])
        if not len(upto) or upto[-1] < least:
            return none, none
        essential = int(np.searchsorted(upto, least))  # the units before it stay below ``least`` together
        score = np.zeros(len(self.ids), dtype=np.int64)

        def places(unit):
            return q.pairs[unit, :2] if unit < len(q.pairs) else q.singles[unit - len(q.pairs) :][:1]

        for unit in order[essential:]:
            for i in places(unit):
                if slot[i] >= 0:
                    docs, ratios = self.postings(slot[i])
                    score[docs] += q.weights[i] * ratios.astype(np.int64)
        alive = np.flatnonzero(score)
        for u in range(essential - 1, -1, -1):
            alive = alive[score[alive] + upto[u] >= least]
            if not len(alive):
                return none, none
            for i in places(order[u]):
                if slot[i] >= 0:
                    self.add(score, slot[i], int(q.weights[i]), alive)
        alive = alive[score[alive] >= least]
        return alive, score[alive]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {
                name: (v.values.to_numpy(zero_copy_only=False) if isinstance(v, pa.ListScalar) else v.as_py())
                for name, v in ((n, batch.column(n)[i]) for n in batch.schema.names)
            }


def _indexed(postings: DataFrame, pairs: np.ndarray, weights: dict[int, int], n_docs: int, n_terms: int) -> DataFrame:
    schema = struct(_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        for row in _rows(batches):
            tf, n = row["tf"].astype(np.int64), row["lens"][row["post"]]
            row["ratio"] = ratio(tf, n, n_docs, n_terms)
            s = Shard(row)
            s.top = np.maximum.reduceat(s.ratio, s.start[:-1]) if len(s.term) else s.ratio
            s.add_pairs(pairs, weights)
            yield to_batch({f.name: [getattr(s, f.name)] for f in schema}, out)

    return postings.mapInArrow(run, schema)


class Best:
    """The ``k`` best documents of a query so far, and what a document has to
    score to be among them."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.score = np.empty(0, dtype=np.int64)
        self.id = np.empty(0, dtype=np.int64)
        self.no_id = np.empty(0, dtype=bool)

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        score, ids, no_id = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.no_id, no_id])
        first = np.lexsort((no_id, ids, -score))[: self.k]
        self.score, self.id, self.no_id = score[first], ids[first], no_id[first]
        if len(first) == self.k:
            self.least = max(self.least, int(self.score[-1]))


def _best(index: DataFrame, queries: list[Query], k: int, least: list[int] | None) -> DataFrame:
    """(query, doc_id, score): the best ``k`` of every query in what each task
    reads of the index; without ``least``, scores of seed documents."""
    schema = struct("query long, doc_id long, score long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, least[i] if least else 1) for i in range(len(queries))]
        for row in _rows(batches):
            s = Shard(row)
            for q, b in zip(queries, best):
                if least is None:
                    score = s.seeds(q, k)
                    if len(score):
                        b.add(score, np.zeros(len(score), dtype=np.int64), np.zeros(len(score), dtype=bool))
                else:
                    docs, score = s.search(q, b.least)
                    if len(docs):
                        b.add(score, s.ids[docs], s.no_id[docs])
        out = arrow_schema(schema)
        for i, b in enumerate(best):
            if len(b.score):
                yield to_batch({"query": np.full(len(b.score), i), "doc_id": pa.array(b.id, mask=b.no_id), "score": b.score}, out)

    return index.mapInArrow(run, schema)


def _query_terms(queries: DataFrame, id_col: str) -> DataFrame:
    """(item, words): the distinct terms of every row."""
    schema = T.StructType([T.StructField("item", queries.schema[id_col].dataType), T.StructField("words", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        for batch in batches:
            words = [sorted(set(terms(t.as_py()))) if t.is_valid else [] for t in batch.column(1)]
            yield to_batch({"item": batch.column(0), "words": words}, out)

    return queries.select(F.col(id_col).alias("item"), F.col("text").cast("binary")).mapInArrow(run, schema)


def search(
    docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", query_id: str = "item_id"
) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for every item of ``queries``
    (by its ``text``): ``query_id``, rank (int, from 1), ``id_col``, score.

    Equal scores rank by ascending ``id_col``, null last; rows that share an
    id are documents of their own, each in the result. Rows of ``queries``
    that share an id are one item with the terms of all of them. A null or
    empty text has no terms: such a document is not counted, such an item has
    no rows; an empty table on either side gives no rows. A very long document
    is counted whole, within one task. Other columns play no part, whatever
    their names.

    Items are answered in blocks (``BLOCK_ITEMS``, ``BLOCK_TERMS``), as every
    task holds a block's terms and plans; one item's distinct terms must fit.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "search")
    asked = stage.write(_query_terms(queries, query_id), "queries").where(F.size("words") > 0)
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).alias("t")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-(size.t or 0) // BLOCK_TERMS))
    parts = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # bounded by the block
        parts.append(_search_block(stage, docs, rows, asked.schema["item"].dataType, k, id_col, b))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("item").alias(query_id), "rank", F.col("doc_id").alias(id_col), "score")


def _search_block(stage: Stage, docs: DataFrame, rows: list, item_type: T.DataType, k: int, id_col: str, block: int) -> DataFrame:
    by_item: dict = {}
    for r in rows:
        by_item.setdefault(r.item, set()).update(bytes(w) for w in r.words)
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*by_item.values())))}
    postings = stage.write(shard_rows(docs, id_col, vocabulary), f"postings-{block}")
    total = postings.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = total.n or 0, total.l or 0
    per_term = postings.select(F.explode(F.arrays_zip("term", "cnt")).alias("x")).groupBy("x.term").agg(F.sum("x.cnt").alias("df"))
    df = {r.term: r.df for r in per_term.collect()}  # at most one row a term of the block
    plans, pairs = plan_pairs([[vocabulary[w] for w in ws] for ws in by_item.values()], df, n_docs)
    weights = {t: weight(n_docs, f) for t, f in df.items()}
    index = stage.write(_indexed(postings, pairs, weights, n_docs, n_terms), f"index-{block}")
    stage.drop(f"postings-{block}")
    # the k-th best of some exact scores is a lower bound of the k-th best
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    seeds = _best(index, plans, k, None).withColumn("nth", nth).where(F.col("nth") == k)
    least = [1] * len(plans)
    for r in seeds.collect():  # at most one row an item of the block
        least[r.query] = max(1, r.score)
    found = _best(index, plans, k, least)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = T.StructType([T.StructField("q", T.LongType()), T.StructField("item", item_type)])
    items = docs.sparkSession.createDataFrame([(i, item) for i, item in enumerate(by_item)], names)
    return ranked.join(F.broadcast(items), F.col("query") == F.col("q")).select("item", "rank", "doc_id", "score")


def op12_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    return search(docs, spark.read.parquet(table(sf_dir, "benchmark")))
