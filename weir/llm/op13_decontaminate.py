"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton accepts every run of words that occurs in a test item. The words
of a document are streamed through it; after each word the state stands for
the longest run, ending there, that some item holds, and its length is known.
Where the length reaches the window length, the last words are a window of the
items that the state belongs to; shorter items are whole windows, found on the
suffix links of the state. Windows mark the words they cover; the runs of
marked words are the spans to remove, and a document of which too large a
share is covered goes as a whole.

A word that no item has puts the automaton back to its start, and after two
words that stand together in no item at most one word is matched. Stretches
between such places that are shorter than the shortest window are therefore
not streamed; all others are.

Documents are scanned once, in place: nothing is shuffled, and a task holds
one document and the automaton of a block of items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stage, arrow_schema, struct, table, to_batch

WINDOW = 10
#: A document goes when more than this share of its words is covered.
MAX_COVERAGE = 0.5
#: Words of the items of one automaton, about; more items make more automata,
#: each of them streamed over the documents in a pass of its own.
BLOCK_WORDS = 500_000

_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Bytes of words as they are, A-Z lower-cased, all others a space.
_WORDS = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _KEPT else 0x20 for c in range(256))
_WORD = re.compile(rb"[^\x20]+")


def words(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of other than ASCII
    characters, A-Z lower-cased."""
    return text.translate(_WORDS).split()


def word_spans(text: bytes) -> np.ndarray:
    """(from, to) bytes of every word of ``words``."""
    return np.array([m.span() for m in _WORD.finditer(text.translate(_WORDS))], dtype=np.int64).reshape(-1, 2)


class SuffixAutomaton:
    """All runs of words of the ``items`` (id -> words), with the items of
    every window.

    Built word by word: a state stands for runs that end at the same places
    of the items; ``link`` leads to the longest suffix that ends at more.
    """

    def __init__(self, items: dict[str, list[bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names = list(items)
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws] for ws in items.values()]
        for seq in coded:
            state = 0
            for w in seq:
                state = self._extend(state, w)
        self.shortest = min((min(len(s), window) for s in coded if s), default=0)
        # the state of a run's last ``window`` words: the first on the way to
        # the start whose link is shorter than the window
        self.full = [-1] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.length[v] >= window:
                up = self.link[v]
                self.full[v] = v if self.length[up] < window else self.full[up]
        owners: dict[int, set[int]] = {}
        whole: dict[int, dict[int, set[int]]] = {}
        for n, seq in enumerate(coded):
            state = 0
            for i, w in enumerate(seq, 1):
                state = self.next[state][w]
                if i >= window:
                    owners.setdefault(self.full[state], set()).add(n)
            if 0 < len(seq) < window:
                whole.setdefault(state, {}).setdefault(len(seq), set()).add(n)
        self.owners = {s: tuple(o) for s, o in owners.items()}
        # short items on the way from a state to the start: (length, items)
        self.short: list[tuple] = [()] * len(self.link)
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            own = tuple((k, tuple(o)) for k, o in sorted(whole.get(v, {}).items(), reverse=True))
            self.short[v] = own + self.short[self.link[v]]
        size = len(self.vocabulary)
        together = {a * size + b for seq in coded for a, b in zip(seq, seq[1:])}
        self.together = np.array(sorted(together), dtype=np.int64)

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(follow)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the runs of ``q`` that end after ``p`` and ``w``."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:  # an earlier item has this run already
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def stretches(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """(from, to) of the stretches that may hold a window."""
        n = len(codes)
        if not n or not self.shortest:
            return []
        joined = (codes[:-1] >= 0) & (codes[1:] >= 0)
        if len(self.together):
            pair = codes[:-1] * len(self.vocabulary) + codes[1:]
            at = np.minimum(np.searchsorted(self.together, pair), len(self.together) - 1)
            joined &= self.together[at] == pair
        else:
            joined[:] = False
        cuts = np.flatnonzero(~joined) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [n]])
        long = (last - first >= self.shortest) & (codes[first] >= 0)
        return list(zip(first[long].tolist(), last[long].tolist()))

    def match(self, codes: np.ndarray) -> tuple[np.ndarray, set[int], int]:
        """Streams a document: whether each word is inside a window, the items
        with a window in it, and the longest matched run."""
        n = len(codes)
        marks = np.zeros(n + 1, dtype=np.int64)
        found, longest, window = set(), 0, self.window
        follow, link, length, full, short = self.next, self.link, self.length, self.full, self.short
        seen = set()
        for a, b in self.stretches(codes):
            state = size = 0
            for i, w in enumerate(codes[a:b].tolist(), a + 1):
                step = follow[state].get(w)
                while step is None and state:
                    state = link[state]
                    size = length[state]
                    step = follow[state].get(w)
                if step is None:
                    size = 0
                    continue
                state, size = step, size + 1
                if size > longest:
                    longest = size
                if size >= window:
                    marks[i - window] += 1
                    marks[i] -= 1
                    if full[state] not in seen:
                        seen.add(full[state])
                        found.update(self.owners[full[state]])
                if short[state]:
                    for k, items in short[state]:
                        if k <= size:
                            marks[i - k] += 1
                            marks[i] -= 1
                            found.update(items)
        return np.cumsum(marks[:n]) > 0, found, longest

    def codes(self, ws: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, -1) for w in ws), dtype=np.int64, count=len(ws))


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of marked words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_MATCHES = "row long, n_words long, longest long, spans array<struct<first: long, last: long>>, items array<string>"


def _matches(docs: DataFrame, automaton: SuffixAutomaton) -> DataFrame:
    """Per row (``row``, ``text``) with a window: runs of covered words and items."""
    schema = struct(_MATCHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        for batch in batches:
            cols: dict = {f.name: [] for f in schema}
            for row, text in zip(batch.column(0), batch.column(1)):
                ws = words(text.as_buffer().to_pybytes()) if text.is_valid else []
                hit, found, longest = automaton.match(automaton.codes(ws))
                cols["row"].append(row.as_py())
                cols["n_words"].append(len(ws))
                cols["longest"].append(longest)
                cols["spans"].append([{"first": a, "last": b} for a, b in runs(hit)])
                cols["items"].append([automaton.names[i] for i in found])
            yield to_batch(cols, out)

    return docs.select("row", F.col("text").cast("binary")).mapInArrow(run, schema)


def _automata(items: DataFrame, item_col: str, window: int) -> Iterator[SuffixAutomaton]:
    """Automata of blocks of the items, one at a time."""
    key = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    named = items.select(key.alias("id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (BLOCK_WORDS * 6)))
    for b in range(blocks):
        part: dict = {}
        # bounded by the block; a single item must fit into one
        for i, r in enumerate(named.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct().collect()):
            part[(r.id, i)] = words(bytes(r.text))
        automaton = SuffixAutomaton({k: ws for k, ws in sorted(part.items()) if ws}, window)
        automaton.names = [n[0] for n in automaton.names]
        yield automaton


def _union(spans):
    """Spans of several passes, joined where they meet: ordered by start, each
    either extends the last one or follows it."""
    span = "struct<first: bigint, last: bigint>"

    def add(acc, x):
        top = F.element_at(acc, -1)
        meets = (F.size(acc) > 0) & (F.when(F.size(acc) > 0, top.last) >= x.first)
        longer = F.struct(top.first.alias("first"), F.greatest(top.last, x.last).alias("last"))
        return F.when(meets, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))).otherwise(
            F.concat(acc, F.array(x))
        )

    return F.aggregate(F.array_sort(spans), F.array().cast(f"array<{span}>"), add)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    item_col: str = "item_id",
    clean: bool = True,
) -> DataFrame:
    """``docs`` (with doc_id and text) with n_words, n_hit (words inside a
    window), longest (longest run of words, in one stretch, that an item
    holds too; runs shorter than any window may count as 0), spans (first
    and last, exclusive, word of every covered run), items (ids of items with
    a window in the text, ascending, as text), contaminated (n_hit > 0), and,
    with ``clean``, cleaned: the text without the covered words and what
    stands between them, or null where more than ``max_coverage`` of the words
    is covered. These names replace columns of the same name; others pass
    through.

    A null or empty text has no words and is clean; its cleaned text is itself.
    Items without a word are no windows; rows that share an item id count as
    that item, a null id is the empty id. Repeated rows of ``docs`` stay as
    they are, each with the same result. An empty table on either side gives
    no rows, or no windows. Texts of any length are streamed whole.
    """
    if window < 1:
        raise ValueError("window must be positive")
    automata = _automata(items, item_col, window)
    first, second = next(automata), next(automata, None)
    added = ["n_words", "n_hit", "longest", "spans", "items", "contaminated", *(["cleaned"] if clean else [])]
    cols = [c for c in docs.columns if c not in added]
    if second is None:
        return _in_place(docs.select(*cols), cols, first, max_coverage, clean)
    # several automata: a pass each, their results united by row
    stage = Stage(docs.sparkSession, "decontaminate")
    number = F.monotonically_increasing_id().alias("row")
    rows = stage.write(docs.select(number, F.struct(*cols).alias("doc")), "rows")
    passes = 0
    for automaton in chain((first, second), automata):
        stage.write(_matches(rows.select("row", "doc.text"), automaton), f"pass-{passes}")
        passes += 1
    found = docs.sparkSession.read.schema(struct(_MATCHES)).parquet(*[f"{stage.root}/pass-{i}" for i in range(passes)])
    # a row has one entry a pass
    per_row = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.max("longest").alias("longest"),
        _union(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x.last - x.first)
    out = rows.join(per_row, "row").withColumn("n_hit", covered).withColumn("contaminated", F.col("n_hit") > 0)
    if clean:
        out = out.withColumn("cleaned", _cleaned_udf(max_coverage)("doc.text", "spans", "n_words", "n_hit"))
    return out.select(*[F.col("doc").getField(c).alias(c) for c in cols], *added)


def cleaned(text: bytes, spans: list[tuple[int, int]], n_words: int, n_hit: int, max_coverage: float) -> bytes | None:
    """``text`` without the words of ``spans`` and what stands between them;
    none where they are more than the permitted share."""
    if n_hit > max_coverage * n_words:
        return None
    if not spans:
        return text
    at, keep, pos = word_spans(text), [], 0
    for a, b in spans:
        keep.append(text[pos : at[a, 0]])
        pos = at[b - 1, 1]
    keep.append(text[pos:])
    return b"".join(keep)


def _cleaned_udf(max_coverage: float):
    @F.pandas_udf("string")
    def fn(text: pd.Series, spans: pd.Series, n_words: pd.Series, n_hit: pd.Series) -> pd.Series:
        out = []
        for t, s, n, h in zip(text, spans, n_words, n_hit):
            c = None if t is None else cleaned(t.encode(), [(x["first"], x["last"]) for x in s], n, h, max_coverage)
            out.append(None if c is None else c.decode())
        return pd.Series(out, dtype=object)

    return fn


def _in_place(docs: DataFrame, cols: list[str], automaton: SuffixAutomaton, max_coverage: float, clean: bool) -> DataFrame:
    """The scan with one automaton: every row gets its result where it is."""
    extra = struct(
        "n_words long, n_hit long, longest long, spans array<struct<first: long, last: long>>, items array<string>, contaminated boolean"
        + (", cleaned string" if clean else "")
    )
    schema = docs.schema
    full = type(schema)([*schema.fields, *extra.fields])
    at = cols.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(full)
        for batch in batches:
            new: dict = {f.name: [] for f in extra}
            for text in batch.column(at).cast(pa.binary()):
                b = text.as_buffer().to_pybytes() if text.is_valid else None
                ws = words(b) if b else []
                hit, found, longest = automaton.match(automaton.codes(ws))
                n_hit, spans = int(hit.sum()), runs(hit)
                new["n_words"].append(len(ws))
                new["n_hit"].append(n_hit)
                new["longest"].append(longest)
                new["spans"].append([{"first": a, "last": z} for a, z in spans])
                new["items"].append(sorted({automaton.names[i] for i in found}))
                new["contaminated"].append(n_hit > 0)
                if clean:
                    c = None if b is None else cleaned(b, spans, len(ws), n_hit, max_coverage)
                    new["cleaned"].append(None if c is None else c.decode())
            kept = dict(zip(cols, batch.columns))
            yield to_batch(kept | new, out)

    return docs.mapInArrow(run, full)


def op13_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    items = spark.read.parquet(table(sf_dir, "benchmark"))
    return decontaminate(docs, items, clean=False).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
