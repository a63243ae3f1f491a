"""Exact substring de-duplication by a distributed merge sort of suffixes.

A byte goes when a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Every such string holds the smallest hash of its
``GRAM``-byte substrings, so it is enough to sort the suffixes that start at
these *anchors*, and of them those whose gram occurs in two documents.

1. Anchors are dealt by gram hash; those of grams in several documents stay.
2. Tasks cut the suffixes (``length`` bytes from the anchor, and the bytes
   before it) of their documents, sort them into runs, and exchange the runs
   front-coded: each suffix stores the length of the prefix it shares with its
   predecessor, and the rest.
3. Runs of the same gram hash are combined by a loser tree that carries known
   common prefixes: two suffixes are compared from the first byte that is not
   known to be equal. The merged order comes with its longest common prefixes,
   which group equal strings; together with the bytes before the anchors they
   tell which strings around an anchor stand in a smaller document.
4. The removed spans are joined back to the documents.

Suffixes that agree in all bytes around the anchor are settled inside a task,
so a passage in a third of the corpus sends one suffix per task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stage, by_group, map_batches, table
from weir.llm.text import mix, slices

LENGTH = 50
GRAM = 24
NULL_ID = (1 << 63) - 1

BLOB = "docs binary, texts binary, at binary, pos binary"


# ---- anchors -------------------------------------------------------------------


def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (24) bytes at every position but the last 23."""
    n = len(buf) - GRAM + 1
    word = np.empty(len(buf) - 7, dtype=np.uint64)
    for o in range(8):
        part = buf[o : o + (len(buf) - o) // 8 * 8].view("<u8")
        word[o::8] = part[: len(word[o::8])]
    h = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += word[8 : n + 8]
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    h += word[16 : n + 16]
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(30)
    return h | np.uint64(1)


def _slide(x: np.ndarray, width: int, fn) -> np.ndarray:
    """fn-reduction of every ``width`` consecutive values."""
    out, w = x, 1
    while w * 2 <= width:
        out = fn(out[:-w], out[w:])
        w *= 2
    return fn(out[: len(out) - (width - w)], out[width - w :]) if w < width else out


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, position, gram hash) of every anchor."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    buf = np.frombuffer(b"".join(texts) + bytes(32), dtype=np.uint8)
    total = int(sizes.sum())
    none = np.empty(0, np.int64)
    if total < length:
        return none, none, none.astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)  # bytes to the end of the text
    h = gram_hashes(buf)[:total]
    h[left < GRAM] = np.iinfo(np.uint64).max
    width = length - GRAM + 1
    low = _slide(h, width, np.minimum)
    low[left[: len(low)] < length] = 0  # no string of this length starts here
    pad = np.zeros(width - 1, dtype=np.uint64)
    chosen = _slide(np.concatenate([pad, low, pad]), width, np.maximum)[:total] == h
    pos = np.flatnonzero(chosen & (left >= GRAM))
    start = np.cumsum(sizes) - sizes
    return owner[pos], pos - start[owner[pos]], h[pos]


def binary(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _cut(order: np.ndarray, key: np.ndarray, n: int) -> list[np.ndarray]:
    """Positions per key 0..n-1 (``order`` sorts by key)."""
    return np.split(order, np.searchsorted(key[order], np.arange(1, n)))


def _anchor_rows(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    def run(batch: pa.RecordBatch):
        ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = binary(batch.column(2))
        for a, b in slices(texts):
            doc, pos, h = anchors(texts[a:b], length)
            if not len(doc):
                continue
            key = (mix(h) % np.uint64(buckets)).astype(np.int64)
            rows = {k: [] for k in ("bucket", "docs", "texts", "gram", "at", "pos")}
            for bucket, part in enumerate(_cut(np.argsort(key, kind="stable"), key, buckets)):
                if len(part):
                    own, at = np.unique(doc[part], return_inverse=True)
                    rows["bucket"].append(bucket)
                    rows["docs"].append(ids[a:b][own].astype("<i8").tobytes())
                    rows["texts"].append(hashes[a:b][own].astype("<i8").tobytes())
                    rows["gram"].append(h[part].tobytes())
                    rows["at"].append(_small(at))
                    rows["pos"].append(pos[part].astype("<u4").tobytes())
            yield rows

    return map_batches(docs, run, "bucket long, docs binary, texts binary, gram binary, at binary, pos binary")


def _small(at: np.ndarray) -> bytes:
    """Numbers below 2^16 as two bytes each, else four; the first byte tells."""
    if len(at) and at.max() >> 16:
        return b"\x04" + at.astype("<u4").tobytes()
    return b"\x02" + at.astype("<u2").tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).astype(np.int64)


def _gather(t: pa.Table, *names: str) -> dict[str, np.ndarray]:
    """Concatenated document tables and, per entry, its row in them."""
    docs, texts, at = [], [], []
    base = 0
    for d, x, a in zip(t["docs"].to_pylist(), t["texts"].to_pylist(), t["at"].to_pylist()):
        d = np.frombuffer(d, "<i8")
        docs.append(d)
        texts.append(np.frombuffer(x, "<i8"))
        at.append(_large(a) + base)
        base += len(d)
    kinds = {"gram": np.uint64, "pos": "<u4", "end": "<u4"}
    out = {n: np.frombuffer(b"".join(t[n].to_pylist()), dtype=kinds[n]) for n in names}
    return {"docs": np.concatenate(docs), "texts": np.concatenate(texts), "at": np.concatenate(at), **out}


def _by_document(docs, texts, at, buckets: int, **columns: np.ndarray) -> dict:
    """Entries packed per document bucket."""
    bucket = (mix(docs.astype(np.uint64) ^ mix(texts.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64)
    key = bucket[at]
    rows: dict[str, list] = {k: [] for k in ("bucket", "docs", "texts", "at", *columns)}
    for b, part in enumerate(_cut(np.argsort(key, kind="stable"), key, buckets)):
        if len(part):
            own, new = np.unique(at[part], return_inverse=True)
            rows["bucket"].append(b)
            rows["docs"].append(docs[own].astype("<i8").tobytes())
            rows["texts"].append(texts[own].astype("<i8").tobytes())
            rows["at"].append(_small(new))
            for name, values in columns.items():
                rows[name].append(values[part].astype("<u4").tobytes())
    return rows


# ---- suffix runs ---------------------------------------------------------------


def shared_prefix(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row of bytes with the one before (0 first)."""
    out = np.zeros(len(rows), dtype=np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def front_code(rows: np.ndarray) -> tuple[bytes, bytes]:
    """(shared prefix lengths, remaining bytes) of sorted rows of equal length."""
    lcp = shared_prefix(rows)
    rest = np.arange(rows.shape[1])[None, :] >= lcp[:, None]
    return lcp.astype(np.uint8).tobytes(), rows[rest].tobytes()


def front_decode(lcps: bytes, rest: bytes, width: int) -> list[bytes]:
    out, last, at = [], b"", 0
    for l in lcps:
        to = at + width - l
        last = last[:l] + rest[at:to]
        out.append(last)
        at = to
    return out


def loser_tree_merge(runs: list[tuple[list[bytes], bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge sorted runs (keys, length of the prefix each shares with the one
    before): (run, place in the run, prefix shared with the key before) in
    merged order.

    Every loser in the tree keeps the length of the prefix it shares with the
    winner it lost to. A key that shares more with the last output is smaller;
    only keys that share equally much are compared, past the shared bytes.
    """
    k = 1
    while k < len(runs):
        k *= 2
    total = sum(len(r[0]) for r in runs)
    out_run, out_at, out_lcp = [0] * total, [0] * total, [0] * total
    keys = [r[0] for r in runs] + [[] for _ in range(k - len(runs))]
    lcps = [r[1] for r in runs] + [b""] * (k - len(runs))
    place = [0] * k
    ends = [len(x) for x in keys]
    current: list[bytes | None] = [x[0] if x else None for x in keys]
    node_run, node_lcp = [0] * k, [0] * k

    def play(a: int, la: int, b: int, lb: int) -> tuple[int, int, int, int]:
        """(winner, its prefix, loser, its prefix), prefixes known to be shared
        with the last output."""
        x, y = current[a], current[b]
        if y is None:
            return a, la, b, 0
        if x is None:
            return b, lb, a, 0
        if la > lb:
            return a, la, b, lb
        if lb > la:
            return b, lb, a, la
        s, t = x[la:], y[la:]
        if s == t:
            return a, la, b, len(x)
        u, v = int.from_bytes(s), int.from_bytes(t)
        common = la + len(s) - ((u ^ v).bit_length() + 7) // 8
        return (a, la, b, common) if u < v else (b, lb, a, common)

    def build(node: int) -> tuple[int, int]:
        if node >= k:
            return node - k, 0
        a, la = build(2 * node)
        b, lb = build(2 * node + 1)
        w, lw, node_run[node], node_lcp[node] = play(a, la, b, lb)
        return w, lw

    win, lcp = build(1)
    for n in range(total):
        out_run[n], out_at[n], out_lcp[n] = win, place[win], lcp
        p = place[win] + 1
        place[win] = p
        if p < ends[win]:
            current[win] = keys[win][p]
            lcp = lcps[win][p]
        else:
            current[win], lcp = None, 0
        node = (win + k) >> 1
        while node:
            other = node_run[node]
            y = current[other]
            if y is not None:
                x = current[win]
                lo = node_lcp[node]
                if x is None or lo > lcp:
                    node_run[node], node_lcp[node], win, lcp = win, lcp, other, lo
                elif lo == lcp:
                    s, t = x[lcp:], y[lcp:]
                    if s != t:
                        u, v = int.from_bytes(s), int.from_bytes(t)
                        common = lcp + len(s) - ((u ^ v).bit_length() + 7) // 8
                        if u < v:
                            node_lcp[node] = common
                        else:
                            node_run[node], node_lcp[node], win = win, common, other
                    else:
                        node_lcp[node] = len(x)
            node >>= 1
    return np.array(out_run), np.array(out_at), np.array(out_lcp)


def _windows(text: np.ndarray, pos: np.ndarray, before: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes before each position, nearest first; bytes from it on), zero padded."""
    padded = np.concatenate([np.zeros(before, np.uint8), text, np.zeros(length, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, before + length)
    rows = view[pos]
    return rows[:, :before][:, ::-1], rows[:, before:]


RUN = "bucket long, kind int, docs binary, texts binary, at binary, pos binary, end binary, sizes binary, lcp binary, rest binary, counts binary, left binary"


def _build_runs(length: int, buckets: int):
    before = length - GRAM

    def build(key: tuple, t: pa.Table):
        kind = t["kind"].to_numpy()
        entries = t.filter(pa.array(kind == 1))
        if not entries.num_rows:
            return []
        rows = t.filter(pa.array(kind == 0))
        texts = dict(zip(zip(rows["doc"].to_pylist(), rows["th"].to_pylist()), binary(rows["text"])))
        g = _gather(entries, "pos")
        # one table row per document, whatever number of entries name it
        pair = np.stack([g["docs"], g["texts"]], axis=1)
        pair, inverse = np.unique(pair, axis=0, return_inverse=True)
        at = inverse.ravel()[g["at"]]
        order = np.argsort(at, kind="stable")
        at, pos = at[order], g["pos"][order].astype(np.int64)
        left, right, n_left, n_right = [], [], [], []
        for (d, x), p in zip(pair.tolist(), np.split(pos, np.searchsorted(at, np.arange(1, len(pair))))):
            text = np.frombuffer(texts[(d, x)], dtype=np.uint8)
            l, r = _windows(text, p, before, length)
            left.append(l)
            right.append(r)
            n_left.append(np.minimum(p, before))
            n_right.append(np.minimum(len(text) - p, length))
        left, right = np.concatenate(left), np.concatenate(right)
        n_left, n_right = np.concatenate(n_left), np.concatenate(n_right)
        doc = pair[:, 0][at]
        # all bytes around the anchor, as far as the document has them
        whole = np.concatenate([right, left, n_left[:, None].astype(np.uint8), n_right[:, None].astype(np.uint8)], axis=1)
        order = _byte_order(whole, doc)
        same = np.zeros(len(order), dtype=bool)
        same[1:] = (whole[order][1:] == whole[order][:-1]).all(axis=1)
        group = np.cumsum(~same) - 1
        first = doc[order][~same][group]
        settled = np.zeros(len(doc), dtype=bool)
        settled[order] = doc[order] > first
        out = []
        # settled here: an equal neighbourhood stands in a smaller document
        ok = settled & (n_left + n_right >= length)
        if ok.any():
            start = pos[ok] - n_left[ok]
            end = pos[ok] + np.minimum(n_right[ok], length)
            packed = _by_document(pair[:, 0], pair[:, 1], at[ok], buckets, pos=start, end=end)
            for i in range(len(packed["bucket"])):
                out.append(_run_row(packed["bucket"][i], 1, docs=packed["docs"][i], texts=packed["texts"][i], at=packed["at"][i], pos=packed["pos"][i], end=packed["end"][i]))
        live = order[~settled[order]]  # sorted by suffix, then bytes before it
        gram = np.ascontiguousarray(right[live][:, :GRAM]).view("<u8")
        mixed = mix(gram[:, 0] + mix(gram[:, 1] + mix(gram[:, 2])))
        to = (mixed % np.uint64(buckets)).astype(np.int64)
        for b, part in enumerate(_cut(np.argsort(to, kind="stable"), to, buckets)):
            if not len(part):
                continue
            e = live[part]
            suffix = right[e]
            lcp = shared_prefix(suffix)
            distinct = np.flatnonzero(lcp < length)
            own, new = np.unique(at[e], return_inverse=True)
            codes, rest = front_code(suffix[distinct])
            out.append(
                _run_row(
                    b, 0, docs=pair[own, 0].astype("<i8").tobytes(), texts=pair[own, 1].astype("<i8").tobytes(), at=_small(new),
                    pos=pos[e].astype("<u4").tobytes(), sizes=np.stack([n_left[e], n_right[e]], axis=1).astype(np.uint8).tobytes(),
                    lcp=codes, rest=rest, counts=np.diff(np.append(distinct, len(e))).astype("<u4").tobytes(),
                    left=np.ascontiguousarray(left[e]).tobytes(),
                )
            )
        return out

    return build


def _byte_order(rows: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Order of rows of bytes, ties by ``then``."""
    n, w = rows.shape
    padded = np.zeros((n, -(-w // 8) * 8), dtype=np.uint8)
    padded[:, :w] = rows
    words = padded.view(">u8").astype(np.uint64)
    return np.lexsort((then, *[words[:, i] for i in range(words.shape[1] - 1, -1, -1)]))


def _run_row(bucket: int, kind: int, **columns: bytes) -> dict:
    names = ("docs", "texts", "at", "pos", "end", "sizes", "lcp", "rest", "counts", "left")
    return {"bucket": [bucket], "kind": [kind], **{n: [columns.get(n)] for n in names}}


def _merge_runs(length: int, buckets: int):
    before = length - GRAM

    def merge(key: tuple, t: pa.Table):
        kind = t["kind"].to_numpy()
        done = t.filter(pa.array(kind == 1))
        out = [{c: done[c] for c in ("bucket", "docs", "texts", "at", "pos", "end")}] if done.num_rows else []
        t = t.filter(pa.array(kind == 0))
        if not t.num_rows:
            return out
        g = _gather(t, "pos")
        runs = [(front_decode(l, r, length), l) for l, r in zip(t["lcp"].to_pylist(), t["rest"].to_pylist())]
        run, place, lcp = loser_tree_merge(runs)
        # entries of each distinct suffix, in merged order
        counts = [np.frombuffer(c, "<u4").astype(np.int64) for c in t["counts"].to_pylist()]
        sizes = np.array([c.sum() for c in counts])
        begin = np.cumsum(sizes) - sizes
        starts = [b + np.cumsum(c) - c for b, c in zip(begin, counts)]
        first = np.array([starts[r][p] for r, p in zip(run.tolist(), place.tolist())])
        many = np.array([counts[r][p] for r, p in zip(run.tolist(), place.tolist())])
        total = int(many.sum())
        head = np.repeat(np.arange(len(many)), many)
        entry = first[head] + np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        common = np.full(total, length)
        common[np.cumsum(many) - many] = lcp
        doc = g["docs"][g["at"]][entry]
        near = np.frombuffer(b"".join(t["left"].to_pylist()), np.uint8).reshape(-1, before)[entry]
        size = np.frombuffer(b"".join(t["sizes"].to_pylist()), np.uint8).reshape(-1, 2)[entry].astype(np.int64)
        most = np.full(total, -1)
        least = np.full(total, length)
        hashed = np.zeros(total, dtype=np.uint64)
        # the string that starts i bytes before the anchor: equal i bytes before
        # it and equal length - i bytes from it on
        for i in range(before + 1):
            if i:
                hashed = mix(hashed + near[:, i - 1] + np.uint64(i * 257))
            ok = np.flatnonzero((size[:, 0] >= i) & (size[:, 1] >= length - i))
            if not len(ok):
                continue
            group = np.cumsum(common < length - i)[ok].astype(np.uint64)
            value = mix(mix(group + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + hashed[ok])
            order = np.argsort(value, kind="stable")
            v = value[order]
            cuts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            low = np.minimum.reduceat(doc[ok][order], cuts)
            dup = np.zeros(len(ok), dtype=bool)
            dup[order] = doc[ok][order] > np.repeat(low, np.diff(np.append(cuts, len(v))))
            hit = ok[dup]
            most[hit] = np.maximum(most[hit], i)
            least[hit] = np.minimum(least[hit], i)
        hit = np.flatnonzero(most >= 0)
        if len(hit):
            pos = g["pos"].astype(np.int64)[entry[hit]]
            # all these strings hold the anchor, so they cover one span
            out.append(_by_document(g["docs"], g["texts"], g["at"][entry[hit]], buckets, pos=pos - most[hit], end=pos - least[hit] + length))
        return out

    return merge


# ---- applying ------------------------------------------------------------------


def merged_spans(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of [start, end)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    cut = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return list(zip(start[cut].tolist(), end[np.append(cut[1:], len(start)) - 1].tolist()))


def _apply(key: tuple, t: pa.Table):
    kind = t["kind"].to_numpy()
    rows = t.filter(pa.array(kind == 0))
    spans: dict[tuple[int, int], list] = {}
    entries = t.filter(pa.array(kind == 1))
    if entries.num_rows:
        g = _gather(entries, "pos", "end")
        pair = np.stack([g["docs"], g["texts"]], axis=1)
        pair, inverse = np.unique(pair, axis=0, return_inverse=True)
        at = inverse.ravel()[g["at"]]
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(1, len(pair)))
        pos, end = g["pos"][order].astype(np.int64), g["end"][order].astype(np.int64)
        for (d, x), p, e in zip(pair.tolist(), np.split(pos, cuts), np.split(end, cuts)):
            spans[(d, x)] = merged_spans(p, e)
    for d, x, text in zip(rows["doc"].to_pylist(), rows["th"].to_pylist(), binary(rows["text"])):
        own = spans.get((d, x), [])
        kept, last = [], 0
        for a, b in own:
            kept.append(text[last:a])
            last = b
        kept.append(text[last:])
        kept = b"".join(kept)
        yield {
            "doc_id": [None if d == NULL_ID else d],
            "n_bytes": [len(text)],
            "n_removed": [len(text) - len(kept)],
            "n_spans": [len(own)],
            "kept": [kept],
            "kept_sha256": [hashlib.sha256(kept).hexdigest()],
            "spans": [[x for s in own for x in s]],
        }


def substring_dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = True) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept (the remaining bytes, when ``with_text``), kept_sha256,
    spans (start, end, start, end, ... in bytes).

    Texts are their UTF-8 bytes, null is empty. Strings are judged on the
    input, overlaps count, matches never cross documents. Rows that share an
    id do not remove bytes from each other; a null id counts as larger than
    any other. An empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "substrings")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"),
        F.col("text").cast("string").alias("text"),
    )

    def repeated(key: tuple, t: pa.Table):
        g = _gather(t, "gram", "pos")
        order = np.argsort(g["gram"], kind="stable")
        gram, doc = g["gram"][order], g["docs"][g["at"]][order]
        cuts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        several = np.minimum.reduceat(doc, cuts) != np.maximum.reduceat(doc, cuts)
        keep = order[np.repeat(several, np.diff(np.append(cuts, len(gram))))]
        if not len(keep):
            return []
        return [_by_document(g["docs"], g["texts"], g["at"][keep], buckets, pos=g["pos"][keep])]

    found = stage.write(by_group(_anchor_rows(d, length, buckets), ["bucket"], repeated, f"bucket long, {BLOB}"), "anchors")
    stage.release()

    def with_documents(entries: DataFrame, end: bool) -> DataFrame:
        """Documents and packed entries of the same document bucket."""
        at = _bucket_column(buckets)
        own = d.select(at.alias("bucket"), F.lit(0).alias("kind"), "doc", "th", "text")
        return own.unionByName(entries.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    runs = by_group(with_documents(found, False), ["bucket"], _build_runs(length, buckets), RUN)
    spans = stage.write(by_group(runs, ["bucket"], _merge_runs(length, buckets), f"bucket long, {BLOB}, end binary"), "spans")
    stage.release()
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, spans array<long>"
    got = by_group(with_documents(spans, True), ["bucket"], _apply, out)
    return got if with_text else got.drop("kept")


def _bucket_column(buckets: int):
    """The document bucket of (doc, th), as ``_by_document`` deals it."""

    @F.pandas_udf("long")
    def bucket(doc, th):
        import pandas as pd

        value = mix(doc.to_numpy().astype(np.uint64) ^ mix(th.to_numpy().astype(np.uint64)))
        return pd.Series((value % np.uint64(buckets)).astype(np.int64))

    return bucket("doc", "th")


def op1_substrings(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    return substring_dedup(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
