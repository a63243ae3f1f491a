"""Exact n-gram Jaccard join as a metric-space join.

Jaccard distance is a metric on shingle sets. Documents with equal sets are
one point. For a threshold t, two sets that link share a shingle among their
``|x| - ceil(t |x|) + 1`` first ones in any common order (here: shingles that
many documents hold come last). The smallest point that has a shingle in this
prefix is its *pivot*; a point belongs to the regions of all pivots it shares
a prefix shingle with, so every linking pair meets in a region.

Regions are joined in two rounds. The first has only the prefixes: points
without a partner whose shared prefix leaves a link possible drop out. The
second has whole sets and joins recursively: a region is split into Voronoi
cells around pivots of its own, a point within twice the radius of a cell's
boundary is replicated into it, and distances to the pivots exclude pairs by
the triangle inequality before any pair is verified. A pair that meets in
several regions is counted in the smallest common one. Regions of unbounded
size (a third of the corpus may be near copies) are first dealt into pairs of
blocks of bounded size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import Stage, by_group, components, map_batches, table
from weir.llm.text import mix, shingle_sets, slices

#: Links hold when 100 * intersection >= PERCENT * union.
PERCENT = 75
SHINGLE = 5
#: Points and shingles of a region block, about; a task joins two blocks at a time.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
#: Cells of at most this many points are verified pair by pair.
LEAF = 64
#: A shingle is common when this share of the documents holds it (at least
#: COMMON_LEAST of them). The order of shingles affects speed, never results.
COMMON_SHARE = 0.001
COMMON_LEAST = 64


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def common_shingles(docs: DataFrame, n_docs: int) -> np.ndarray:
    """Sorted hashes of the shingles that at least ``COMMON_SHARE`` of the
    documents hold, as far as single tasks notice them: each batch reports the
    shingles that are frequent in it. At most ``1 / COMMON_SHARE`` times the
    mean set size of them exist, whatever the corpus."""
    least = max(COMMON_LEAST, int(n_docs * COMMON_SHARE))

    def count(batch: pa.RecordBatch):
        texts = _texts(batch, 0)
        for a, b in slices(texts):
            s, n = np.unique(shingle_sets(texts[a:b], SHINGLE)[0], return_counts=True)
            hot = n >= max(3, int((b - a) * COMMON_SHARE / 2))
            yield {"s": s[hot].view(np.int64), "n": n[hot]}

    local = map_batches(docs.select(F.col("text").cast("string").alias("text")), count, "s long, n long")
    rows = local.groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("s").toPandas()
    return np.sort(rows["s"].to_numpy(dtype=np.int64).view(np.uint64))


def prefixes(s: np.ndarray, n: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n - ceil(t n) + 1`` shingles of each set, common ones last,
    else by hash: (the shingles of all prefixes, how many each has). ``s`` holds
    the sorted sets one after another, ``n`` their sizes."""
    least = np.where(n > 0, n - (PERCENT * n + 99) // 100 + 1, 0)
    is_common = np.zeros(len(s), dtype=bool)
    if len(common):
        # few of the shingles have the leading bits of a common one
        marks = np.zeros(1 << 16, dtype=bool)
        marks[common >> np.uint64(48)] = True
        i = np.flatnonzero(marks[s >> np.uint64(48)])
        at = np.searchsorted(common, s[i])
        at[at == len(common)] = 0
        is_common[i] = common[at] == s[i]
    # a shingle's place among those of its set that are common, or are not
    ends = np.cumsum(n)
    upto = np.concatenate([[0], np.cumsum(is_common)])
    before = upto[ends - n]
    rare = n - (upto[ends] - before)
    within = upto[:-1] - np.repeat(before, n)
    place = np.where(is_common, within + np.repeat(rare, n), np.arange(len(s)) - np.repeat(ends - n, n) - within)
    return s[place < np.repeat(least, n)], least


def sketches(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """doc_id, row, th (text hash), n (set size), g1, g2 (128-bit set hash), prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batch: pa.RecordBatch):
        texts = _texts(batch, 1)
        for a, b in slices(texts):
            yield sketch(batch.slice(a, b - a), texts[a:b])

    def sketch(batch: pa.RecordBatch, texts: list[bytes]) -> dict:
        s, n = shingle_sets(texts, SHINGLE)
        some = n > 0
        first = (np.cumsum(n) - n)[some]
        # order-free sums of two independent mixes identify the set
        sums = np.zeros((2, len(n)), dtype=np.uint64)
        if len(s):
            for k, x in enumerate((s, s ^ np.uint64(0xA5A5A5A5A5A5A5A5))):
                sums[k, some] = np.add.reduceat(mix(x), first)
        flat, sizes = prefixes(s, n, shared.value)
        return {
            "doc_id": batch.column(0),
            "th": batch.column(2),
            "n": n.astype(np.int64),
            "g1": sums[0].view(np.int64),
            "g2": sums[1].view(np.int64),
            "prefix": _lists(flat.view(np.int64), sizes),
        }

    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("th")
    )
    return map_batches(d, run, "doc_id long, th long, n long, g1 long, g2 long, prefix array<long>").withColumn(
        "row", F.monotonically_increasing_id()
    )


# ---- joining inside a task ---------------------------------------------------


class Incidence:
    """Points of a task as rows of a 0/1 matrix over the shingles that at least
    two of them hold, kept sparse. Overlaps are products of dense column slices
    for shingles that many of the points hold; those of the others are counted
    pair by pair, so that a region costs as much as its points share."""

    WIDTH = 2048
    #: A pair that is counted takes as long as so many cells of a dense product.
    CELLS = 200
    #: Pairs that are counted at once.
    TOGETHER = 1 << 21

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        _, col, n = np.unique(flat, return_inverse=True, return_counts=True)
        shared = n > 1
        held = shared[col]
        self.cols = (np.cumsum(shared) - 1)[col[held]]
        self.total = int(shared.sum())
        self.at = np.concatenate([[0], np.cumsum(held)])[offsets]

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, shingle) of all entries of these rows."""
        size = self.at[rows + 1] - self.at[rows]
        place = np.repeat(np.arange(len(rows)), size)
        return place, self.cols[np.repeat(self.at[rows] - (np.cumsum(size) - size), size) + np.arange(len(place))]

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """|x ∩ y| for x in rows ``a``, y in rows ``b``."""
        out = np.zeros((len(a), len(b)), dtype=np.float32)
        if not self.total or not out.size:
            return out
        (ra, ca), (rb, cb) = self._entries(a), self._entries(b)
        na, nb = np.bincount(ca, minlength=self.total), np.bincount(cb, minlength=self.total)
        pairs = na * nb
        heavy = pairs * self.CELLS > out.size
        number = np.cumsum(heavy) - 1
        in_a, in_b = heavy[ca], heavy[cb]
        xr, xc, yr, yc = ra[in_a], number[ca[in_a]], rb[in_b], number[cb[in_b]]
        columns = int(number[-1]) + 1
        for c in range(0, columns, self.WIDTH):
            width = min(self.WIDTH, columns - c)
            x = np.zeros((len(a), width), dtype=np.float32)
            y = np.zeros((len(b), width), dtype=np.float32)
            i, j = (xc >= c) & (xc < c + width), (yc >= c) & (yc < c + width)
            x[xr[i], xc[i] - c] = 1
            y[yr[j], yc[j] - c] = 1
            out += x @ y.T
        light = (pairs > 0) & ~heavy
        if light.any():
            in_a, in_b = light[ca], light[cb]
            ra, ca, rb, cb = ra[in_a], ca[in_a], rb[in_b], cb[in_b]
            rb = rb[np.argsort(cb, kind="stable")]
            size = nb[ca]
            start = (np.cumsum(np.where(light, nb, 0)) - nb)[ca]
            upto = np.cumsum(size)
            cuts = np.searchsorted(upto, np.arange(self.TOGETHER, upto[-1] + self.TOGETHER, self.TOGETHER), side="right").tolist()
            for lo, hi in zip([0, *cuts[:-1]], [*cuts[:-1], len(ca)]):
                many = size[lo:hi]
                own = np.repeat(start[lo:hi] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                cell = np.repeat(ra[lo:hi] * len(b), many) + rb[own]
                out += np.bincount(cell, minlength=out.size).reshape(out.shape)
        return out


def metric_join(inc: Incidence, n: np.ndarray, eps: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j) of points within distance ``eps``, each once."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def links(a: np.ndarray, b: np.ndarray, mask: np.ndarray | None) -> None:
        inter = inc.overlap(a, b).astype(np.int64)
        ok = 100 * inter >= PERCENT * (n[a][:, None] + n[b][None, :] - inter)
        ok &= mask if mask is not None else a[:, None] < b[None, :]
        i, j = np.nonzero(ok)
        if len(i):
            found.append((a[i], b[j]))

    def distances(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        inter = inc.overlap(a, pivots)
        return 1.0 - inter / (n[a][:, None] + n[pivots][None, :] - inter)

    def join(points: np.ndarray) -> None:
        if len(points) <= LEAF:
            links(points, points, None)
            return
        k = min(8, len(points) // 16)
        pivots = points[:: max(1, len(points) // k)][:k]
        d = distances(points, pivots)
        home = d.argmin(axis=1)
        near = d[np.arange(len(points)), home]
        # points at distance 1 from all pivots are a cell of their own: only
        # points whose nearest pivot is at least 1 - eps away can link with it
        far = near >= 1.0
        home = np.where(far, len(pivots), home)
        sizes = np.bincount(home, minlength=len(pivots) + 1)
        if sizes.max() > 0.9 * len(points):
            for s in range(0, len(points), LEAF * 4):
                a = points[s : s + LEAF * 4]
                links(a, a, None)
                if s + LEAF * 4 < len(points):
                    rest = points[s + LEAF * 4 :]
                    links(a, rest, np.ones((len(a), len(rest)), dtype=bool))
            return
        slack = 2 * eps + 1e-6
        for c in range(len(pivots) + 1):
            core = home == c
            if not core.any():
                continue
            join(points[core])
            # boundary points of later cells, replicated into this one; the far
            # cell (distance 1 from every pivot) is excluded below, by the
            # triangle inequality, from points nearer than 1 - eps to a pivot
            window = home > c
            window &= far | (d[:, min(c, len(pivots) - 1)] <= near + slack)
            if not window.any():
                continue
            a, b = np.flatnonzero(core), np.flatnonzero(window)
            # triangle inequality on every pivot
            mask = np.ones((len(a), len(b)), dtype=bool)
            for p in range(len(pivots)):
                mask &= np.abs(d[a, p][:, None] - d[b, p][None, :]) <= eps + 1e-6
            keep_a, keep_b = mask.any(axis=1), mask.any(axis=0)
            if keep_a.any():
                links(points[a[keep_a]], points[b[keep_b]], mask[np.ix_(keep_a, keep_b)])

    join(np.arange(len(n)))
    return found


def _flat(column: pa.ChunkedArray | pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = a.chunk(0) if a.num_chunks == 1 else pa.concat_arrays(a.chunks)
    offsets = a.offsets.to_numpy()
    flat = a.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return flat, offsets - offsets[0]


class Earlier:
    """Whether points of a region meet in a smaller one, too. Each point's
    ``regions`` are sorted."""

    def __init__(self, regions: pa.ChunkedArray, region: int):
        flat, at = _flat(regions)
        smaller = flat < region
        self.inc = Incidence(flat[smaller], np.concatenate([[0], np.cumsum(smaller)])[at])

    def meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.inc.overlap(a, b) > 0


def _possible(key: tuple, t: pa.Table):
    """Points of a block pair that a partner may link with that meets them in no
    smaller region, judged by their prefixes: shared prefix plus everything after
    the longer rest."""
    n = t["n"].to_numpy()
    earlier = Earlier(t["regions"], key[0])
    inc = Incidence(*_flat(t["shared"]))
    rest = (PERCENT * n + 99) // 100 - 1  # shingles behind the prefix
    block = t["block"].to_numpy()
    rows = np.arange(len(n))
    keep = np.zeros(len(n), dtype=bool)
    for s in range(0, len(n), 256):
        a = rows[s : s + 256]
        c = inc.overlap(a, rows)
        most = c + np.maximum(rest[a][:, None], rest[None, :])
        most = np.minimum(most, np.minimum(n[a][:, None], n[None, :]))
        ok = (100 + PERCENT) * most >= PERCENT * (n[a][:, None] + n[None, :])
        ok &= (c > 0) & (a[:, None] != rows[None, :])
        if key[1] != key[2]:
            ok &= block[a][:, None] != block[None, :]
        if ok.any():
            ok &= ~earlier.meet(a, rows)
        keep[a] |= ok.any(axis=1)
    if not keep.any():
        return []
    m = int(keep.sum())
    return [{"region": [key[0]] * m, "b1": [key[1]] * m, "b2": [key[2]] * m, "point": t["point"].to_numpy()[keep], "block": block[keep], "regions": t["regions"].filter(pa.array(keep))}]


def _links(key: tuple, t: pa.Table):
    """Per point of a block pair: links counted here (weighted by copies) and
    the smallest point it is connected with here."""
    n = t["n"].to_numpy()
    point, copies, block = t["point"].to_numpy(), t["copies"].to_numpy(), t["block"].to_numpy()
    flat, offsets = _flat(t["shingles"])
    pairs = metric_join(Incidence(flat.view(np.uint64), offsets), n, 1 - PERCENT / 100)
    if not pairs:
        return []
    i, j = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    if key[1] != key[2]:
        across = block[i] != block[j]
        i, j = i[across], j[across]
    if not len(i):
        return []
    # the pair is counted here if this is its smallest common region
    mine = np.ones(len(i), dtype=bool)
    earlier, rows = Earlier(t["regions"], key[0]), np.arange(len(n))
    for a in range(0, len(n), 256):
        x = np.flatnonzero((i >= a) & (i < a + 256))
        if len(x):
            mine[x] = ~earlier.meet(rows[a : a + 256], rows)[i[x] - a, j[x]]
    links = np.bincount(i[mine], weights=copies[j[mine]], minlength=len(n)) + np.bincount(
        j[mine], weights=copies[i[mine]], minlength=len(n)
    )
    low = point.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        if (new == low).all():
            break
        low = new
    linked = np.zeros(len(n), dtype=bool)
    linked[i], linked[j] = True, True
    return [{"point": point[linked], "low": low[linked], "links": links[linked].astype(np.int64)}]


# ---- the join ------------------------------------------------------------------

#: Prefix shingles, or shared ones, that a bucket holds, about.
ENTRIES = 1 << 17
#: Rows that exchange packed (point, shingle[, region]) entries.
PACKED = "bucket long, n long, data binary"


def _packed(key: np.ndarray, buckets: int, *columns: np.ndarray) -> dict:
    """The entries of each bucket in one row, their columns one after another."""
    bucket = (mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=buckets)
    columns = [c[order] for c in columns]
    some = np.flatnonzero(size)
    ends = np.cumsum(size)
    return {
        "bucket": some,
        "n": size[some],
        "data": [b"".join(c[ends[b] - size[b] : ends[b]].tobytes() for c in columns) for b in some.tolist()],
    }


def _unpacked(t: pa.Table, columns: int) -> list[np.ndarray]:
    parts = [np.frombuffer(x, dtype=np.int64).reshape(columns, -1) for x in t["data"].to_pylist()]
    return list(np.concatenate(parts, axis=1))


def _met(reps: DataFrame) -> DataFrame:
    """point, shared (the shingles of its prefix that several points hold in
    theirs), regions (the pivots of these), for points that have any."""
    # a task holds one bucket at a time
    entries = reps.agg(F.sum(F.size("prefix"))).first()[0] or 0
    buckets = max(16, entries // ENTRIES)
    # fewer hold the points, as few of the shingles are shared
    point_buckets = max(16, buckets // 8)

    def deal(batch: pa.RecordBatch):
        s, at = _flat(batch.column(1))
        yield _packed(s, buckets, np.repeat(batch.column(0).to_numpy(), np.diff(at)), s)

    def share(key: tuple, t: pa.Table):
        point, s = _unpacked(t, 2)
        order = np.argsort(s)
        point, s = point[order], s[order]
        starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        sizes = np.diff(np.append(starts, len(s)))
        low, high = np.minimum.reduceat(point, starts), np.maximum.reduceat(point, starts)
        several = np.repeat(low != high, sizes)
        if several.any():
            point = point[several]
            yield _packed(point, point_buckets, point, s[several], np.repeat(low, sizes)[several])

    def gather(key: tuple, t: pa.Table):
        point, s, region = _unpacked(t, 3)
        order = np.lexsort((region, point))
        point, s, region = point[order], s[order], region[order]
        starts = np.flatnonzero(np.concatenate([[True], point[1:] != point[:-1]]))
        head = np.concatenate([[True], region[1:] != region[:-1]])
        head[starts] = True
        yield {
            "point": point[starts],
            "shared": _lists(s, np.diff(np.append(starts, len(s)))),
            "regions": _lists(region[head], np.add.reduceat(head, starts, dtype=np.int64)),
        }

    dealt = map_batches(reps.select("point", "prefix"), deal, PACKED)
    shared = by_group(dealt, ["bucket"], share, PACKED)
    return by_group(shared, ["bucket"], gather, "point long, shared array<long>, regions array<long>")


def jaccard_join(docs: DataFrame, with_text_hash: bool = False) -> DataFrame:
    """One row per document row: doc_id, row (unique), n_shingles, n_links,
    component (smallest non-null doc_id reachable by links, itself included),
    first (whether it is the first row of its component, by doc_id).

    A-Z is lower-cased; a text of fewer than 5 words is one shingle; a null
    text or one without words has none and links with nothing. Rows with equal
    sets link with each other, also repeated rows; a row with a null id takes
    part, and its component is null when all of it is null. Empty tables give
    no rows; extra columns are ignored. ``with_text_hash`` adds th, xxhash64 of
    the text, by which a row is found again among those with its id.
    """
    stage = Stage(docs.sparkSession, "jaccard")
    common = common_shingles(docs, docs.count())
    sk = stage.write(sketches(docs, common), "sketches")
    # points: distinct sets, named by their smallest row
    points = stage.write(
        sk.where("n > 0").groupBy("g1", "g2").agg(F.min("row").alias("point"), F.count(F.lit(1)).alias("copies")), "points"
    )
    reps = sk.join(points.select(F.col("point").alias("row"), "copies"), "row").select(
        F.col("row").alias("point"), "doc_id", "th", "n", "copies", "prefix"
    )
    reps = stage.write(reps, "reps")
    sk = stage.write(sk.drop("prefix"), "rows")
    stage.drop("sketches")
    stage.release()
    met = stage.write(_met(reps).join(reps.select("point", "n"), "point"), "met")
    stage.drop("reps")
    member = met.select(F.explode_outer("regions").alias("region"), "point", "n")
    stage.release()
    # regions of more than a block are dealt into pairs of blocks
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = member.groupBy("region").agg(blocks.alias("blocks"))
    dealt = member.drop("n").join(sizes, "region")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "region", "point", F.least("block", "o").cast("long").alias("b1"), F.greatest("block", "o").cast("long").alias("b2"), F.col("block").cast("long").alias("block")
    )
    first = dealt.join(met.select("point", "n", "shared", "regions"), "point")
    place = "region long, b1 long, b2 long, point long, block long, regions array<long>"
    possible = stage.write(by_group(first, ["region", "b1", "b2"], _possible, place), "possible")
    stage.drop("met")
    stage.release()
    # whole sets of the points that are left, from the texts of their documents
    places = possible.groupBy("point").agg(
        F.first("regions").alias("regions"), F.collect_list(F.struct("region", "b1", "b2", "block")).alias("places")
    )
    left = sk.select(F.col("row").alias("point"), "doc_id", "th", "n").join(points.select("point", "copies"), "point")
    left = stage.write(left.join(places, "point"), "left")
    sets = stage.write(_sets(docs, left), "sets")
    size = left.agg(F.count(F.lit(1)).alias("points"), F.sum(F.size("places")).alias("rows")).first()
    stage.drop("possible")
    stage.drop("left")
    stage.release()
    # each set is sent to all its block pairs: in rounds that send about as many
    # sets as there are, so that the disk they take grows with the points only
    rounds = -(-(size.rows or 0) // max(1, size.points)) or 1
    parts = []
    for k in range(rounds):
        due = F.filter("places", lambda x: F.pmod(F.xxhash64(x["region"], x["b1"], x["b2"]), F.lit(rounds)) == k)
        second = sets.withColumn("places", due).where(F.size("places") > 0).withColumn("x", F.explode("places"))
        second = second.select("x.*", "point", "n", "copies", "regions", "shingles")
        parts.append(stage.write(by_group(second, ["region", "b1", "b2"], _links, "point long, low long, links long"), f"links-{k}"))
        stage.release()
    stage.drop("sets")
    got = reduce(DataFrame.unionByName, parts)
    comps = components(stage, got.select(F.col("point").alias("a"), F.col("low").alias("b")))
    counted = got.groupBy("point").agg(F.sum("links").alias("links"))
    label = points.join(comps.withColumnRenamed("node", "point"), "point", "left").join(counted, "point", "left")
    label = label.select(
        "g1", "g2", F.coalesce("component", "point").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    rows = stage.write(sk.join(label, ["g1", "g2"], "left"), "labelled")
    # rows without shingles stay alone
    heads = rows.where("c is not null").groupBy("c").agg(
        F.min("doc_id").alias("component"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("head")
    )
    return rows.join(heads, "c", "left").select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component"),
        F.coalesce(F.col("head.row") == F.col("row"), F.lit(True)).alias("first"),
        *(["th"] if with_text_hash else []),
    )


def _sets(docs: DataFrame, left: DataFrame) -> DataFrame:
    """``left`` with the shingle set of each point, from the document with its
    id and text hash (repeated rows have the same set)."""
    d = docs.select(
        F.col("doc_id").cast("long").alias("d"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h")
    )
    # the points grow with the documents: a shuffle join at every size, never a broadcast
    j = left.hint("merge").join(d, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")))
    kept = ["point", "n", "copies", "regions", "places"]

    def run(batch: pa.RecordBatch):
        texts = _texts(batch, batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            flat, sizes = shingle_sets(texts[a:b], SHINGLE)
            yield {**{c: batch.column(c).slice(a, b - a) for c in kept}, "shingles": _lists(flat.view(np.int64), sizes)}

    place = "struct<region: long, b1: long, b2: long, block: long>"
    ddl = f"point long, n long, copies long, regions array<long>, places array<{place}>, shingles array<long>"
    return map_batches(j.dropDuplicates(["point"]).select(*kept, "text"), run, ddl)


def op4_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents")).select("doc_id", "text")
    return jaccard_join(docs).select("doc_id", "n_shingles", F.col("component").alias("component_id"), "n_links")
