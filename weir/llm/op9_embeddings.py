"""Embedding near-duplicates over a robust-pruned flat graph.

Distinct vectors are first dealt into regions that can be joined on their own:
an oversize region is split by a k-means fit on a bounded sample of it, each
vector being at home with its nearest centroid and a visitor wherever a vector
within the link range could be (the triangle inequality at the plane between
two centroids). Of two regions the vectors of one visit the other, so each pair
in range meets in exactly one.

A region that a split does not make cheaper holds vectors without structure.
It is searched over a graph: it is cut into overlapping shards, every vector
going to its ``overlap`` nearest centroids; each shard builds a flat graph with
robust-pruned edges; the adjacency lists that a vector got in its shards are
united; and every vector is searched in its shards, greedily from the medoid
over the united lists, expanding further while vectors in range turn up. An
audit compares a bounded sample of vectors with brute force over their whole
region; a recall below ``AUDIT_RECALL`` repeats the search with more overlap,
and in the end compares all blocks of the region.

Regions of at most ``CELL`` vectors, and dense groups (near copies of one
vector, all linked with each other, which no graph makes cheaper), are compared
whole, in pairs of blocks of bounded size. Every link, however found, is
verified by its cosine in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import Stage, by_group, components, map_batches, table
from weir.llm.text import mix

COSINE = 0.9
#: Vectors at home in a cell that is not split further, and of a block of a larger one.
CELL = 2048
#: Most children of a split, and the most vectors of a cell its k-means is fitted on.
FAN, FIT_ROWS = 64, 8192
MAX_DEPTH = 12
#: A split is taken when it leaves at most this share of a cell's comparisons.
PAYS = 0.5
#: Cells are dense when half of their sample is this near to its mean (the
#: square root of ``COSINE``: two such vectors are commonly in range).
DENSE = 0.949
#: Shards that a vector goes to, and how much of the way between two centroids
#: it may be nearer to the first and still go to the second.
OVERLAP, MARGIN = 3, 0.3
#: Most children of a split into shards: as every level of splits multiplies
#: the copies of a vector, there are to be few levels.
SHARD_FAN = 256
DEGREE, CANDIDATES, ALPHA, BEAM = 24, 64, 1.2, 16
#: Vectors in reach of the range are expanded, not reported.
SLACK = 0.05
AUDIT_ROWS, AUDIT_RECALL = 128, 0.95


# ---- numpy inside tasks --------------------------------------------------------


def matrix(column) -> np.ndarray:
    """Unit rows (float64) of a list column of equal, non-null lengths."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks)
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(a), -1) if len(a) else flat.reshape(0, 1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def kmeans(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; deterministic."""
    c = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        at = (x @ c.T).argmax(axis=1)
        for j in range(k):
            own = x[at == j]
            if len(own):
                s = own.sum(axis=0)
                n = np.sqrt(s @ s)
                if n > 0:
                    c[j] = s / n
    return c


def apart(c: np.ndarray) -> np.ndarray:
    """Centroids without those in range of an earlier one, which would cut a
    group of near copies."""
    keep: list[int] = []
    for j in range(len(c)):
        if not keep or (c[keep] @ c[j]).max() < COSINE:
            keep.append(j)
    return c[keep]


def dense(x: np.ndarray) -> bool:
    """Whether half of the vectors are so near to their mean that they are
    commonly in range of each other."""
    mean = x.mean(axis=0)
    return bool((x @ mean >= DENSE * np.sqrt(mean @ mean)).mean() >= 0.5)


def visits(x: np.ndarray, c: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, child, at home) of the children that rows are dealt to. A vector
    in reach of ``x`` and nearest to centroid j lies beyond the plane between j
    and the centroid nearest to ``x``, so that plane is in reach of ``x`` too.
    Of two rows at home in the parent, the one of the later child visits."""
    s = x @ c.T
    own = s.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))[own]
    near = s[np.arange(len(x)), own][:, None] - s <= np.sqrt(1 - COSINE**2) * apart + 1e-7
    near &= ~home[:, None] | (np.arange(len(c))[None, :] <= own[:, None])
    row, child = np.nonzero(near)
    return row, child, home[row] & (child == own[row])


def comparisons(child: np.ndarray, home: np.ndarray) -> float:
    h = np.bincount(child[home], minlength=FAN).astype(np.float64)
    v = np.bincount(child[~home], minlength=FAN)
    return float((h * (h / 2 + v)).sum())


def lowest(hit: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The smallest point of each one's component; ``hit`` is symmetric."""
    low = point.copy()
    seen = np.zeros(len(point), dtype=bool)
    for i in np.flatnonzero(hit.any(axis=1)):
        if seen[i]:
            continue
        member = np.zeros(len(point), dtype=bool)
        member[i] = True
        front = np.array([i])
        while len(front):
            new = hit[front].any(axis=0) & ~member
            member |= new
            front = np.flatnonzero(new)
        low[member] = point[member].min()
        seen |= member
    return low


def pruned_graph(x: np.ndarray) -> np.ndarray:
    """Neighbour numbers (rows padded with -1) of a robust-pruned flat graph:
    a candidate is dropped when a kept neighbour is closer to it, by the
    factor ``ALPHA``, than the vector itself."""
    m = len(x)
    if m < 2:
        return np.full((m, 1), -1, dtype=np.int64)
    s = (x @ x.T).astype(np.float32)
    np.fill_diagonal(s, -2)
    c = min(CANDIDATES, m - 1)
    cand = np.argpartition(-s, c - 1, axis=1)[:, :c]
    # a few far candidates keep distant parts of the cell in reach
    far = (np.arange(m)[:, None] + np.linspace(1, m - 1, min(8, m - 1)).astype(np.int64)[None, :]) % m
    cand = np.concatenate([cand, far], axis=1)
    sim = np.take_along_axis(s, cand, axis=1)
    alive = sim > -2
    out = np.full((m, DEGREE), -1, dtype=np.int64)
    rows = np.arange(m)
    for step in range(DEGREE):
        best = np.where(alive, sim, -3).argmax(axis=1)
        has = alive[rows, best]
        if not has.any():
            break
        pick = cand[rows, best]
        out[has, step] = pick[has]
        between = s[pick[:, None], cand]  # similarity of the pick to every candidate
        covered = ALPHA * (1 - between) <= 1 - sim
        alive &= ~(covered & has[:, None])
        alive[rows, best] = False
        alive &= cand != pick[:, None]
    return out


def undirected(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """Neighbour numbers (rows padded with -1) by the edges (a, b) and their
    reverses: without these, vectors that are nobody's near neighbour could
    only be left, not reached."""
    code = np.unique(np.concatenate([a * m + b, b * m + a]))
    a, b = code // m, code % m
    n = np.bincount(a, minlength=m)
    adj = np.full((m, max(1, int(n.max()) if len(n) else 1)), -1, dtype=np.int64)
    start = np.cumsum(n) - n
    adj[a, np.arange(len(a)) - start[a]] = b
    return adj


def range_search(x: np.ndarray, adj: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, other) with cosine >= radius that the search finds; every
    row is a query."""
    m = len(x)
    seen = np.zeros((m, m), dtype=bool)
    got_q, got_v, got_s = [], [], []

    def visit(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = np.empty(len(q))
        for a in range(0, len(q), 65536):
            out[a : a + 65536] = np.einsum("ij,ij->i", x[q[a : a + 65536]], x[v[a : a + 65536]])
        seen[q, v] = True
        near = out >= radius - SLACK
        got_q.append(q[near])
        got_v.append(v[near])
        got_s.append(out[near])
        return out

    queries = np.arange(m)
    mean = x.mean(axis=0)
    medoid = int((x @ mean).argmax())
    beam = np.full((m, BEAM), -1, dtype=np.int64)
    sims = np.full((m, BEAM), -3.0)
    done = np.zeros((m, BEAM), dtype=bool)
    beam[:, 0], sims[:, 0] = medoid, visit(queries, np.full(m, medoid))
    while True:
        open_ = (beam >= 0) & ~done
        active = np.flatnonzero(open_.any(axis=1))
        if not len(active):
            break
        at = np.where(open_[active], sims[active], -4).argmax(axis=1)
        done[active, at] = True
        nb = adj[beam[active, at]]
        fresh = (nb >= 0) & ~seen[active[:, None], np.maximum(nb, 0)]
        r, c = np.nonzero(fresh)
        if not len(r):
            continue
        new = np.full(nb.shape, -3.0)
        new[r, c] = visit(active[r], nb[r, c])
        ids = np.concatenate([beam[active], np.where(fresh, nb, -1)], axis=1)
        val = np.concatenate([sims[active], new], axis=1)
        was = np.concatenate([done[active], np.zeros(nb.shape, dtype=bool)], axis=1)
        top = np.argsort(-val, axis=1, kind="stable")[:, :BEAM]
        beam[active] = np.take_along_axis(ids, top, axis=1)
        sims[active] = np.take_along_axis(val, top, axis=1)
        done[active] = np.take_along_axis(was, top, axis=1)
    # the range grows from what the greedy search saw in reach of it, and from the query itself
    own = ~seen[queries, queries]
    visit(queries[own], queries[own])
    at = 0
    while at < len(got_q):
        q = np.concatenate(got_q[at:])
        v = np.concatenate(got_v[at:])
        at = len(got_q)
        for a in range(0, len(q), 20_000):
            qq = np.repeat(q[a : a + 20_000], adj.shape[1])
            nb = adj[v[a : a + 20_000]].ravel()
            ok = nb >= 0
            code = np.unique(qq[ok] * m + nb[ok])
            qq, nb = code // m, code % m
            fresh = ~seen[qq, nb]
            if fresh.any():
                visit(qq[fresh], nb[fresh])
    q, v, s = np.concatenate(got_q), np.concatenate(got_v), np.concatenate(got_s)
    ok = (s >= radius) & (q != v)
    # a link found from one side is a link of both
    code = np.unique(np.concatenate([q[ok] * m + v[ok], v[ok] * m + q[ok]]))
    return code // m, code % m


# ---- regions -------------------------------------------------------------------


def regions(stage: Stage, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames (cell, point, home): cells to be compared whole (of at most
    ``CELL`` vectors at home, or dense), and cells without structure, to be
    searched. Each pair in range is in exactly one cell, at least one of the
    two at home."""
    columns = ["cell", "point", "home"]
    now = stage.write(points.select(F.lit(0).cast("long").alias("cell"), "point", F.lit(True).alias("home"), "v"), "cells-0")
    done, loose = None, now.where("false").select(*columns)
    for depth in range(1, MAX_DEPTH + 1):
        sizes = now.where("home").groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
        sized = now.join(F.broadcast(sizes) if depth == 1 else sizes, "cell")  # at first one cell
        fits = sized.where(F.col("m") <= CELL).select(*columns)
        done = fits if done is None else done.unionByName(fits)
        big = sized.where(F.col("m") > CELL)
        n_big = sizes.where(F.col("m") > CELL).count()
        if not n_big:
            return done, loose
        order = Window.partitionBy("cell").orderBy(F.xxhash64("point"), "point")
        sample = big.withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIT_ROWS)

        def fit(key, t: pa.Table):
            x, home = matrix(t["v"]), t["home"].to_numpy()
            k = int(min(FAN, max(8, -(-t["m"][0].as_py() * 4 // CELL)), home.sum()))
            if k < 2:
                return [{"cell": [key[0]], "cs": [[]], "dense": [True]}]
            c = kmeans(x[home], k)
            _, child, own = visits(x, c, home)
            # the sample only decides where pairs meet, never whether
            if comparisons(child, own) > PAYS * comparisons(np.zeros(len(x), dtype=np.int64), home):
                return [{"cell": [key[0]], "cs": [[]], "dense": [dense(x[home])]}]
            return [{"cell": [key[0]], "cs": [c.tolist()], "dense": [False]}]

        cents = stage.write(by_group(sample, ["cell"], fit, "cell long, cs array<array<double>>, dense boolean"), f"centroids-{depth}")
        whole = cents.where(F.size("cs") == 0)
        done = done.unionByName(big.join(whole.where("dense"), "cell", "left_semi").select(*columns))
        loose = loose.unionByName(big.join(whole.where("not dense"), "cell", "left_semi").select(*columns))
        cents = cents.where(F.size("cs") > 0).drop("dense")
        # FAN centroids per oversize cell: broadcast while that is at most a
        # few dozen MB, else a join on the cell
        dealt = big.join(F.broadcast(cents) if n_big <= 1000 else cents, "cell")

        def assign(batch: pa.RecordBatch):
            cells = batch.column("cell").to_numpy()
            home = batch.column("home").to_numpy(zero_copy_only=False)
            for cell in np.unique(cells):
                inside = np.flatnonzero(cells == cell)
                c = np.array(batch.column("cs")[int(inside[0])].as_py())
                for a in range(0, len(inside), 512):
                    at = inside[a : a + 512]
                    row, kid, own = visits(matrix(batch.column("v").take(pa.array(at))), c, home[at])
                    rows = pa.array(at[row])
                    # a path of children, hashed: equal for equal paths
                    child = mix(mix(np.array([cell]).view(np.uint64)) + kid.astype(np.uint64)) >> np.uint64(2)
                    yield {"cell": child.astype(np.int64), "point": batch.column("point").take(rows), "home": own, "v": batch.column("v").take(rows)}

        now = stage.write(map_batches(dealt, assign, "cell long, point long, home boolean, v array<double>"), f"cells-{depth}")
    return done.unionByName(now.select(*columns)), loose


# ---- cells that are compared whole -----------------------------------------------


def _blocks(cells: DataFrame, points: DataFrame) -> DataFrame:
    """(cell, b1, b2, block, point, v, copies): cells dealt into pairs of blocks
    of bounded size, the visitors' blocks after those at home, which they are
    paired with; a cell that fits is one block."""
    sizes = cells.groupBy("cell").agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("g"))
    d = cells.join(sizes.where("h > 0"), "cell").join(points, "point")
    d = d.withColumn("bh", F.ceil(F.col("h") / CELL).cast("long")).withColumn("bg", F.ceil(F.col("g") / CELL).cast("long"))
    number = F.xxhash64("point")
    d = d.withColumn("block", F.when(F.col("home"), F.pmod(number, F.col("bh"))).otherwise(F.col("bh") + F.pmod(number, F.greatest("bg", F.lit(1).cast("long")))))
    last = F.when(F.col("home"), F.col("bh") + F.col("bg")).otherwise(F.col("bh")) - 1
    d = d.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return d.select("cell", F.least("block", "o").alias("b1"), F.greatest("block", "o").alias("b2"), "block", "point", "v", "copies")


def _compare(key: tuple, t: pa.Table):
    point, block, copies = t["point"].to_numpy(), t["block"].to_numpy(), t["copies"].to_numpy()
    x = matrix(t["v"])
    rows, cols = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
    found = np.zeros((len(rows), len(cols)), dtype=bool)
    for a in range(0, len(rows), 512):
        found[a : a + 512] = x[rows[a : a + 512]] @ x[cols].T >= COSINE
    if key[1] == key[2]:
        np.fill_diagonal(found, False)
    if not found.any():
        return []
    hit = np.zeros((len(point), len(point)), dtype=bool)
    hit[np.ix_(rows, cols)] = found
    hit |= hit.T.copy()
    links = np.concatenate([hit[a : a + 512] @ copies for a in range(0, len(point), 512)])
    low = lowest(hit, point)
    linked = hit.any(axis=1)
    return [{"point": point[linked], "low": low[linked], "links": links[linked]}]


# ---- regions that are searched ----------------------------------------------------


def overlapping_shards(stage: Stage, loose: DataFrame, overlap: int) -> DataFrame:
    """(u, cell, point): the vectors of every region ``u`` (u, point, v) in
    shards of at most ``CELL``, or ones that no split reduces, which are dealt
    in blocks later. A vector goes to the ``overlap`` nearest centroids that
    are within ``MARGIN`` of the nearest."""
    now = stage.write(loose.select("u", F.col("u").alias("cell"), "point", "v"), f"shards-{overlap}-0")
    columns = ["u", "cell", "point"]
    done = None
    for depth in range(1, MAX_DEPTH + 1):
        sizes = now.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
        sized = now.join(sizes, "cell")
        fits = sized.where(F.col("m") <= CELL).select(*columns)
        done = fits if done is None else done.unionByName(fits)
        big = sized.where(F.col("m") > CELL)
        n_big = sizes.where(F.col("m") > CELL).count()
        if not n_big or depth == MAX_DEPTH:
            done = done.unionByName(big.select(*columns))
            break
        order = Window.partitionBy("cell").orderBy(F.xxhash64("point"), "point")
        sample = big.withColumn("n", F.row_number().over(order)).where(F.col("n") <= FIT_ROWS)

        def fit(key, t: pa.Table):
            x = matrix(t["v"])
            # many more children than a vector goes to, or the shards never shrink
            k = int(min(SHARD_FAN, max(4 * overlap, -(-t["m"][0].as_py() * 2 * overlap // CELL))))
            c = apart(kmeans(x, min(k, len(x))))
            # a dense group stays together, in blocks
            return [] if len(c) < 2 or dense(x) else [{"cell": [key[0]], "cs": [c.tolist()]}]

        cents = stage.write(by_group(sample, ["cell"], fit, "cell long, cs array<array<double>>"), f"shard-centroids-{overlap}-{depth}")
        # SHARD_FAN centroids per oversize shard: broadcast while that is at most
        # a few dozen MB, else a join on the shard
        done = done.unionByName(big.join(cents, "cell", "left_anti").select(*columns))
        dealt = big.join(F.broadcast(cents) if n_big <= 250 else cents, "cell")

        def assign(batch: pa.RecordBatch):
            cells = batch.column("cell").to_numpy()
            x = matrix(batch.column("v"))
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                c = np.array(batch.column("cs")[int(at[0])].as_py())
                near = x[at] @ c.T
                top = np.argsort(-near, axis=1, kind="stable")[:, : min(overlap, len(c))]
                best = top[:, :1]
                behind = np.take_along_axis(near, best, axis=1) - np.take_along_axis(near, top, axis=1)
                between = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))[best, top]
                row, rank = np.nonzero(behind <= MARGIN * between + 1e-12)
                rows = pa.array(at[row])
                # a path of children, hashed: equal for equal paths
                child = mix(mix(np.array([cell]).view(np.uint64)) + top[row, rank].astype(np.uint64)) >> np.uint64(2)
                yield {"u": batch.column("u").take(rows), "cell": child.astype(np.int64), "point": batch.column("point").take(rows), "v": batch.column("v").take(rows)}

        now = stage.write(map_batches(dealt, assign, "u long, cell long, point long, v array<double>"), f"shards-{overlap}-{depth}")
    return stage.write(done.distinct(), f"shards-{overlap}")


def _shard_blocks(shards: DataFrame) -> DataFrame:
    """(u, cell, b1, b2, point, block): shards dealt into pairs of blocks of
    bounded size; a shard that fits is one block."""
    sizes = shards.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    d = shards.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("m") / CELL).cast("int"))
    d = d.withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("long"))
    return d.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))).select(
        "u", "cell", F.least("block", "o").alias("b1"), F.greatest("block", "o").alias("b2"), "point", "block"
    )


def _build(key: tuple, t: pa.Table):
    point = t["point"].to_numpy()
    adj = pruned_graph(matrix(t["v"]))
    return [{"u": t["u"], "point": point, "adj": [point[r[r >= 0]] for r in adj]}]


def _search(key: tuple, t: pa.Table):
    point, block, copies = t["point"].to_numpy(), t["block"].to_numpy(), t["copies"].to_numpy()
    home = t["home"].to_numpy()
    lists = t["adj"].combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(point)), lists.value_lengths().to_numpy())
    # united lists, as far as they stay in this shard
    order = np.argsort(point)
    pos = np.searchsorted(point[order], flat)
    pos[pos == len(point)] = 0
    inside = point[order][pos] == flat
    adj = undirected(rows[inside], order[pos[inside]], len(point))
    q, v = range_search(matrix(t["v"]), adj, COSINE)
    own = home[q] | home[v]  # two visitors of a region meet in another one
    if key[1] != key[2]:
        own &= block[q] != block[v]
    q, v = q[own], v[own]
    if not len(q):
        return []
    # a pair that meets in several shards is counted in the smallest
    cells = t["cells"].to_pylist()
    least = np.array([c[0] for c in cells])
    mine = (least[q] == key[0]) | (least[v] == key[0])
    homes = [frozenset(c) for c in cells]
    for i in np.flatnonzero(~mine):
        mine[i] = min(homes[q[i]] & homes[v[i]]) == key[0]
    links = np.bincount(q[mine], weights=copies[v[mine]], minlength=len(point)).astype(np.int64)
    low = point.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, q, low[v])
        if (new == low).all():
            break
        low = new
    linked = np.zeros(len(point), dtype=bool)
    linked[q] = True
    return [{"u": t["u"].combine_chunks().filter(pa.array(linked)), "point": point[linked], "low": low[linked], "links": links[linked]}]


def graph_links(stage: Stage, loose: DataFrame, overlap: int) -> DataFrame:
    """(u, point, low, links) of the regions ``loose`` (u, point, home, v, copies)."""
    shards = overlapping_shards(stage, loose, overlap)
    groups = _shard_blocks(shards).join(loose, ["u", "point"])
    built = by_group(groups, ["cell", "b1", "b2"], _build, "u long, point long, adj array<long>")
    united = built.groupBy("u", "point").agg(F.array_distinct(F.flatten(F.collect_list("adj"))).alias("adj"))
    homes = shards.groupBy("u", "point").agg(F.array_sort(F.collect_set("cell")).alias("cells"))
    graph = stage.write(united.join(homes, ["u", "point"]), f"graph-{overlap}")
    found = by_group(groups.join(graph, ["u", "point"]), ["cell", "b1", "b2"], _search, "u long, point long, low long, links long")
    return stage.write(found, f"graph-links-{overlap}")


def audit(loose: DataFrame, links: DataFrame, rows: int = AUDIT_ROWS) -> float:
    """Share of the true links of ``rows`` vectors at home (the first by hash)
    that were found: brute force of a bounded sample against its regions."""
    picked = loose.where("home").orderBy(F.xxhash64("point"), "point").limit(rows).select("u", "point", "v").toPandas()
    if not len(picked):
        return 1.0
    u, ids = picked["u"].to_numpy(), picked["point"].to_numpy()
    x = matrix(pa.array([np.asarray(v, dtype=np.float64) for v in picked["v"]]))
    shared = loose.sparkSession.sparkContext.broadcast((u, ids, x))

    def count(batch: pa.RecordBatch):
        u, ids, x = shared.value
        hit = x @ matrix(batch.column("v")).T >= COSINE
        hit &= (u[:, None] == batch.column("u").to_numpy()[None, :]) & (ids[:, None] != batch.column("point").to_numpy()[None, :])
        yield {"u": u, "point": ids, "n": (hit * batch.column("copies").to_numpy()[None, :]).sum(axis=1)}

    counts = map_batches(loose.select("u", "point", "v", "copies"), count, "u long, point long, n long")
    truth = counts.groupBy("u", "point").agg(F.sum("n").alias("n"))
    found = links.groupBy("u", "point").agg(F.sum("links").alias("f"))
    r = truth.join(found, ["u", "point"], "left").agg(F.sum("n").alias("n"), F.sum(F.least(F.coalesce("f", F.lit(0)), "n")).alias("f")).first()
    return 1.0 if not r.n else (r.f or 0) / r.n


def _links(stage: Stage, points: DataFrame) -> DataFrame:
    """(point, low, links): sums of ``links`` by point are its copies of others
    in range, and ``low`` joins it to its component."""
    whole, loose = regions(stage, points)
    whole = stage.write(whole, "whole")
    found = by_group(_blocks(whole, points), ["cell", "b1", "b2"], _compare, "point long, low long, links long")
    found = stage.write(found, "links")
    loose = stage.write(loose, "loose")
    if loose.isEmpty():
        return found
    vectors = stage.write(loose.withColumnRenamed("cell", "u").join(points, "point"), "loose-vectors")
    for overlap in range(OVERLAP, OVERLAP + 3):
        got = graph_links(stage, vectors, overlap)
        if audit(vectors, got) >= AUDIT_RECALL:
            return found.unionByName(got.drop("u"))
    rest = by_group(_blocks(loose, points), ["cell", "b1", "b2"], _compare, "point long, low long, links long")
    return found.unionByName(stage.write(rest, "loose-links"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links,
    component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, as do vectors of different lengths. Equal vectors link
    with each other. Rows that share an id are vectors of their own; a null id
    takes part, and a component of null ids alone has a null component_id (and
    kept is false). An empty table gives no rows; extra columns are ignored.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "embeddings")
    e = F.col("embedding").cast("array<double>")
    sane = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(e, lambda c: c != 0)
    rows = stage.write(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.coalesce(sane, F.lit(False)), e).alias("v"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    keyed = rows.select("row", "vec_id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("v"), "v").alias("h2"), F.col("v").isNotNull().alias("ok"), F.size("v").alias("dim"))
    points = keyed.where("ok").groupBy("h1", "h2", "dim").agg(F.min("row").alias("point"), F.count(F.lit(1)).alias("copies"))
    points = stage.write(points, "points")
    full = stage.write(points.join(rows.select(F.col("row").alias("point"), "v"), "point").drop("h1", "h2"), "distinct")
    links = None
    for r in full.select("dim").distinct().orderBy("dim").collect():  # the vector lengths, commonly one
        own = full.where(F.col("dim") == r.dim).drop("dim")
        got = _links(Stage(spark, f"embeddings-{r.dim}"), own)
        links = got if links is None else links.unionByName(got)
    if links is None:
        links = spark.createDataFrame([], "point long, low long, links long")
    comps = components(stage, links.select(F.col("point").alias("a"), F.col("low").alias("b")))
    counted = links.groupBy("point").agg(F.sum("links").alias("links"))
    label = points.join(comps.withColumnRenamed("node", "point"), "point", "left").join(counted, "point", "left")
    label = label.select("h1", "h2", F.coalesce("component", "point").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = stage.write(keyed.where("ok").join(label, ["h1", "h2"]).select("row", "vec_id", "c", "n_links"), "labelled")
    heads = out.groupBy("c").agg(F.min("vec_id").alias("component_id"))
    alone = keyed.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = out.join(heads, "c").select("vec_id", F.col("n_links").cast("long"), "component_id").unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op9_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(table(sf_dir, "embeddings")).select("vec_id", "embedding"))
