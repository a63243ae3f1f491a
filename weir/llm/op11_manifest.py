"""Merkle manifest of a data set, with proofs, by a cogrouped subtree exchange.

Every row is a leaf: the SHA-256 of its fields. The leaves of a group (a
source) form a tree of the given fan-out, and the group roots, in group order,
form a tree of the same kind over them.

The tree is worked through in superblocks of ``fanout ** DEPTH`` neighbours.
On the way up, one grouped pass reduces every superblock to its single node;
these nodes are the leaves of the next round, until a group has one node. On
the way down, the nodes of a round and the *outer nodes* of their superblock
(the siblings on its way to the root) are cogrouped by superblock: one call
does the local reduction again, joins the proof and, at the leaves, folds the
leaf back to the root. A task sees one superblock and its outer nodes, never a
group; a hot group is many superblocks. Digests travel as 32 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import Stage, ranked, table

FANOUT = 16
#: Levels of the tree that one superblock holds: 16 ** 2 = 256 nodes.
DEPTH = 2

#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SIBLINGS = "array<struct<before: string, after: string>>"


def lower_az(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, ``:`` and its
    value, or ``-`` for a null: 32 bytes."""
    parts = []
    for c in fields:
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node_digest(children: Sequence[str]) -> str:
    """The node over its children: SHA-256 of their digests as hex text."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def fold(leaf: str, proof) -> str:
    """The root that ``leaf`` and its siblings (before, after), level by level,
    lead to."""
    node = leaf
    for before, after in proof:
        node = hashlib.sha256((before + node + after).encode()).hexdigest()
    return node


def proof_digest(proof) -> str:
    return hashlib.sha256("".join(b + a for b, a in proof).encode()).hexdigest()


def reduce_levels(nodes: list[str], depth: int, fanout: int) -> list[list[str]]:
    """The levels of a subtree, its nodes first: ``depth`` times, every
    ``fanout`` consecutive nodes become one."""
    levels = [nodes]
    for _ in range(depth):
        below = levels[-1]
        levels.append([node_digest(below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels


def siblings(levels: list[list[str]], i: int, fanout: int) -> list[tuple[str, str]]:
    """The siblings of node ``i`` on its way through the subtree."""
    out = []
    for level in levels[:-1]:
        a = i - i % fanout
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + fanout])))
        i //= fanout
    return out


def _depth(n: int, fanout: int, most: int) -> int:
    """Levels until ``n`` nodes are one, ``most`` at the most."""
    d = 0
    while n > 1 and d < most:
        n, d = -(-n // fanout), d + 1
    return d


def _hex(column) -> list[str]:
    return [bytes(x).hex() for x in column]


def _ascend(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """(tree, n, pos, h) -> the same of the superblocks' nodes; ``n`` counts the
    nodes of the tree in this round."""
    size = fanout**depth

    def reduce(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        n = int(pdf.n.iloc[0])
        top = reduce_levels(_hex(pdf.h), _depth(n, fanout, depth), fanout)[-1]
        return pd.DataFrame({"tree": [key[0]], "n": [-(-n // size)], "pos": [key[1]], "h": [bytes.fromhex(top[0])]})

    return (
        nodes.withColumn("block", F.floor(F.col("pos") / size))
        .groupBy("tree", "block")
        .applyInPandas(reduce, "tree long, n long, pos long, h binary")
    )


def _descend(nodes: DataFrame, outer: DataFrame, fanout: int, depth: int, first: bool = False) -> DataFrame:
    """The siblings of every node (tree, pos) up to the last root, from those
    of its superblock (``outer``: tree, pos, above, subroot, proof). ``above``
    counts the siblings beyond the subroot, which ``first`` takes from the
    nodes themselves."""
    size = fanout**depth
    names = ["tree", "pos", "above", "subroot", "proof"]

    def join(key: tuple, pdf: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({c: [] for c in names})
        pdf = pdf.sort_values("pos")
        nodes = _hex(pdf.h)
        levels = reduce_levels(nodes, _depth(int(pdf.n.iloc[0]), fanout, depth), fanout)
        rest = [(p["before"], p["after"]) for p in over.proof.iloc[0]]
        proofs = [
            [{"before": b, "after": a} for b, a in siblings(levels, i, fanout) + rest] for i in range(len(pdf))
        ]
        return pd.DataFrame(
            {
                "tree": pdf.tree.to_numpy(),
                "pos": pdf.pos.to_numpy(),
                "above": [len(p) for p in proofs] if first else int(over.above.iloc[0]),
                "subroot": nodes if first else over.subroot.iloc[0],
                "proof": proofs,
            }
        )

    return (
        nodes.withColumn("block", F.floor(F.col("pos") / size))
        .groupBy("tree", "block")
        .cogroup(outer.groupBy("tree", "pos"))
        .applyInPandas(join, f"tree long, pos long, above int, subroot string, proof {_SIBLINGS}")
    )


def _finish(leaves: DataFrame, outer: DataFrame, fanout: int, depth: int, proofs: bool) -> DataFrame:
    """The last step down: local reduction, proof and folding of the leaves."""
    size = fanout**depth
    names = ["id", "grp", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = ", ".join(f"{c} string" for c in names) + (f", proof {_SIBLINGS}" if proofs else "")

    def finish(key: tuple, pdf: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        cols: dict = {c: [] for c in [*names, *(["proof"] if proofs else [])]}
        if not len(pdf):
            return pd.DataFrame(cols)
        pdf = pdf.sort_values("pos")
        hexes = _hex(pdf.h)
        levels = reduce_levels(hexes, _depth(int(pdf.n.iloc[0]), fanout, depth), fanout)
        rest = [(p["before"], p["after"]) for p in over.proof.iloc[0]]
        in_tree = len(rest) - int(over.above.iloc[0])
        subroot = fold(levels[-1][0], rest[:in_tree])
        if subroot != over.subroot.iloc[0]:
            raise ValueError(f"superblock {key} does not lead to the root of its group")
        for i, claimed in enumerate(pdf.claimed):
            proof = siblings(levels, i, fanout) + rest
            cols["proof_sha256"].append(proof_digest(proof))
            # an unchanged leaf is folded as well: its proof must lead to the root
            cols["folded_root"].append(fold(hexes[i] if claimed is None else bytes(claimed).hex(), proof))
            if proofs:
                cols["proof"].append([{"before": b, "after": a} for b, a in proof])
        cols |= {"id": pdf.id.to_numpy(), "grp": pdf.grp.to_numpy(), "leaf": hexes}
        cols |= {"subroot": [subroot] * len(pdf), "root": [fold(subroot, rest[in_tree:])] * len(pdf)}
        return pd.DataFrame(cols)

    return (
        leaves.withColumn("block", F.floor(F.col("pos") / size))
        .groupBy("tree", "block")
        .cogroup(outer.groupBy("tree", "pos"))
        .applyInPandas(finish, schema)
    )


def _placed(stage: Stage, leaves: DataFrame) -> DataFrame:
    """``leaves`` with tree (number of the group in group order), n (leaves of
    the tree) and pos (place in it).

    Leaves are range-partitioned in tree order and staged; a place is the one
    within (partition, group) after the group's leaves in earlier partitions.
    A hot group is spread over partitions, and joins on (partition, group).
    """
    order = [F.col("grp"), F.col("id"), F.col("h")]
    dealt = stage.write(leaves.repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("long")), "dealt")
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("t"))
    offsets = stage.write(
        totals.select(
            "grp",
            "part",
            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("off"),
            F.sum("t").over(Window.partitionBy("grp")).alias("n"),
        ),
        "offsets",
    )
    trees = ranked(stage, offsets.select("grp").distinct(), [F.col("grp")], "groups", out="tree")
    trees = stage.write(trees.select(F.col("grp").alias("g"), "tree"), "trees")
    known = offsets.join(trees, F.col("grp").eqNullSafe(F.col("g"))).select("g", F.col("part").alias("p"), "off", "n", "tree")
    inside = Window.partitionBy("part", "grp").orderBy(*order)
    return (
        dealt.withColumn("nth", F.row_number().over(inside))
        .join(known, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g")))
        .select("tree", "n", (F.col("off") + F.col("nth") - 1).alias("pos"), F.col("id").cast("string").alias("id"), "grp", "h", "claimed")
    )


def _rounds(stage: Stage, nodes: DataFrame, fanout: int, depth: int, name: str) -> list[DataFrame]:
    """Staged nodes of every round, the last of which has one node a tree."""
    out = [nodes]
    while out[-1].where("n > 1").limit(1).count():
        out.append(stage.write(_ascend(out[-1], fanout, depth), f"{name}-{len(out)}"))
    return out


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    received: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    depth: int = DEPTH,
    proofs: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``group_col``, leaf, subroot,
    root, proof_sha256, folded_root, verified, and with ``proofs`` also proof
    (siblings before and after the node, level by level).

    ``received`` gives, for some fields, the value to verify against the
    manifest (null where the stored value is to be taken): its leaf is folded
    with the siblings of the stored one, and ``verified`` says whether that
    leads to the root.

    Leaves of a group ascend by ``id_col``, nulls first; rows that share an id
    ascend by leaf (equal rows are leaves of their own, with equal digests).
    Groups ascend, null first, by UTF-8 bytes. A null field is ``-``, an empty
    text ``0:``; texts of any length are hashed by Spark and never leave it.
    An empty table gives no rows. Columns that are not among ``fields`` play no
    part, whatever their names.
    """
    stage = Stage(docs.sparkSession, "manifest")
    stored = [F.col(c) for c in fields]
    leaf = leaf_digest(stored)
    claimed = F.lit(None).cast("binary")
    if received:
        named = {c: F.coalesce(received[c], F.col(c)) if c in received else F.col(c) for c in fields}
        changed = F.lit(False)
        for c in received:
            changed = changed | received[c].isNotNull()
        claimed = F.when(changed, leaf_digest([named[c] for c in fields]))
    # the texts are read once; from here on a leaf is its id, its group and its digests
    leaves = stage.write(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(group_col).cast("string").alias("grp"),
            leaf.alias("h"),
            claimed.alias("claimed"),
        ),
        "leaves",
    )
    nodes = stage.write(_placed(stage, leaves), "nodes")
    for name in ("leaves", "dealt", "offsets"):
        stage.drop(name)
    # up: within the groups, then over the groups' roots
    low = _rounds(stage, nodes.select("tree", "n", "pos", "h"), fanout, depth, "up")
    count = F.lit(low[-1].count()).cast("long")
    over = low[-1].select(F.lit(0).cast("long").alias("tree"), count.alias("n"), F.col("tree").alias("pos"), "h")
    high = _rounds(stage, stage.write(over, "over-0"), fanout, depth, "over")
    # down: over the groups, then within them
    top = high[-1].select("tree", "pos", F.lit(0).alias("above"), F.lit("").alias("subroot"), F.array().cast(_SIBLINGS).alias("proof"))
    outer = top
    for i in range(len(high) - 1, -1, -1):
        step = _descend(high[i], outer, fanout, depth, first=i == 0)
        outer = stage.write(step, f"outer-over-{i}")
    # a group's root is the only node of its last round
    outer = outer.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "above", "subroot", "proof")
    for i in range(len(low) - 2, 0, -1):
        outer = stage.write(_descend(low[i], outer, fanout, depth), f"outer-{i}")
    done = _finish(nodes, outer, fanout, depth, proofs)
    return done.select(
        F.col("id").cast("long").alias(id_col),
        F.col("grp").alias(group_col),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        *(["proof"] if proofs else []),
    )


def op11_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table(sf_dir, "documents"))
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    received = {"text": F.when(hit, lower_az(F.col("text")))}
    return merkle_manifest(docs, received=received).drop("source")
