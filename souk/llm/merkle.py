"""Merkle manifest of a data set: a hash tree per group of rows, a tree over the groups' roots,
and an inclusion proof for every row by octopus multiproofs.

A row is a leaf. Within a group, leaves ascend by id; every ``FAN`` consecutive nodes (the last run
may be shorter, even one) are hashed to their parent until one is left, the subroot. Subroots, in
the groups' order, are the leaves of the last tree, whose end is the root.

* **Places.** Leaves are written in (group, id) order in sampled ranges, so a group that holds a
  third of all rows spreads over as many ranges as its share; counts per range and group give each
  leaf its position in its tree. Nothing but a row per range is summed in one place.
* **Building.** A task hashes ``STEP`` levels above ``FAN ** STEP`` neighbouring nodes; a job does so
  for all trees at once, and there are log(rows) / STEP jobs.
* **Proving.** Leaves are dealt in parts of ``PART`` neighbours. A part works out which nodes its
  leaves' proofs need that cannot be derived from the leaves themselves (the octopus: all arms,
  each node once), the parts' requests are joined with the nodes in one join, and each part derives
  shared interior nodes once and expands every leaf's own proof locally.

Defined results: rows of one id are ordered by leaf, equal leaves are interchangeable and each has
a place of its own; a null id comes first in its group, a null group before all others. An empty
table has no tree and no rows. Long texts are hashed by Spark's own ``sha2`` and travel no further.
Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import map_rows, written

FAN = 3
#: Levels that one task builds above its FAN ** STEP nodes.
STEP = 6
#: Leaves proven together.
PART = 4096
#: The tree over the groups; groups are numbered from 0.
TOP = -1
NODE = "tree long, level int, pos long, hash string, last boolean, n long"


def digest(parts: str) -> str:
    """H: lower-case hex SHA-256."""
    return hashlib.sha256(parts.encode()).hexdigest()


def leaf_hash(*fields: Column) -> Column:
    """H of the fields, each ``-`` if null, else its UTF-8 bytes' count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed).cast("binary"), 256)


# ----------------------------------------------------------------------------- places
def placed(leaves: DataFrame, part_size: int = PART) -> DataFrame:
    """``leaves`` (group, id, leaf, other) with ``tree`` (the group's number in order), ``pos``,
    ``n`` (leaves in the tree), ``range`` and ``part``, written in order."""
    numbered = written(leaves.withColumn("copy", F.monotonically_increasing_id()), "merkle-leaves")
    order = ("group", "id", "leaf", "copy")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(
        ranged.select("group", "id", "leaf", "other", F.spark_partition_id().alias("range"), within.alias("place")),
        "merkle-ranges",
    )
    sizes = rows.groupBy("range", "group").agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("from"))
    before = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    groups = sizes.groupBy("group").agg(
        F.min(F.struct("range", "from")).alias("at"), F.sum("size").alias("n")
    ).select("group", "n", "at.*")
    # A row per range: bounded by the shuffle's partitions.
    opened = groups.groupBy("range").agg(F.count(F.lit(1)).alias("groups"))
    so_far = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.select("range", F.coalesce(F.sum("groups").over(so_far), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("from")) - 1
    trees = groups.withColumn("inside", inside).join(opened, "range")
    trees = trees.select(F.col("group").alias("g"), "n", (F.col("inside") + F.col("before")).alias("tree"))
    starts = sizes.join(trees, F.col("group").eqNullSafe(F.col("g")))
    starts = starts.select("range", F.col("group").alias("g"), "from", "start", "n", "tree")
    found = rows.join(starts.withColumnRenamed("range", "r"), (F.col("range") == F.col("r")) & F.col("group").eqNullSafe(F.col("g")))
    pos = F.col("place") - F.col("from") + F.col("start")
    part = F.floor(F.col("place") / part_size)
    return written(found.select("tree", pos.alias("pos"), "n", "range", part.alias("part"), "id", "leaf", "other"), "merkle-placed")


# ----------------------------------------------------------------------------- building
def hashed_up(pos: int, level: int, n: int, hashes: list[str], step: int) -> list[tuple[int, int, str, bool, int]]:
    """(level, pos, hash, last, n) of the ``step`` levels above neighbouring nodes that begin at
    ``pos`` on a level of ``n`` nodes; fewer levels where the tree ends."""
    out = []
    for up in range(level + 1, level + step + 1):
        if n == 1:
            break
        hashes = [digest("".join(hashes[i : i + FAN])) for i in range(0, len(hashes), FAN)]
        pos, n = pos // FAN, -(-n // FAN)
        out += [(up, pos + i, h, n == 1, n) for i, h in enumerate(hashes)]
    return out


def built(level_0: DataFrame, step: int = STEP) -> list[DataFrame]:
    """Tables of nodes above the given ones (columns of NODE), each written."""

    def build(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, level, n, nodes in batch[["tree", "level", "n", "nodes"]].itertuples(index=False):
            out += [(tree, *row) for row in hashed_up(nodes[0]["pos"], level, n, [x["hash"] for x in nodes], step)]
        return pd.DataFrame(out, columns=["tree", "level", "pos", "hash", "last", "n"])

    tables, current = [], level_0.where("n > 1")
    while (top := current.agg(F.max("n")).first()[0] or 1) > 1:
        block = F.floor(F.col("pos") / FAN**step)
        nodes = F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("nodes")  # at most FAN ** step
        groups = current.groupBy("tree", "level", "n", block.alias("block")).agg(nodes)
        table = written(map_rows(groups, build, NODE), "merkle-nodes")
        tables.append(table)
        if top <= FAN**step:
            break
        done = current.select(F.max("level")).scalar()
        current = table.where((F.col("level") == done + step) & (F.col("n") > 1))
    return tables


# ----------------------------------------------------------------------------- proving
def level_sizes(n: int) -> list[int]:
    """Nodes per level of a tree with ``n`` leaves."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


def missing_nodes(positions: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """The octopus: per level the positions, each once, that the proofs of the given leaves need and
    that cannot be derived from those leaves."""
    known, out = np.unique(positions), []
    for level, size in enumerate(level_sizes(n)[:-1]):
        runs = np.unique(known // FAN)
        wanted = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        out.append((level, np.setdiff1d(wanted[wanted < size], known, assume_unique=True)))
        known = runs
    return out


def requests(leaves: DataFrame, n_trees: int) -> DataFrame:
    """(range, part, tree, level, pos) that each part must fetch: its leaves' own trees, and the
    tree over the groups."""
    by_tree = leaves.groupBy("range", "part", "tree", "n").agg(F.collect_list("pos").alias("positions"))
    parts = leaves.groupBy("range", "part").agg(F.collect_set("tree").alias("positions"))
    parts = parts.select("range", "part", F.lit(TOP).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), "positions")

    def wanted(batch: pd.DataFrame) -> pd.DataFrame:
        out = [
            pd.DataFrame({"range": r, "part": p, "tree": tree, "level": level, "pos": pos})
            for r, p, tree, n, positions in batch.itertuples(index=False)
            for level, pos in missing_nodes(np.asarray(positions, dtype=np.int64), n)
            if len(pos)
        ]
        return pd.concat(out) if out else pd.DataFrame()

    return map_rows(by_tree.unionByName(parts), wanted, "range int, part long, tree long, level int, pos long")


class Arms:
    """One tree as far as a part knows it: fetched nodes and those derived from its leaves."""

    def __init__(self, n: int, leaves: dict[int, str], fetched: dict[tuple[int, int], str]):
        self.sizes = level_sizes(n)
        #: per level: position -> (hashes before it in its run, hashes after it)
        self.beside: list[dict[int, tuple[str, str]]] = []
        known = leaves
        for level, size in enumerate(self.sizes[:-1]):
            beside, up = {}, {}
            for run in {p // FAN for p in known}:
                at = range(run * FAN, min(run * FAN + FAN, size))
                hashes = [known[p] if p in known else fetched[level, p] for p in at]
                up[run] = digest("".join(hashes))
                for i, p in enumerate(at):
                    if p in known:
                        beside[p] = ("".join(hashes[:i]), "".join(hashes[i + 1 :]))
            self.beside.append(beside)
            known = up
        self.root = known[0]

    def proof(self, pos: int) -> list[tuple[str, str]]:
        """What stands before and after the path from a leaf, level by level."""
        out = []
        for beside in self.beside:
            out.append(beside[pos])
            pos //= FAN
        return out


def fold(leaf: str, proof: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its proof lead to."""
    return reduce(lambda h, sides: digest(sides[0] + h + sides[1]), proof, leaf)


def prove(leaves: DataFrame, fetched: DataFrame, n_trees: int, with_proof: bool = False) -> DataFrame:
    """Per leaf its subroot, root, the proof's hash and the root folded from ``other`` (else the
    leaf itself); the proof's (before, after) hashes too if asked for."""

    def expand(own: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        by_tree: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, pos, h in nodes[["tree", "level", "pos", "hash"]].itertuples(index=False):
            by_tree.setdefault(tree, {})[level, pos] = h
        own = own.sort_values(["tree", "pos"], kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(own["tree"].to_numpy())) + 1), len(own)]
        arms, out = {}, []
        for a, b in pairwise(cuts):
            some = own.iloc[a:b]
            leaf_of = dict(zip(some["pos"].tolist(), some["leaf"], strict=True))
            tree = int(some["tree"].iloc[0])
            arms[tree] = Arms(int(some["n"].iloc[0]), leaf_of, by_tree.get(tree, {}))
        top = Arms(n_trees, {t: x.root for t, x in arms.items()}, by_tree.get(TOP, {}))
        for tree, pos, id_, leaf, other in own[["tree", "pos", "id", "leaf", "other"]].itertuples(index=False):
            proof = arms[tree].proof(pos) + top.proof(tree)
            folded = fold(leaf if other is None else other, proof)
            row = (id_, leaf, arms[tree].root, top.root, digest("".join(a + b for a, b in proof)), folded)
            out.append((*row, [list(p) for p in proof]) if with_proof else row)
        return pd.DataFrame(out, columns=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", *extra])

    extra = ["proof"] if with_proof else []
    kept = leaves.select("range", "part", "tree", "pos", "n", "id", "leaf", "other")
    id_type = kept.schema["id"].dataType.simpleString()
    # Ids travel as strings: pandas would turn integers beside nulls into floats.
    kept = kept.withColumn("id", F.col("id").cast("string"))
    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    schema += ", proof array<array<string>>" if with_proof else ""
    both = kept.groupBy("range", "part").cogroup(fetched.groupBy("range", "part"))
    return both.applyInPandas(expand, schema).withColumn("id", F.col("id").cast(id_type))


def manifest(
    docs: DataFrame,
    leaf: Column,
    other: Column,
    group_col: str = "source",
    id_col: str = "doc_id",
    with_proof: bool = False,
    step: int = STEP,
    part_size: int = PART,
) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root (from ``other``
    where that is not null) and whether that is the root."""
    base = docs.select(
        F.col(group_col).alias("group"), F.col(id_col).alias("id"), leaf.alias("leaf"), other.alias("other")
    )
    leaves = placed(base, part_size)
    n_trees = leaves.agg(F.max("tree")).first()[0]
    n_trees = 0 if n_trees is None else n_trees + 1
    last = (F.col("n") == 1).alias("last")
    level_0 = leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("hash"), last, "n")
    nodes = [level_0, *built(level_0, step)]
    roots = reduce(DataFrame.unionByName, nodes).where("last")
    top = roots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("pos"), "hash",
        F.lit(n_trees == 1).alias("last"), F.lit(n_trees).cast("long").alias("n"),
    )
    top = written(top, "merkle-subroots")
    nodes = reduce(DataFrame.unionByName, [*nodes, top, *built(top, step)]).select("tree", "level", "pos", "hash")
    fetched = requests(leaves, n_trees).join(nodes, ["tree", "level", "pos"])
    proven = prove(leaves, fetched, n_trees, with_proof)
    return proven.withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))
