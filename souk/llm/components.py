"""Connected components by contraction, every step a join over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import written


def _order(node: str, round_no: int):
    """A new random order of the nodes each round, so that long chains shrink by a constant
    share a round whatever their ids."""
    return F.struct(F.xxhash64(F.col(node), F.lit(round_no)).alias("h"), F.col(node).alias("v"))


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): roots are equal exactly within a
    component. Each round, a node joins the neighbour that comes first in a random order (or
    itself), chains of joins are halved by one jump, and edges move to the joined nodes. Only the
    number of edges left reaches the driver. ``rows``: a bound on twice the edges, if known."""
    forth, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.where("a <> b").select(F.inline(F.array(forth, back))).distinct()
    both = written(both, "cc-edges", rows)
    roots, round_no = None, 0
    # Edges only get fewer, and a node of theirs has one at least.
    while left := both.count():
        nearest = both.groupBy("a").agg(F.min(_order("b", round_no)).alias("o"))
        own = _order("a", round_no)
        parent = nearest.select(
            F.col("a").alias("node"), F.when(F.col("o.h") < own["h"], F.col("o.v")).otherwise(F.col("a")).alias("to")
        )
        parent = written(parent, "cc-parent", left)
        jump = parent.select(F.col("node").alias("to"), F.col("to").alias("far"))
        parent = written(parent.join(jump, "to").select("node", F.col("far").alias("to")), "cc-jump", left)
        moved = both.join(parent.toDF("a", "x"), "a").join(parent.toDF("b", "y"), "b")
        moved = moved.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        if roots is None:
            roots, nodes = parent.toDF("node", "root"), left
        else:
            step = parent.toDF("root", "next")
            roots = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            roots = written(roots, "cc-roots", nodes)
        both = written(moved, "cc-edges", left)
        round_no += 1
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if roots is None else roots
