"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuegrid.llm.common import keep


#: Edges up to which a round is the work of one task: the many small rounds at the end need no shuffle then.
SMALL = 200_000


def classes(edges: DataFrame) -> DataFrame:
    """One row per node that has an edge: ``node`` and ``root``, a node that all of its component share.

    edges: columns ``a`` and ``b`` (long). Null ends and self-loops are ignored; repeated edges count once. An
    empty edge table gives an empty result.

    Each round ranks nodes by a hash of their own, points every node at the best ranked of itself and its
    neighbours, and redraws the edges between those targets. As ranks are random, about half of the nodes stay in
    each round whatever the shape of the graph, long paths included, so the number of rounds is logarithmic. The
    best neighbour is combined before its shuffle and the redrawing joins are plain inner joins, which adaptive
    execution splits when a hub is large. Every round is written to the shared folder, so lineage stays short. Rounds
    of few edges (SMALL) run in one task.
    """
    live = keep(_simple(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))), "edges")
    steps: list[DataFrame] = []
    while n := live.count():
        live = _fit(live, n)
        both = _fit(live.union(live.select("b", "a")), n)
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(_ranked(F.col("b"), len(steps))).alias("near"))
        step = keep(near.select("node", F.least("near", _ranked(F.col("node"), len(steps)))["node"].alias("root")), "step")
        steps.append(step)
        step = _fit(step, n)
        at_a = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        at_b = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        live = keep(_simple(live.join(at_a, "a").join(at_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "edges")
    if not steps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        on = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found


def _fit(rows: DataFrame, n: int) -> DataFrame:
    return rows.coalesce(1) if n <= SMALL else rows


def components(edges: DataFrame) -> DataFrame:
    """As ``classes``, with the smallest node of the component as ``root``."""
    found = keep(classes(edges), "classes")
    least = keep(found.groupBy("root").agg(F.min("node").alias("least")), "least")
    return found.join(least, "root").select("node", F.col("least").alias("root"))


def _ranked(node: Column, turn: int) -> Column:
    return F.struct(F.xxhash64(node, F.lit(turn)).alias("rank"), node.alias("node"))


def _simple(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
