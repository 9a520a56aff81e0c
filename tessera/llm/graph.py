"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import cut

#: What one task may hold once its neighbours have been contracted.
TASK_EDGES = 500_000


class Union(dict):
    """Disjoint sets; the root of a set is its least member."""

    def find(self, x: int) -> int:
        root = x
        while (up := self.get(root, root)) != root:
            root = up
        while (up := self.get(x, x)) != root:
            self[x], x = root, up
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.setdefault(a, a)
        self.setdefault(b, b)
        if a != b:
            self[max(a, b)] = min(a, b)


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition as (node, least node that it reaches here): no more than nodes, roots included."""
    union = Union()
    for b in batches:
        pair = np.unique(np.stack([np.asarray(b.column(0)), np.asarray(b.column(1))]), axis=1)
        for x, y in pair.T.tolist():
            union.join(x, y)
    nodes = list(union)
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([union.find(x) for x in nodes], pa.int64())], names=["a", "b"])


def components(edges: DataFrame, task_edges: int = TASK_EDGES, most_rounds: int = 200) -> DataFrame:
    """(node, comp): the smallest node that each node of edges (a, b) reaches.

    Each partition first contracts its own edges. While more than task_edges are left, the graph is contracted in
    rounds: each node is hooked to its neighbour of the least priority, if that is below its own, and edges are drawn anew
    between what nodes are hooked to. Priorities are hashes that change each round, so a part of the nodes that doesn't depend on the shape
    (chains, stars) goes each round. What is left is contracted by one task on an executor.
    Loops and repeated edges are allowed; no edges, no rows.
    """
    stars = cut(edges.select("a", "b").mapInArrow(contract, "a long, b long"))
    if stars.count() <= task_edges:
        return stars.repartition(1).mapInArrow(contract, "a long, b long").select(F.col("a").alias("node"), F.col("b").alias("comp"))
    roots = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    left = stars.filter("a <> b")
    for k in range(most_rounds):
        if left.count() <= max(task_edges, 0):
            break
        priority = lambda c: F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        hooks = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min(priority("b")).alias("to"))
        hooks = cut(hooks.filter(F.col("to") < priority("a")).select(F.col("a").alias("x"), F.col("to.x").alias("y")))
        for c in ("a", "b"):
            left = left.join(hooks, left[c] == hooks["x"], "left").withColumn(c, F.coalesce("y", c)).drop("x", "y")
        left = cut(left.filter("a <> b").distinct())
        roots = cut(roots.join(hooks, roots["root"] == hooks["x"], "left").select("node", F.coalesce("y", "root").alias("root")))
    else:
        raise RuntimeError("components didn't settle")
    last = left.repartition(1).mapInArrow(contract, "a long, b long").select(F.col("a").alias("x"), F.col("b").alias("y"))
    roots = roots.join(last, roots["root"] == last["x"], "left").select("node", F.coalesce("y", "root").alias("root"))
    return roots.join(roots.groupBy("root").agg(F.min("node").alias("comp")), "root").select("node", "comp")
