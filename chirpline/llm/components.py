"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirpline.llm.common import staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links every node's larger (or smaller) neighbours to its smallest one.

    The smallest neighbour comes from an aggregation that sums up before the
    shuffle, and a node with very many neighbours meets it in a join that can
    be split, so no task gets all neighbours of a node.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # the larger end sees its smaller neighbours only
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Written first, so that both sides of the join are plain shuffles, which Spark can split.
    least = staged(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
    met = both.join(least, "a")
    if large:
        out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; component is the smallest node reached.

    Alternates large-star and small-star steps (Kiveris et al., Connected
    Components in MapReduce and Beyond, 2014), each written to shared files,
    until the links are stars around the smallest node.
    """
    links = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    now = then = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not now.isEmpty():
        then = staged(_stars(_stars(now, large=True), large=False), "links")
        # A star forest: no node is linked to two others, and none that others link to is itself linked.
        twice = then.groupBy("a").count().filter("count > 1").select("a")
        passed = then.select("a").join(then.select(F.col("b").alias("a")), "a", "left_semi")
        if twice.unionByName(passed).isEmpty():
            break
        now = then
    hubs = then.select(F.col("b").alias("node")).distinct()
    return then.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        hubs.select("node", F.col("node").alias("component"))
    )


class Forest:
    """Links found in one task, kept as a spanning forest of its nodes 0 to n - 1."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, node: int, others: np.ndarray) -> None:
        labels = self.label[others]
        own = self.label[node]
        if (labels != own).any():
            found = np.unique(labels)
            least = min(found[0], own)
            change = np.zeros(len(self.label), dtype=bool)
            change[found] = change[own] = True
            self.label[change[self.label]] = least

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        nodes = np.flatnonzero(self.label != np.arange(len(self.label)))
        return nodes, self.label[nodes]
