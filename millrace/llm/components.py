"""Connected components of an undirected graph, as Spark rounds over its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import release
from millrace.session import settle


class Forest:
    """Union-find over the nodes that one task meets."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent, top = self.parent, x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        """Link two nodes; False if they were connected already."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def components(links: DataFrame) -> DataFrame:
    """``links`` (a bigint, b bigint) to one row (node, component) per linked node.

    ``component`` is the smallest node reachable. Alternating rounds hang every
    larger neighbour, then every smaller one, under the smallest neighbour known;
    the rounds end when nothing moves. A round shuffles the links, whose number never
    grows; each is checkpointed, so a lost executor costs a round at most. Nodes with
    NULL ends are ignored; no links give no rows.
    """
    edges = settle(links.toDF("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct())
    state = _state(edges)
    while state[0]:
        edges = settle(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
        release(links.sparkSession)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _state(edges):
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"),
                    F.expr("sum(xxhash64(v, u) % 1000003)")).first()
    return tuple(row)


def _large_star(edges):
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges):
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least, "u").where("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
