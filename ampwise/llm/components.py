"""Connected components of a graph given as edges of 64-bit integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampwise.llm.common import stored

#: A task's forest is passed on once it has so many nodes.
FOREST_NODES = 1_000_000


class Forest:
    """Union-find whose root is the smallest member."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a: int, b: int) -> int:
        a, b = self.find(a), self.find(b)
        if a != b:
            a, b = min(a, b), max(a, b)
            self.parent[b] = a
        return a

    def stars(self) -> tuple[list[int], list[int]]:
        """(node, root) of every node that isn't its root."""
        out = [(x, r) for x in list(self.parent) if (r := self.find(x)) != x]
        return [x for x, _ in out], [r for _, r in out]


def forest_batches(pairs):
    """Arrow batches (a, b) of the stars of a stream of (a, b) lists, a bounded forest at a time."""
    import pyarrow as pa

    def batch(f: Forest):
        a, b = f.stars()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    forest = Forest()
    for xs, ys in pairs:
        for x, y in zip(xs, ys):
            if x != y:
                forest.union(x, y)
        if len(forest.parent) > FOREST_NODES:
            yield batch(forest)
            forest = Forest()
    yield batch(forest)


def _contract(edges: DataFrame) -> DataFrame:
    """Within each partition, replace edges by the stars of their forest."""
    def run(batches):
        yield from forest_batches((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge. Loops on a
    node and nulls are ignored.

    Alternates the large-star and small-star steps (each node passes its smallest neighbour
    to its larger, then to its smaller neighbours) until a round changes nothing. Every round
    is a written table; a node's many edges are combined before the shuffle by min."""
    e = _contract(edges.where(F.col("a") != F.col("b")))
    e = stored(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if before == (mark["n"], mark["h"]) or not mark["n"]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = (mark["n"], mark["h"])
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a != b")
        e = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
