"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.scratch import folder, written


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of the links (a, b) with the smallest node it can reach.

    Each round hangs a node's greater neighbours on its smallest one, then its smaller ones; a path
    of n links becomes a star in about log n rounds. A node with very many neighbours sends one
    partial minimum for each task, and its join is one that Spark can split. Rounds are written to two folders in turn, so
    disk holds two of them, however many there are.
    """
    spark = links.sparkSession
    folders, rounds = [folder(spark, "stars"), folder(spark, "stars")], 0
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20, 0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = hung.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()
        path = folders[rounds % 2]
        stars.write.mode("overwrite").parquet(path)
        edges, rounds = spark.read.schema(stars.schema).parquet(path), rounds + 1
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


class Union:
    """Union-find over values of one task; the smallest value of a set is its root."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def links(self) -> list[tuple]:
        """(value, root) of every value that is not a root."""
        return [(x, self.root(x)) for x in list(self.up) if self.root(x) != x]
