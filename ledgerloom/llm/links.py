"""Connected groups of linked nodes, found on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .tables import discarded, written


class Joined:
    """Which rows have been joined so far."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        while x != (up := self.above.get(x, x)):
            self.above[x] = self.above.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        """False if they were joined before."""
        x, y = self.root(x), self.root(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes with links; a component is named by its smallest node.

    Alternates two steps until nothing changes: each node points its larger neighbours
    to the smallest node it knows, then its smaller neighbours as well. Every round is
    a few joins and sums over the links and is kept as a table in the shared folder.
    """
    links, state = _kept(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())
    while state[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy(F.col("a").alias("hub")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = (
            both.join(least, F.col("a") == F.col("hub"))
            .filter("b > hub")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        least = large.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("least"))
        small = (
            large.join(least, F.col("a") == F.col("hub"))
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("l"))
            .select("l.a", "l.b")
            .filter("a <> b")
            .distinct()
        )
        before, (after, state) = state, _kept(small)
        discarded(links)
        links = after
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a table, and what is equal for equal sets of them: their number and a sum of hashes."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b") % 1_000_000_007)
    table = written(links.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(total, F.lit(0)).alias("sum")), "links")
    found = seen.get
    return table, (found["n"], found["sum"])
