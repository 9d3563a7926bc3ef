"""Connected components of an edge table, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

LINKS_PER_FILE = 100_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Alternating large-star and small-star steps: each step links the neighbours of a node to the
    smallest of them.  Every step is a shuffle by node with the minimum combined before it; the edge table
    never grows, and is written to the shared folder between steps, in as many files as its links ask for: a small
    table is not dealt over all shuffle partitions as a file each.  Ends when no link moves, after a number
    of rounds that grows with the logarithm of the component sizes.
    """
    links = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a > b").distinct()
    links = stored(links.select("a", "b"), "links")
    before, count = None, links.count()
    for _ in range(rounds):
        large = _large_star(links)
        links = stored(_small_star(large).coalesce(max(1, -(-count // LINKS_PER_FILE))), "links")
        # Two sums over the links: a star forest is a fixed point of both steps.
        after = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before, count = after, after[0]
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node, linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
