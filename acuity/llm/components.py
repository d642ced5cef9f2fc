"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acuity.session import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: hang the larger (or else the smaller) neighbours of each node on the least of them all.

    ``edges`` has a > b. The least neighbour is an aggregate joined back, so that
    Spark can split the join where a node has very many neighbours.
    """
    ways = edges.select("a", "b")
    if large:
        ways = ways.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ways.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    joined = ways.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, root): the least node that each node of an edge can reach.

    ``edges`` has two long columns (a, b) in any direction; loops, repeats and edges
    with a NULL end are of no effect. Alternates large-star and small-star rounds
    (Kiveris et al. 2014) until the edges stay the same; each round is written to the
    shared folder. An empty table gives an empty result.
    """
    now = edges.where(F.col("a") != F.col("b"))
    now = now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, "edges", folder)
    while True:
        new = stored(_star(stored(_star(now, True), "edges", folder), False), "edges", folder)
        if _state(new) == _state(now):
            return new.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        now = new


def _state(edges: DataFrame) -> tuple:
    """Number and an order-free digest of the edges, which are distinct."""
    one = F.xxhash64("a", "b")
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(one), F.sum(F.pmod(one, F.lit(1 << 24)))).first()
    )
