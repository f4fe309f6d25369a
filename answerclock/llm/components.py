"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.operators.storage import stored


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    ).first()
    return tuple(row)


def _pull(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Tie each node's neighbours to the least node around it.

    ``larger_only``: those above the node, seen from both ends (large star); else the
    node itself and those below it (small star). The least one is a plain aggregate and
    a join, so a node with very many neighbours is spread over tasks.
    """
    if larger_only:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges
    least = seen.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    pulled = seen.join(least, "a")
    if larger_only:
        ties = pulled.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        ties = pulled.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return ties.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b): the least node it is linked to.

    The number of rounds grows with the logarithm of the longest chain; each round is stored.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stored(edges.distinct())
    before = _digest(edges)
    while before[0]:
        edges = stored(_pull(_pull(edges, True), False))
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
