"""Connected components of a link table, by alternating star contraction.

Every round is one or two shuffles over the links that are left and is written to
the shared folder, so a lost executor repeats one round at most.  A round ends
with links from every node to smaller neighbours only; the rounds stop when the
links are stars.  No node's neighbours are gathered: they only meet in a ``min``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import delete_path
from tidemark.session import materialise_at


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: each larger neighbour of a node is linked to the node's smallest
    neighbour (itself included).  Small star: each smaller one, and the node."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.filter("b < a")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node
    reachable.  Roots themselves have no row.  ``links`` may hold either direction,
    repeats and self-links; null ends are ignored."""
    spark = links.sparkSession
    clean = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    state, path = materialise_at(clean, "links")
    while True:
        rows, total = _signature(state)
        if not rows:
            break
        after, after_path = materialise_at(_star(_star(state, True), False), "links")
        same = _signature(after) == (rows, total)
        delete_path(spark, path)
        state, path = after, after_path
        if same:
            break
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _signature(links: DataFrame) -> tuple[int, int]:
    """Number of links and a sum of their hashes, to see that nothing changed."""
    row = links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).head()
    return int(row[0]), int(row[1])
