"""Connected components of a link table, without bringing the links to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewarden.session import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per node ``u`` its smallest neighbour; the minimum is taken before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour, or to itself."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_smallest(both), "u")
    return joined.filter(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.least("u", "least").alias("v")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").filter(F.col("v") != F.col("least"))
    return moved.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
        least.select("u", F.col("least").alias("v"))
    )


def _state(links: DataFrame) -> tuple:
    """Count and an order-free checksum of the links."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
    ).first()
    return row["n"], row["sum"]


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that each linked node can reach.

    ``links`` has long columns u and v; self links and repeated links do not matter. Each
    round is a large star and a small star step, written to the shared folder. Paths shrink
    with every round; the loop ends when a round changes nothing, and then each node has one
    link, to its root. Nodes without a link to another node are not in the result.
    """
    links = links.filter(F.col("u") != F.col("v")).select("u", "v").distinct()
    links = materialize(links, "links")
    state = _state(links)
    while state[0]:
        starred = materialize(_large_star(links).distinct(), "large_star")
        links = materialize(_small_star(starred).distinct(), "small_star")
        previous, state = state, _state(links)
        if state == previous:
            break
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(leaves.select(F.col("root"), F.col("root")).distinct())
