"""Connected components by alternating star contractions over an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.batches import stored


def _with_least(pairs: DataFrame, least: DataFrame, name: str) -> DataFrame:
    """The least neighbour of u beside each pair.

    The least are stored first: the join then stands on two shuffles of its own, and
    adaptive execution can split the many pairs of a hub.
    """
    return pairs.join(stored(least, name), "u")


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    """Link every larger neighbour of u to the least of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both.filter("v > u"), least, name).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    """Link u and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    # The pair that holds the least stays as it is; the others move to it.
    moved = _with_least(down, least, name)
    return moved.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of an edge table (a, b) of longs.

    ``component`` is the least node that can be reached. Each round halves chains and is
    written to the shared folder, so lineage stays short; only a count and a checksum come to
    the driver. Edges with a null end, loops and repeated edges change nothing.
    """
    now = stored(
        edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v").distinct(), name
    )
    sign = None
    for _ in range(most_rounds):
        large = stored(_large_star(now, name).distinct(), name)
        now = stored(_small_star(large, name).distinct(), name)
        # Decimal sums never overflow and do not depend on the order.
        found = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(found) == sign:
            break
        sign = tuple(found)
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def least_reached(ids: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Least id that each row reaches through a symmetric link matrix."""
    label = ids.copy()
    a, b = np.nonzero(links)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        if (label == before).all():
            return label
