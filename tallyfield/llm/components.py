"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.session import pin


def _state(edges: DataFrame) -> tuple:
    """Number and fingerprint of distinct links; xor cannot overflow, however many there are."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour per node; partial sums make a node of very many links cheap."""
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    Each round points every larger neighbour of a node at the node's smallest neighbour (large star),
    then every smaller one (small star). The number of rounds grows with the logarithm of the longest
    path; each round is written to the shared folder, so lineage stays short and a lost executor costs
    a re-read. Links are never collected; nulls and self-links are dropped.
    """
    edges = pin(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        # Large star: both directions, smallest neighbour or self, larger neighbours move there.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both)
        large = (
            both.join(least, "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        )
        large = pin(large.filter("a != b").distinct(), "large-star")
        # Small star: every node's smaller neighbours, and the node itself, move to the smallest.
        small = large.join(_least(large), "a")
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        kept = large.groupBy("a").agg(F.min("b").alias("b"))
        nxt = pin(moved.unionByName(kept).distinct(), "small-star")
        now = _state(nxt)
        edges, done, state = nxt, now == state, now
        if done:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
