"""Connected components of a link table, by star contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.workspace import written

ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that reaches a smaller one, ``root`` the smallest it reaches.

    Two steps in turn: every node's larger neighbours are linked to the smallest of its
    neighbours and itself, then its smaller neighbours are. Both keep what is connected; once
    neither changes a row, every node hangs on its root. Each round is written to the shared
    folder, so a lost executor repeats one round at most. The smallest neighbours are found
    with partial aggregates and written, so that the join with them has an exchange on either side
    and Spark can split a node with very many links over tasks.

    Raises if ``ROUNDS`` rounds do not settle it; the number needed grows with the logarithm of
    the longest path.
    """
    edges = written(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(
            both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least"
        )
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = written(small, "small")
        now = _state(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))
    ).first()
