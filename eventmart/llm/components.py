"""Connected components of a link table, by alternating large and small stars.

Each round points a node's neighbours at the smallest node around it, first those
above the node, then those below. Rounds are written to the shared folder; a table
that a round leaves unchanged is a forest of stars around the smallest nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.runtime import materialise


def _fingerprint(pairs: DataFrame) -> tuple:
    """Count and order-free digest of a table of pairs."""
    mixed = F.xxhash64("high", "low")
    row = pairs.agg(
        F.count("*"), F.sum(mixed.cast("decimal(20,0)")), F.bit_xor(F.xxhash64("low", "high"))
    ).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every node with a link.

    Nodes may be of any ordered type. Links to oneself, repeats and nulls don't matter.
    An empty table of links gives an empty result.
    """
    a, b = F.col(left), F.col(right)
    pairs = materialise(
        links.where(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct(),
        "components",
    )
    before = _fingerprint(pairs)
    while before[0]:
        both = pairs.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            pairs.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
        large = (
            both.join(least, "node")
            .where("other > node")
            .select(F.col("other").alias("high"), F.col("least").alias("low"))
            .distinct()
        )
        large = materialise(large, "components")
        below = large.groupBy("high").agg(F.min("low").alias("least"))
        small = (
            large.join(below, "high")
            .where("low <> least")
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
            .unionByName(below.select("high", F.col("least").alias("low")))
            .distinct()
        )
        pairs = materialise(small, "components")
        after = _fingerprint(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        pairs.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
