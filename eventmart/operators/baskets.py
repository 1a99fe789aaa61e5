"""Which items share a basket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.session import shuffle_width

# A basket with more items than this is cut into blocks, so that no join key
# brings more than this many items together with as many others.
BLOCK_ITEMS = 500


def _side(items: DataFrame, keep: Sequence[str | Column], item: str, carry: Sequence[str], mark: str):
    return items.select(
        *keep,
        F.col(item).alias(f"{mark}_item"),
        *[F.col(c).alias(f"{mark}_{c}") for c in carry],
    )


def pair_up(
    items: DataFrame,
    basket: str,
    item: str,
    carry: Sequence[str] = (),
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Every unordered pair of different items of a basket, smaller key first.

    ``items`` holds each item of a basket once. The result has the basket,
    ``a_item``, ``b_item`` and the carried columns of both, prefixed ``a_`` and
    ``b_``.

    Ordinary baskets join with themselves on the basket id. The pairs of a large
    basket are spread over the cells of a triangle: its items fall into blocks
    by hash, and cell (x, y) with x <= y joins block x with block y. Each pair
    meets in exactly one cell, and a cell is one small join key.
    """
    # The work of a cell grows with the square of its bytes: a fixed width keeps
    # cells from being packed into one task because they look small.
    width = shuffle_width(items)
    # Stated once at the bottom: joins would add these filters branch by branch, and
    # branches that differ cannot share the shuffle that made the items distinct.
    items = items.filter(F.col(basket).isNotNull() & F.col(item).isNotNull())

    blocks = F.ceil(F.col("_items") / F.lit(block_items)).cast("int")
    large = (
        items.groupBy(basket)
        .agg(F.count("*").alias("_items"))
        .filter(F.col("_items") > block_items)
        .select(basket, blocks.alias("_blocks"))
    )

    # Leaving the large baskets out of one side is enough: the other finds no partner.
    ordinary = items.join(large, basket, "left_anti")
    pairs = (
        _side(ordinary, [basket], item, carry, "a")
        .join(_side(items, [basket], item, carry, "b"), basket)
        .filter(F.col("a_item") < F.col("b_item"))
    )

    block = F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")
    placed = items.join(large, basket).withColumn("_block", block)
    across = F.explode(F.sequence("_block", F.col("_blocks") - 1)).alias("_y")
    down = F.explode(F.sequence(F.lit(0), "_block")).alias("_x")
    x_side = _side(placed, [basket, F.col("_block").alias("_x"), across], item, carry, "p")
    y_side = _side(placed, [basket, down, F.col("_block").alias("_y")], item, carry, "q")
    cell = [basket, "_x", "_y"]
    placed_pairs = x_side.repartition(width, *cell).join(y_side.repartition(width, *cell), cell)
    met = placed_pairs.filter(
        (F.col("_x") < F.col("_y")) | (F.col("p_item") < F.col("q_item"))
    )
    ordered = F.col("p_item") < F.col("q_item")
    columns = ["item", *carry]
    spread = met.filter(F.col("p_item") != F.col("q_item")).select(
        basket,
        *[F.when(ordered, F.col(f"p_{c}")).otherwise(F.col(f"q_{c}")).alias(f"a_{c}") for c in columns],
        *[F.when(ordered, F.col(f"q_{c}")).otherwise(F.col(f"p_{c}")).alias(f"b_{c}") for c in columns],
    )
    return pairs.unionByName(spread)
