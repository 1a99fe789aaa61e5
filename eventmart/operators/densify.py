"""Rows for what did not happen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.session import shuffle_width


def numbered(days: DataFrame, order: str) -> DataFrame:
    """Days counted from one; the window sees one row per calendar date."""
    return days.withColumn("_slot", F.row_number().over(Window.orderBy(order)))


def unfold_over_days(items: DataFrame, days: DataFrame, order: str) -> DataFrame:
    """One row per item and day: each item counts through the days where it is read.

    The labels of a day then join by its number.
    """
    calendar = numbered(days, order)
    last = calendar.agg(F.max("_slot")).scalar()
    slots = F.explode(F.sequence(F.lit(1), last)).alias("_slot")
    spread = items.repartition(shuffle_width(items), *items.columns)
    return spread.select("*", slots).join(calendar, "_slot").drop("_slot")


def fill_days(
    sold: DataFrame,
    items: DataFrame,
    days: DataFrame,
    item: str,
    day: str,
    order: str,
    measures: Sequence[str],
) -> DataFrame:
    """One row per item and day with the measures of ``sold``, or NULL where nothing was sold.

    Each sold day is stretched up to the next sold day of its item, and a day
    zero in front of every item covers what comes before the first sale. Only the
    sold days and the items are shuffled, by item; the missing rows come into
    being afterwards and never move. An item has at most one row per calendar
    date, so no item outgrows a task.
    """
    calendar = numbered(days, order)
    last = calendar.agg(F.max("_slot")).scalar()
    slots = calendar.select(day, "_slot")
    labels = [c for c in items.columns if c != item]

    stops = (
        items.withColumn("_slot", F.lit(0))
        .withColumn("_known", F.lit(True))
        .unionByName(sold.join(slots, day).drop(day), allowMissingColumns=True)
        .repartition(shuffle_width(items), item)
    )
    in_order = Window.partitionBy(item).orderBy("_slot")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("_slot").over(in_order), last + 1)
    stretched = (
        stops.withColumns(
            {
                "_until": until,
                "_is_item": F.first("_known").over(so_far),
                **{c: F.first(c).over(so_far) for c in labels},
            }
        )
        .filter("_is_item")
        .withColumn("_day", F.explode(F.sequence("_slot", F.col("_until") - 1)))
    )
    happened = F.col("_day") == F.col("_slot")
    return (
        stretched.filter(F.col("_day") > 0)
        .select(
            item,
            *labels,
            F.col("_day"),
            *[F.when(happened, F.col(m)).alias(m) for m in measures],
            happened.alias("happened"),
        )
        .join(calendar.withColumnRenamed("_slot", "_day"), "_day")
        .drop("_day")
    )
