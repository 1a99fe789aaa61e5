"""Trading days and the events they form.

Everything here works on one row per calendar date. Sales are summed to days
before any window runs, so the windows without a partition see a few thousand
rows however many sales there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: more silent days than this between two trading days start a new event.
EVENT_GAP_DAYS = 7

CATALOG_LINE = "ITEM"


def _unit_price() -> Column:
    """Price of one unit of a catalog line; NULL for every other line.

    An amount typed at the terminal is no product and says nothing about prices.
    """
    priced = (
        (F.col("itemization_type") == CATALOG_LINE)
        & (F.col("quantity") > 0)
        & (F.col("gross_sales") > 0)
    )
    return F.when(priced, F.col("gross_sales") / F.col("quantity"))


def catalog_floor(sales: DataFrame) -> DataFrame:
    """Cheapest unit price of a catalog item: one row, NULL without any."""
    return sales.agg(F.min(_unit_price()).alias("floor_amount"))


def classify_days(sales: DataFrame) -> DataFrame:
    """One row per sale date with its takings and whether it was a trading day.

    A day that took less than the cheapest item costs holds no finished sale.
    Takings and floor come from a single pass over the sales: the floor is taken
    per day first and then over the days, undated lines included.
    """
    days = sales.groupBy("sale_date").agg(
        F.sum("net_sales").alias("day_net_sales"),
        F.min(_unit_price()).alias("_day_floor"),
    )
    all_days = Window.partitionBy()
    floor = F.coalesce(F.min("_day_floor").over(all_days), F.lit(0))
    return (
        days.withColumn("_floor", floor)
        .filter(F.col("sale_date").isNotNull())
        .select(
            "sale_date",
            "day_net_sales",
            (F.col("day_net_sales") >= F.col("_floor")).alias("is_trading_day"),
        )
    )


def mark_event_starts(days: DataFrame, gap_days: int = EVENT_GAP_DAYS) -> DataFrame:
    """Adds the previous trading day and whether a new event starts here.

    Partitioning by the flag keeps idle dates out of the neighbourhood of
    trading days without splitting the table and joining it again.
    """
    in_order = Window.partitionBy("is_trading_day").orderBy("sale_date")
    previous = F.lag("sale_date").over(in_order)
    fresh = F.col("prev_date").isNull() | (
        F.date_diff("sale_date", "prev_date") > gap_days
    )
    return days.withColumn("prev_date", previous).withColumn(
        "is_event_start", F.when(fresh, 1).otherwise(0)
    )


def number_events(marked: DataFrame) -> DataFrame:
    """Running count of event starts; every day of one island gets its number."""
    so_far = (
        Window.partitionBy("is_trading_day")
        .orderBy("sale_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return marked.withColumn("event_number", F.sum("is_event_start").over(so_far))


def number_days(numbered: DataFrame) -> DataFrame:
    """First date of each event and each day's place in it."""
    event = Window.partitionBy("is_trading_day", "event_number")
    return numbered.withColumns(
        {
            "event_start_date": F.min("sale_date").over(event),
            "day_in_event": F.row_number().over(event.orderBy("sale_date")),
        }
    )
