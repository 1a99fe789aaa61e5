"""The numbered questions, asked of the star tables.

Item labels join sales that were summed to item keys, so that join sees one row an
item, and a key that holds a large part of all sales is combined where it is read.
Trading days, one row a date, join the lines themselves. No join here carries a broadcast hint: Spark decides from the sizes of the
written tables and revises the choice while it runs.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import packed_key
from eventmart.operators.baskets import BLOCK_ITEMS, pair_up
from eventmart.plans.facts import trading_dates
from eventmart.session import written

Tables = Callable[[str], DataFrame]

HUNDRED = Decimal(100)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole in decimals; NULL where there is nothing to compare with."""
    return F.round(F.lit(HUNDRED) * part / F.nullif(whole, F.lit(0)), digits)


def with_share(table: DataFrame, measure: str, name: str, digits: int = 1) -> DataFrame:
    """Adds each row's percentage of the total of ``measure``."""
    # The total sums every measure, so that it reads the very shuffle the table
    # itself is read from instead of a narrower one of its own.
    sums = [F.sum(c).alias(c) for c, kind in table.dtypes if kind.startswith("decimal")]
    total = table.agg(F.struct(*sums).alias("t")).scalar()[measure]
    return table.withColumn(name, percent(F.col(measure), total, digits))


def item_totals(table: Tables) -> DataFrame:
    """Units and revenue per item key over the trading days."""
    return (
        table("fact_sales_line")
        .join(trading_dates(table("dim_date"), "date_key"), "date_key")
        .groupBy("item_key")
        .agg(F.sum("quantity").alias("units"), F.sum("net_sales").alias("revenue"))
    )


def _categorised_totals(table: Tables) -> DataFrame:
    items = table("dim_item").select("item_key", "item_name", "category_key")
    return (
        item_totals(table)
        .join(items, "item_key")
        .join(table("dim_category"), "category_key")
        .select("category_name", "item_name", "units", "revenue")
    )


def revenue_by_category(table: Tables) -> DataFrame:
    by_category = (
        _categorised_totals(table)
        .groupBy("category_name")
        .agg(F.sum("units").alias("units_sold"), F.sum("revenue").alias("revenue"))
    )
    return with_share(by_category, "revenue", "pct_of_total").orderBy(
        F.desc("revenue"), "category_name"
    )


def top_items_per_category(table: Tables, places: int = 3) -> DataFrame:
    """Best sellers by revenue in each category; equal revenue shares a rank."""
    by_item = (
        _categorised_totals(table)
        .groupBy("category_name", "item_name")
        .agg(F.sum("revenue").alias("revenue"))
    )
    best_first = Window.partitionBy("category_name").orderBy(F.desc("revenue"))
    return (
        by_item.withColumn("rnk", F.rank().over(best_first))
        .filter(F.col("rnk") <= places)
        .orderBy("category_name", "rnk", "item_name")
    )


def daily_revenue(table: Tables) -> DataFrame:
    days = trading_dates(
        table("dim_date"), "date_key", "event_name", "convention_day", "day_in_event", "full_date"
    )
    return (
        table("fact_sales_line")
        .groupBy("date_key")
        .agg(F.sum("net_sales").alias("daily_revenue"))
        .join(days, "date_key")
        .drop("date_key")
    )


def cumulative_revenue(table: Tables) -> DataFrame:
    """Running revenue that starts anew with every event."""
    so_far = (
        Window.partitionBy("event_name")
        .orderBy("full_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        daily_revenue(table)
        .select(
            "event_name",
            "convention_day",
            "full_date",
            "daily_revenue",
            F.sum("daily_revenue").over(so_far).alias("cumulative_revenue"),
        )
        .orderBy("full_date")
    )


def basket_lines(table: Tables) -> DataFrame:
    """One row per basket and day with its line count, units and value."""
    return (
        table("fact_sales_line")
        .join(trading_dates(table("dim_date"), "date_key"), "date_key")
        .groupBy("transaction_id", "date_key")
        .agg(
            F.count("*").alias("lines_in_basket"),
            F.sum("quantity").alias("units"),
            F.sum("net_sales").alias("basket_value"),
        )
    )


def basket_stats(table: Tables) -> DataFrame:
    """Value and size of baskets per event day."""
    days = trading_dates(table("dim_date"), "date_key", "event_name", "convention_day")
    per_date = (
        basket_lines(table)
        .groupBy("date_key")
        .agg(
            F.count("*").alias("transactions"),
            F.sum("basket_value").alias("_value"),
            F.sum("units").alias("_units"),
            F.max("basket_value").alias("largest_basket"),
        )
    )
    # An event has one date per day number, so a date is already the result's grain.
    return (
        per_date.join(days, "date_key")
        .select(
            "event_name",
            "convention_day",
            "transactions",
            F.round(F.col("_value") / F.col("transactions"), 2).alias("avg_basket_value"),
            F.round(F.col("_units") / F.col("transactions"), 2).alias("avg_units_per_basket"),
            "largest_basket",
        )
        .orderBy("event_name", "convention_day")
    )


def hourly_curve(table: Tables) -> DataFrame:
    """Transactions and revenue per hour of each event day."""
    days = trading_dates(table("dim_date"), "date_key", "event_name", "convention_day")
    by_hour = (
        table("fact_sales_line")
        .filter(F.col("hour_of_day").isNotNull())
        .groupBy("date_key", "hour_of_day")
        .agg(
            F.count_distinct("transaction_id").alias("transactions"),
            F.sum("net_sales").alias("revenue"),
        )
    )
    return (
        by_hour.join(days, "date_key")
        .select("event_name", "convention_day", "hour_of_day", "transactions", "revenue")
        .orderBy("event_name", "convention_day", "hour_of_day")
    )


def items_bought_together(
    table: Tables, places: int = 15, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Pairs of item names by how many pairs of lines bring them together.

    Lines of one item in one basket are counted first; two such counts multiply
    to the number of line pairs, so repeated lines never meet one by one.
    """
    item = packed_key("item_key").alias("item")
    lines = table("fact_sales_line").groupBy("transaction_id", item).agg(F.count("*").alias("lines"))
    met = (
        pair_up(lines, "transaction_id", "item", ["lines"], block_items)
        .groupBy("a_item", "b_item")
        .agg(F.sum(F.col("a_lines") * F.col("b_lines")).alias("times"))
    )
    # Written, so that the shuffles of the self-join are gone before those of the names come.
    met = written(met, "pairs-met")
    names = table("dim_item").select(packed_key("item_key"), "item_name")
    return (
        met.join(names.toDF("a_item", "item_a"), "a_item")
        .drop("a_item")
        .join(names.toDF("b_item", "item_b"), "b_item")
        .groupBy("item_a", "item_b")
        .agg(F.sum("times").alias("times_bought_together"))
        .filter(F.col("times_bought_together") > 1)
        .orderBy(F.desc("times_bought_together"), "item_a", "item_b")
        .limit(places)
    )


def velocity_sparse(table: Tables, places: int = 15) -> DataFrame:
    """Change of units against the item's previous selling day in the same event.

    Days without a sale have no row here and are skipped over; the dense
    variant counts them as zero.
    """
    days = trading_dates(
        table("dim_date"), "date_key", "event_name", "full_date", "convention_day"
    )
    names = table("dim_item").select("item_key", "item_name", "category_name")
    daily = (
        table("fact_sales_line")
        .groupBy("item_key", "date_key")
        .agg(F.sum("quantity").alias("units"))
        .join(days, "date_key")
        .join(names, "item_key")
        .groupBy("item_name", "category_name", "event_name", "full_date", "convention_day")
        .agg(F.sum("units").alias("units"))
    )
    # Two items may share a name; the category settles which of them comes first.
    by_day = Window.partitionBy("item_name", "event_name").orderBy("full_date", "category_name")
    change = F.col("today_units") - F.col("prev_day_units")
    return (
        daily.withColumn("prev_day_units", F.lag("units").over(by_day))
        .filter(F.col("prev_day_units").isNotNull())
        .withColumnRenamed("units", "today_units")
        .select(
            "item_name",
            "category_name",
            "event_name",
            "convention_day",
            "prev_day_units",
            "today_units",
            change.alias("unit_change"),
            F.when(
                F.col("prev_day_units") > 0, percent(change, F.col("prev_day_units"), 0)
            ).alias("pct_change"),
        )
        .orderBy(
            F.desc_nulls_last("unit_change"),
            "item_name",
            "category_name",
            "event_name",
            "convention_day",
            "prev_day_units",
        )
        .limit(places)
    )


# The numbered set: every question by its number.
ANALYSES: dict[int, Callable[[Tables], DataFrame]] = {
    1: revenue_by_category,
    2: top_items_per_category,
    3: cumulative_revenue,
    4: basket_stats,
    5: hourly_curve,
    6: items_bought_together,
    7: velocity_sparse,
}


def run_analyses(table: Tables, only: int | None = None) -> dict[int, DataFrame]:
    """All numbered questions, or one of them, as lazy results."""
    chosen = ANALYSES if only is None else {only: ANALYSES[only]}
    return {number: ask(table) for number, ask in chosen.items()}
