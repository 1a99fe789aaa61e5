"""Measures behind the two dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.plans.analysis import Tables, daily_revenue, item_totals, percent, with_share
from eventmart.plans.facts import trading_dates


def for_event(table: DataFrame, event_name: str) -> DataFrame:
    """One event at a time; dates outside any event carry no event's name."""
    return table.filter(F.col("event_name") == event_name)


def latest_event(dates: DataFrame) -> DataFrame:
    """The dates of the newest event.

    The comparison with a single value marks the dates as a selective side: a
    join of sale lines with them reads the partitions of these dates alone.
    """
    newest = dates.agg(F.max("event_start_date")).scalar()
    return dates.filter(F.col("event_start_date") == newest)


def headline_tiles(table: Tables) -> DataFrame:
    """Days, transactions, units and products of every event.

    Each count is a grouping of its own with combining before the shuffle. Two
    distinct counts in a single grouping would copy every row once per count.
    """
    dates = table("dim_date")
    lines = table("fact_sales_line").join(
        trading_dates(dates, "date_key", "event_name"), "date_key"
    )
    days = (
        dates.filter("is_trading_day").groupBy("event_name").agg(F.count("*").alias("days"))
    )
    baskets = (
        lines.groupBy("event_name")
        .agg(F.count_distinct("transaction_id").alias("transactions"))
    )
    goods = (
        lines.groupBy("event_name", "item_key")
        .agg(F.sum("quantity").alias("units"))
        .groupBy("event_name")
        .agg(F.sum("units").alias("units_sold"), F.count("*").alias("products_sold"))
    )
    return days.join(baskets, "event_name").join(goods, "event_name").select(
        "event_name", "days", "transactions", "units_sold", "products_sold"
    )


def revenue_index(table: Tables) -> DataFrame:
    """Each day against the first day of its event (= 100), with the event's average."""
    event = Window.partitionBy("event_name")
    in_order = event.orderBy("full_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    days = daily_revenue(table).withColumns(
        {
            "_first": F.first("daily_revenue").over(in_order),
            "_sum": F.sum("daily_revenue").over(event),
            "_days": F.count("*").over(event),
        }
    )
    return days.select(
        "event_name",
        "convention_day",
        "full_date",
        percent(F.col("daily_revenue"), F.col("_first"), 1).alias("revenue_index"),
        percent(F.col("_sum"), F.col("_first") * F.col("_days"), 1).alias("average_index"),
    )


def item_revenue_share(table: Tables, places: int = 12) -> DataFrame:
    """The products that carry the revenue."""
    by_name = (
        item_totals(table)
        .join(table("dim_item").select("item_key", "item_name"), "item_key")
        .groupBy("item_name")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        with_share(by_name, "revenue", "revenue_share")
        .orderBy(F.desc("revenue"), "item_name")
        .select("item_name", "revenue_share")
        .limit(places)
    )


def item_day_units(table: Tables) -> DataFrame:
    """Units per item name and event day, zero days included."""
    return (
        table("fact_item_daily")
        .groupBy("event_name", "item_name", "full_date", "convention_day", "day_in_event")
        .agg(F.sum("quantity").alias("units"))
    )


def item_day_heatmap(table: Tables) -> DataFrame:
    return item_day_units(table).select("event_name", "item_name", "convention_day", "units")


def item_day_heatmap_wide(table: Tables, days: int) -> DataFrame:
    """The heatmap as it is drawn: a row an item and event, a column for each of so many days.

    With the days given, the pivot needs no pass to find them. A day that an event does not have
    is NULL; an event of more days is an error and is not cut.
    """
    longest = table("dim_date").agg(F.max("day_in_event")).first()[0] or 0
    if longest > days:
        raise ValueError(f"an event has {longest} days, more than {days}")
    wide = (
        item_day_units(table)
        .groupBy("event_name", "item_name")
        .pivot("day_in_event", list(range(1, days + 1)))
        .agg(F.sum("units"))
    )
    return wide.select("event_name", "item_name", *[F.col(str(day)).alias(f"day_{day}") for day in range(1, days + 1)])


def velocity_dense(table: Tables) -> DataFrame:
    """Change of units against the day before, with its direction.

    The first day has nothing before it. It is dropped after the comparison: a
    filter beforehand would leave the second day without a neighbour.
    """
    by_day = Window.partitionBy("event_name", "item_name").orderBy("full_date")
    change = F.col("unit_change")
    return (
        item_day_units(table)
        .withColumn("prev_units", F.lag("units").over(by_day))
        .withColumn("unit_change", F.col("units") - F.col("prev_units"))
        .withColumn(
            "direction",
            # A missing value is tested first, or it would pass for "no change".
            F.when(change.isNull(), "no prior day")
            .when(change > 0, "gained")
            .when(change < 0, "declined")
            .otherwise("no change"),
        )
        .filter(F.col("day_in_event") > 1)
        .select(
            "event_name", "item_name", "convention_day", "prev_units", "units", "unit_change", "direction"
        )
    )


def dropped_to_zero(table: Tables) -> DataFrame:
    """Items that sold the day before and not at all on this one."""
    by_day = Window.partitionBy("event_name", "item_key").orderBy("full_date")
    return (
        table("fact_item_daily")
        .withColumn("prev_units", F.lag("quantity").over(by_day))
        .filter((F.col("quantity") == 0) & (F.col("prev_units") > 0))
        .select("event_name", "item_key", "item_name", "convention_day", "prev_units")
    )


def transactions_by_hour(table: Tables) -> DataFrame:
    days = trading_dates(table("dim_date"), "date_key", "event_name", "convention_day")
    return (
        table("fact_sales_line")
        .groupBy("date_key", "hour_of_day")
        .agg(F.count_distinct("transaction_id").alias("transactions"))
        .join(days, "date_key")
        .select("event_name", "convention_day", "hour_of_day", "transactions")
    )


def peak_hour(table: Tables) -> DataFrame:
    """The busiest hour of every day; hours with equal counts all appear."""
    busiest = Window.partitionBy("event_name", "convention_day").orderBy(F.desc("transactions"))
    return (
        transactions_by_hour(table)
        .withColumn("rnk", F.rank().over(busiest))
        .filter(F.col("rnk") == 1)
        .drop("rnk")
    )


def top_pairs(table: Tables, places: int = 15) -> DataFrame:
    return (
        table("fact_item_pairs")
        .select("event_name", "pair_label", "baskets", "item_pair_key")
        .orderBy(F.desc("baskets"), "event_name", "pair_label", "item_pair_key")
        .limit(places)
    )


def pairs_for_item(table: Tables, items: DataFrame) -> DataFrame:
    """Pairs that contain any of the items (``item_key``), on whichever side."""
    members = table("bridge_item_pair").join(items.select("item_key"), "item_key", "left_semi")
    pairs = table("fact_item_pairs").select(
        "item_pair_key", "event_name", "pair_label", "baskets"
    )
    return members.join(pairs, "item_pair_key").select(
        "item_key", "item_pair_key", "event_name", "pair_label", "baskets"
    )


def best_selling_item(table: Tables) -> DataFrame:
    """Key of the item with the most units: one row."""
    return item_totals(table).orderBy(F.desc("units"), "item_key").limit(1).select("item_key")


def units_of_latest_event(table: Tables) -> DataFrame:
    """Units and transactions per item, for the newest event only."""
    newest = latest_event(table("dim_date")).select("date_key", "event_name")
    return (
        table("fact_sales_line")
        .join(newest, "date_key")
        .groupBy("event_name", "item_key")
        .agg(
            F.sum("quantity").alias("units"),
            F.count_distinct("transaction_id").alias("transactions"),
        )
        .join(table("dim_item").select("item_key", "item_name"), "item_key")
        .select("event_name", "item_key", "item_name", "units", "transactions")
    )


def trading_hours(table: Tables) -> DataFrame:
    """First and last hour with a sale on every event day."""
    days = trading_dates(table("dim_date"), "date_key", "event_name", "convention_day")
    return (
        table("fact_sales_line")
        .groupBy("date_key")
        .agg(F.min("hour_of_day").alias("first_hour"), F.max("hour_of_day").alias("last_hour"))
        .join(days, "date_key")
        .select("event_name", "convention_day", "first_hour", "last_hour")
    )
