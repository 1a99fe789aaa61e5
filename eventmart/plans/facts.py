"""Facts and the pair bridge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import packed_key, pair_label, surrogate_key, unpacked_key
from eventmart.operators.baskets import BLOCK_ITEMS, pair_up
from eventmart.operators.densify import fill_days, unfold_over_days

DAY_LABELS = ["date_key", "full_date", "convention_day", "day_in_event", "event_name"]


def trading_dates(dates: DataFrame, *columns: str) -> DataFrame:
    """The given columns of the trading days: one row per calendar date.

    Nothing here forces a broadcast. The written date table is small and Spark
    sees that from its files; should it ever exceed the threshold, the join
    shuffles instead.
    """
    return dates.filter("is_trading_day").select(*columns)


def sales_line_fact(sales: DataFrame) -> DataFrame:
    """One row per sold line.

    Dimension keys are hashed again instead of looked up: no join, no shuffle
    and no way to lose a row.
    """
    uid = (
        [
            surrogate_key("transaction_id", "item_natural_key", "sale_time", "line_no").alias(
                "sale_line_uid"
            )
        ]
        if "line_no" in sales.columns
        else []
    )
    return sales.select(
        surrogate_key("transaction_id", "item_natural_key", "sale_time").alias("sale_line_key"),
        *uid,
        "transaction_id",
        surrogate_key("item_natural_key").alias("item_key"),
        "sale_time",
        F.substring("sale_time", 1, 2).cast("smallint").alias("hour_of_day"),
        "location_id",
        "device_name_key",
        "channel",
        "quantity",
        "gross_sales",
        "discounts",
        "net_sales",
        "tax",
        surrogate_key("sale_date").alias("date_key"),
    )


def item_day_actuals(lines: DataFrame) -> DataFrame:
    """What was sold per item and date; no row where nothing was."""
    return lines.groupBy("item_key", "date_key").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("net_sales").alias("net_sales"),
        F.sum("gross_sales").alias("gross_sales"),
        F.count_distinct("transaction_id").alias("transactions"),
    )


def item_day_grid(items: DataFrame, dates: DataFrame) -> DataFrame:
    """Every item on every trading day, with the labels of both."""
    return unfold_over_days(
        items.select("item_key", "item_name", "category_name"),
        trading_dates(dates, *DAY_LABELS),
        order="full_date",
    )


DAY_MEASURES = ["quantity", "net_sales", "gross_sales", "transactions"]


def packed_item_days(lines: DataFrame) -> DataFrame:
    """What was sold per item and date, by packed keys."""
    return item_day_actuals(lines.withColumns({key: packed_key(key) for key in ("item_key", "date_key")}))


def dense_item_days(items: DataFrame, dates: DataFrame, sold: DataFrame) -> DataFrame:
    """One row per item and trading day from the packed days that were sold."""
    dense = fill_days(
        sold,
        items.select(packed_key("item_key").alias("item_key"), "item_name", "category_name"),
        trading_dates(dates, *DAY_LABELS).withColumn("date_key", packed_key("date_key")),
        item="item_key",
        day="date_key",
        order="full_date",
        measures=DAY_MEASURES,
    ).withColumns({key: unpacked_key(key) for key in ("item_key", "date_key")})
    return dense.select(
        surrogate_key("item_key", "date_key").alias("item_day_key"),
        "item_key",
        "item_name",
        "category_name",
        *DAY_LABELS,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in DAY_MEASURES],
        # Sold and given back on one day sums to nothing, yet the item did trade.
        F.col("happened").alias("sold_that_day"),
    )


def item_daily_fact(items: DataFrame, dates: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per item and trading day; a day without sales is an explicit zero."""
    return dense_item_days(items, dates, packed_item_days(lines))


def basket_items(lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Each item of a basket once, on trading days, with the event of the basket."""
    days = trading_dates(dates, "date_key", "event_key")
    # Later joins need a key anyway; asking for it here keeps all uses of the
    # distinct items alike, so they share one shuffle.
    events = days.filter(F.col("event_key").isNotNull())
    return (
        lines.join(events, "date_key")
        .select("event_key", "transaction_id", "item_key")
        .distinct()
    )


def pair_counts(dates: DataFrame, lines: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Baskets per event and unordered item pair, by packed keys: all that the self-join and the count move."""
    events = trading_dates(dates, "date_key", "event_key").filter(F.col("event_key").isNotNull())
    bought = (
        lines.join(events, "date_key")
        .select(packed_key("event_key").alias("event"), "transaction_id", packed_key("item_key").alias("item"))
        .distinct()
    )
    pairs = pair_up(bought, "transaction_id", "item", ["event"], block_items)
    return pairs.groupBy(F.col("a_event").alias("event"), "a_item", "b_item").agg(F.count("*").alias("baskets"))


def labelled_pairs(counted: DataFrame, items: DataFrame, dates: DataFrame) -> DataFrame:
    """Counted pairs with their keys as text and the names of items and event."""
    named = items.select(packed_key("item_key").alias("a_item"), F.col("item_name").alias("a_name"))
    events = trading_dates(dates, "event_key", "event_name").distinct()
    joined = (
        counted.join(events.withColumn("event", packed_key("event_key")), "event")
        .drop("event")
        .join(named, "a_item")
        .join(named.toDF("b_item", "b_name"), "b_item")
        .withColumns({"a_item": unpacked_key("a_item"), "b_item": unpacked_key("b_item")})
    )
    # Packed keys sort like their text where all are surrogate keys.
    swapped = F.col("a_item") > F.col("b_item")

    def side(this: str, other: str, column: str) -> Column:
        return F.when(swapped, F.col(f"{other}_{column}")).otherwise(F.col(f"{this}_{column}"))

    return joined.select(
        "event_key",
        "event_name",
        side("a", "b", "item").alias("item_a_key"),
        side("b", "a", "item").alias("item_b_key"),
        side("a", "b", "name").alias("item_a"),
        side("b", "a", "name").alias("item_b"),
        "baskets",
    ).select(
        surrogate_key("event_key", "item_a_key", "item_b_key").alias("item_pair_key"),
        "event_key",
        "event_name",
        "item_a_key",
        "item_b_key",
        "item_a",
        "item_b",
        pair_label(F.col("item_a"), F.col("item_b")).alias("pair_label"),
        "baskets",
    )


def item_pairs_fact(
    items: DataFrame, dates: DataFrame, lines: DataFrame, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Baskets per event and unordered item pair.

    Only keys take part in the self-join and the count; names join the counted
    pairs afterwards.
    """
    return labelled_pairs(pair_counts(dates, lines, block_items), items, dates)


def pair_bridge(pairs: DataFrame) -> DataFrame:
    """Two rows per pair, one for each member, from one pass over the pairs."""
    members = pairs.select(
        "item_pair_key", F.explode(F.array("item_a_key", "item_b_key")).alias("item_key")
    )
    return members.select(
        surrogate_key("item_pair_key", "item_key").alias("pair_member_key"),
        "item_pair_key",
        "item_key",
    )
