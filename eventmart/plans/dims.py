"""Dimensions, rebuilt in full from the staged sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions import is_weekend, surrogate_key, weekday_name
from eventmart.operators.islands import (
    EVENT_GAP_DAYS,
    classify_days,
    mark_event_starts,
    number_days,
    number_events,
)

NO_EVENT = "Non-trading day"
NO_DAY = "Non-trading"


def category_dimension(labels: DataFrame) -> DataFrame:
    """One row per category name; takes staged sales or just their labels."""
    names = labels.select("category_name").distinct()
    return names.select(surrogate_key("category_name").alias("category_key"), "category_name")


def item_dimension(labels: DataFrame) -> DataFrame:
    """One row per natural key with the greatest of its labels.

    Takes staged sales or just their labels. Labels are made distinct first. That step combines rows by hash before the
    shuffle, while a maximum of text would sort every sale; afterwards only a
    handful of rows per item is left to compare.
    """
    names = ["sku", "item_name", "category_name"]
    seen = labels.select("item_natural_key", *names).distinct()
    items = seen.groupBy("item_natural_key").agg(*[F.max(c).alias(c) for c in names])
    return items.select(
        surrogate_key("item_natural_key").alias("item_key"),
        surrogate_key("category_name").alias("category_key"),
        "item_natural_key",
        *names,
    )


def date_dimension(sales: DataFrame, gap_days: int = EVENT_GAP_DAYS) -> DataFrame:
    """One row per date with activity; idle dates keep theirs, outside any event."""
    days = number_days(number_events(mark_event_starts(classify_days(sales), gap_days)))
    trading = F.col("is_trading_day")
    event = F.when(trading, F.col("event_number")).otherwise(F.lit(0))
    day = F.when(trading, F.col("day_in_event")).otherwise(F.lit(0))
    return days.select(
        surrogate_key("sale_date").alias("date_key"),
        F.col("sale_date").alias("full_date"),
        "is_trading_day",
        surrogate_key(event).alias("event_key"),
        F.when(
            trading,
            F.concat(
                F.lit("Event "),
                event.cast("string"),
                F.lit(" ("),
                F.col("event_start_date").cast("string"),
                F.lit(")"),
            ),
        )
        .otherwise(F.lit(NO_EVENT))
        .alias("event_name"),
        F.when(trading, F.col("event_start_date")).alias("event_start_date"),
        F.when(trading, F.concat(F.lit("Day "), day.cast("string")))
        .otherwise(F.lit(NO_DAY))
        .alias("convention_day"),
        day.cast("bigint").alias("day_in_event"),
        weekday_name(F.col("sale_date")).alias("day_of_week"),
        is_weekend(F.col("sale_date")).alias("is_weekend"),
    )
