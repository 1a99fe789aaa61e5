"""Order documents to one row per sold line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions import (
    first_present,
    from_minor_units,
    iso_to_utc,
    line_name,
    time_text,
    to_local,
)
from eventmart.functions.clock import UTC
from eventmart.functions.money import MONEY
from eventmart.sources.schemas import LANDED_LINES


def explode_lines(orders: DataFrame) -> DataFrame:
    """One row per line; an order without lines leaves no row."""
    extracted = "extracted_at" if "extracted_at" in orders.columns else None
    return orders.select(
        F.col("id").alias("transaction_id"),
        "location_id",
        first_present(F.col("closed_at"), F.col("created_at")).alias("sold_at"),
        F.col("source.name").alias("channel"),
        (F.col(extracted) if extracted else F.lit(None).cast("timestamp_ntz")).alias("extracted_at"),
        F.posexplode("line_items").alias("line_no", "line"),
    )


def with_money(lines: DataFrame) -> DataFrame:
    gross = from_minor_units(F.col("line.gross_sales_money.amount"))
    discounts = from_minor_units(F.col("line.total_discount_money.amount"))
    return lines.withColumns(
        {
            "gross_sales": gross,
            "discounts": discounts,
            "net_sales": (gross - discounts).cast(MONEY),
            "tax": from_minor_units(F.col("line.total_tax_money.amount")),
        }
    )


def with_local_time(lines: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds zone, local date and local time of day; no known zone means UTC.

    The trading day is the seller's day: an evening sale in the west lies on the
    next date in UTC.
    """
    named = zones.select(F.col("id").alias("location_id"), "zone")
    zone = F.coalesce("zone", F.lit(UTC))
    local = F.col("_local")
    return (
        lines.join(named, "location_id", "left")
        .withColumn("_local", to_local(iso_to_utc(F.col("sold_at")), zone))
        .withColumns(
            {
                "time_zone": F.when(F.col("sold_at").isNull(), UTC).otherwise(zone),
                "sale_date": F.to_date(local),
                "sale_time": time_text(local),
            }
        )
        .drop("_local", "zone")
    )


# Lines without a reference are dealt over so many keys that no catalog has.
SPREAD = 4_096


def with_catalog(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds what the catalog knows; a line it does not know is kept.

    Where the join has to shuffle, NULL references would all meet in one task; they get
    keys of their own instead, by order and line, which begin with a character that no
    reference holds.
    """
    none = F.concat(
        F.lit("\u0000"), F.pmod(F.xxhash64("transaction_id", "line_no"), F.lit(SPREAD)).cast("string")
    )
    reference = F.coalesce(F.nullif("line.catalog_object_id", F.lit("")), none)
    return (
        lines.withColumn("_reference", reference)
        .join(catalog.withColumnRenamed("variation_id", "_variation"), F.col("_reference") == F.col("_variation"), "left")
        .drop("_variation", "_reference")
    )


def flatten_orders(
    orders: DataFrame, catalog: DataFrame, zones: DataFrame, source: str
) -> DataFrame:
    """Raw sale lines in landing order.

    Only the columns named here leave the archive: customer and card details
    inside the documents are never read.
    """
    quantity = F.coalesce(
        F.nullif("line.quantity", F.lit("")).cast(MONEY), F.lit(0).cast(MONEY)
    )
    lines = with_catalog(with_local_time(with_money(explode_lines(orders)), zones), catalog)
    named = lines.withColumns(
        {
            "category": F.col("category_name"),
            "item": line_name(F.col("item_name"), F.col("line.name"), F.col("line.item_type")),
            "qty": quantity,
            "price_point_name": first_present(
                F.col("line.variation_name"), F.col("variation_name")
            ),
            "location": F.col("location_id"),
            "unit": F.when(F.col("line.quantity_unit").isNull(), "ea").otherwise(
                F.col("line.quantity_unit.measurement_unit.type")
            ),
            "count": quantity,
            "itemization_type": F.col("line.item_type"),
            "device_name_key": F.lit(None).cast("string"),
            "convention_day": F.lit(None).cast("string"),
            "source_file": F.lit(source),
        }
    )
    return named.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in LANDED_LINES])
