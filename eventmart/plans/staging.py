"""Cleaned sales: one row in, one row out, apart from lines nobody can attribute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import blank_to_null, clean_category, natural_key

MEASURES = {
    "quantity": "qty",
    "gross_sales": "gross_sales",
    "discounts": "discounts",
    "net_sales": "net_sales",
    "tax": "tax",
}


def _attributed() -> Column:
    return F.col("transaction_id").isNotNull() & F.col("item").isNotNull()


def stage_labels(raw: DataFrame, *columns: str) -> DataFrame:
    """The different labels in the staged sales, for building dimensions.

    Cleaning looks at one row at a time, so cleaning the distinct raw labels
    gives the distinct clean ones. A label is then cleaned once and not once per
    sale. ``columns`` are raw columns out of item, sku and category.
    """
    seen = raw.filter(_attributed()).select(*columns).distinct()
    clean = {
        "item_natural_key": (("sku", "item"), natural_key(F.col("sku"), F.col("item"))),
        "sku": (("sku",), blank_to_null(F.col("sku"))),
        "item_name": (("item",), F.col("item")),
        "category_name": (("category",), clean_category(F.col("category"))),
    }
    return seen.select(
        [label.alias(name) for name, (used, label) in clean.items() if set(used) <= set(columns)]
    )


def stage_sales(raw: DataFrame) -> DataFrame:
    """A lazy projection: whoever reads it pays for the columns used only."""
    position = [F.col("line_no")] if "line_no" in raw.columns else []
    return raw.filter(_attributed()).select(
        "transaction_id",
        "sale_date",
        "sale_time",
        natural_key(F.col("sku"), F.col("item")).alias("item_natural_key"),
        blank_to_null(F.col("sku")).alias("sku"),
        F.col("item").alias("item_name"),
        "price_point_name",
        clean_category(F.col("category")).alias("category_name"),
        F.col("location").alias("location_id"),
        "device_name_key",
        "channel",
        "itemization_type",
        *[
            F.coalesce(source, F.lit(0).cast("decimal(12,2)")).alias(name)
            for name, source in MEASURES.items()
        ],
        "source_file",
        *position,
    )
