"""Declared schemas of everything that crosses a file boundary."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, WHOLE, MONEY = StringType(), LongType(), DecimalType(12, 2)


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_AMOUNT = record(amount=WHOLE, currency=TEXT)
_REFERENCE = record(id=TEXT)

ORDER = record(
    id=TEXT,
    location_id=TEXT,
    state=TEXT,
    closed_at=TEXT,
    created_at=TEXT,
    source=record(name=TEXT),
    line_items=ArrayType(
        record(
            uid=TEXT,
            name=TEXT,
            quantity=TEXT,
            quantity_unit=record(measurement_unit=record(type=TEXT)),
            catalog_object_id=TEXT,
            variation_name=TEXT,
            item_type=TEXT,
            gross_sales_money=_AMOUNT,
            total_discount_money=_AMOUNT,
            total_tax_money=_AMOUNT,
        )
    ),
)

CATALOG_OBJECT = record(
    type=TEXT,
    id=TEXT,
    category_data=record(name=TEXT),
    item_data=record(
        name=TEXT,
        category_id=TEXT,
        reporting_category=_REFERENCE,
        categories=ArrayType(_REFERENCE),
    ),
    item_variation_data=record(item_id=TEXT, sku=TEXT, name=TEXT),
)

ORDER_PAGE = record(page_no=WHOLE, cursor=TEXT, orders=ArrayType(ORDER))
CATALOG_PAGE = record(page_no=WHOLE, cursor=TEXT, objects=ArrayType(CATALOG_OBJECT))
LOCATIONS = record(id=TEXT, name=TEXT, timezone=TEXT)

# The raw table's columns in their landing order.
RAW_LINES = record(
    sale_date=DateType(),
    sale_time=TEXT,
    time_zone=TEXT,
    category=TEXT,
    item=TEXT,
    qty=MONEY,
    price_point_name=TEXT,
    sku=TEXT,
    gross_sales=MONEY,
    discounts=MONEY,
    net_sales=MONEY,
    tax=MONEY,
    transaction_id=TEXT,
    location=TEXT,
    unit=TEXT,
    count=MONEY,
    itemization_type=TEXT,
    channel=TEXT,
    device_name_key=TEXT,
    convention_day=TEXT,
    source_file=TEXT,
)

# With what the loader adds: the line's place in its order, and the extract it came from.
LANDED_LINES = StructType(
    [*RAW_LINES.fields, *record(line_no=IntegerType(), extracted_at=TimestampNTZType()).fields]
)

# Header columns of a till's item export.
POS_EXPORT = StructType(
    [
        StructField(name, TEXT)
        for name in ("Item", "SKU", "Qty", "Gross Sales", "Category", "Transaction ID")
    ]
)
