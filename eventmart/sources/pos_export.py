"""A till's own item export: CSV files with currency text, columns found by name.

A file is cut at byte ranges, although a line break may lie inside quotes. One narrow pass counts the
quotes of each range; their sum over the ranges before tells whether a range begins inside
quotes, and from there each line of it. A record that begins in one range and ends in
another is put together from the pieces, which are few. So a file of any size is read by
many tasks.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.functions import blank_to_null, currency_to_cents
from eventmart.sources.landing import CSV_TEXT
from eventmart.sources.schemas import POS_EXPORT


def _lines(spark: SparkSession, pattern: str) -> DataFrame:
    """Physical lines with the file and range they begin in, and their order in the range."""
    return spark.read.option("lineSep", "\n").text(pattern).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def _quotes() -> Column:
    return F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))


def _ranges(lines: DataFrame) -> DataFrame:
    """For each range whether it begins and ends inside quotes, and its file's first line.

    A row a range: the text itself stays where it is.
    """
    counted = lines.groupBy("file", "block").agg(F.sum(_quotes()).alias("quotes"), F.min_by("value", "line").alias("head"))
    earlier = Window.partitionBy("file").orderBy("block")
    upto = F.sum("quotes").over(earlier)
    return counted.select(
        "file",
        "block",
        ((upto - F.col("quotes")) % 2 == 1).alias("begins_inside"),
        (upto % 2 == 1).alias("ends_inside"),
        F.first("head").over(earlier).alias("head"),
    )


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(parts), lambda part: part["text"]), "\n")


def records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Whole CSV records: file, block and line where they begin, their text, the file's first line.

    Quotes stand for themselves only inside a quoted field, doubled, as the standard has it.
    """
    in_order = Window.partitionBy("file", "block").orderBy("line")
    before = F.coalesce(F.sum(_quotes()).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (before + F.col("begins_inside").cast("long")) % 2 == 0
    numbered = lines.join(ranges, ["file", "block"]).withColumn("begins", begins)
    # Lines before the first that begins a record get number 0: they end an earlier range's record.
    numbered = numbered.withColumn("record", F.sum(F.col("begins").cast("long")).over(in_order))
    groups = numbered.groupBy("file", "block", "record").agg(
        _joined(F.collect_list(F.struct("line", F.col("value").alias("text")))).alias("text"),
        F.min("line").alias("line"),
        F.first("ends_inside").alias("ends_inside"),
        F.first("head").alias("head"),
    )
    last = F.max("record").over(Window.partitionBy("file", "block"))
    marked = groups.withColumns({"opens": (F.col("record") > 0) & (F.col("record") == last) & F.col("ends_inside")})
    # In the order of a file, each piece that opens a record is followed by those that carry it on.
    pieces = marked.filter((F.col("record") == 0) | F.col("opens"))
    along = Window.partitionBy("file").orderBy("block", "record")
    pieces = pieces.withColumn("owner", F.sum(F.col("opens").cast("long")).over(along))
    mended = pieces.groupBy("file", "owner").agg(
        _joined(F.collect_list(F.struct("block", "record", "text"))).alias("text"),
        F.min(F.struct("block", "line")).alias("first"),
        F.first("head").alias("head"),
    )
    whole = marked.filter((F.col("record") > 0) & ~F.col("opens")).select("file", "block", "line", "text", "head")
    return whole.unionByName(mended.select("file", "first.block", "first.line", "text", "head"))


def _columns(head: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([head.rstrip("\r").lstrip("\ufeff")]), [])]


def read_records(spark: SparkSession, pattern: str) -> DataFrame:
    """The wanted columns of every record, by the header of its file; one that a file lacks is NULL.

    A header line holds no line break inside quotes.
    """
    lines = _lines(spark, pattern)
    ranges = _ranges(lines)
    # A row for each kind of file, not for each file.
    kinds = {row["head"]: _columns(row["head"]) for row in ranges.select("head").distinct().collect()}
    if not kinds:
        if not spark.read.format("binaryFile").load(pattern).select("path").isEmpty():
            kinds = {"": []}
        else:
            raise ValueError(f"no export matches {pattern}")
    found = records(lines, ranges).withColumn("text", F.regexp_replace("text", "\r$", ""))
    first = F.row_number().over(Window.partitionBy("file", "block").orderBy("line")) == 1
    header = (F.col("block") == 0) & first
    rows = found.withColumn("header", header).filter(~F.col("header") & (F.col("text") != ""))
    # Positions stand in for names, as a header may hold a name twice.
    width = max(1, *map(len, kinds.values()))
    shape = ", ".join(f"_{i} string" for i in range(width))
    rows = rows.withColumn("cell", F.from_csv("text", shape, CSV_TEXT))

    def wanted(name: str) -> Column:
        value = F.lit(None).cast("string")
        for head, names in kinds.items():
            if name in names:
                value = F.when(F.col("head") == head, F.col(f"cell._{names.index(name)}")).otherwise(value)
        return value.alias(name)

    return rows.select(
        *[wanted(name) for name in POS_EXPORT.names], F.col("file").alias("_file"), F.struct("block", "line").alias("_row")
    )


def _whole_quantity() -> Column:
    text = F.coalesce(F.nullif("Qty", F.lit("")), F.lit("1"))
    return text.cast("double").cast("int")


def read_export(spark: SparkSession, pattern: str) -> DataFrame:
    """Lines of every file the pattern matches, with their place in the files.

    Files may have their columns in any order and any further ones. ``_row`` grows in the
    order in which a file's lines were written.
    """
    raw = read_records(spark, pattern)
    name = F.trim(F.col("Item"))
    sku = blank_to_null(F.col("SKU"))
    typed = F.trim(F.col("Category"))
    quantity = _whole_quantity()
    cents = currency_to_cents(F.col("Gross Sales"))
    each = F.floor(cents / F.greatest(quantity, F.lit(1))).cast("bigint")
    return raw.filter(name.isNotNull() & (name != "")).select(
        F.coalesce(sku, name).alias("natural_key"),
        name.alias("name"),
        sku.alias("sku"),
        F.when(~F.lower(typed).isin("", "none"), typed).alias("category"),
        F.greatest(each, F.lit(0)).alias("price_cents"),
        F.col("Transaction ID").alias("transaction_id"),
        quantity.alias("quantity"),
        "_file",
        "_row",
    )


def export_items(lines: DataFrame) -> DataFrame:
    """One row per item, as its first line in the files describes it."""
    first = Window.partitionBy("natural_key").orderBy("_file", "_row")
    return (
        lines.withColumn("_nth", F.row_number().over(first))
        .filter(F.col("_nth") == 1)
        .select("natural_key", "name", "sku", "category", "price_cents")
    )


def export_lines(lines: DataFrame) -> DataFrame:
    return lines.select("transaction_id", "natural_key", "quantity")


def export_categories(items: DataFrame) -> DataFrame:
    return items.filter(F.col("category").isNotNull()).select("category").distinct()
