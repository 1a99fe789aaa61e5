"""Archived point-of-sale payloads: order pages, catalog pages, locations."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.functions import category_id, iso_to_utc, known_zone_or_utc
from eventmart.sources.schemas import CATALOG_PAGE, LOCATIONS, ORDER_PAGE, TEXT, record

# Fixed value: nothing can have been sold before this moment.
FIRST_POSSIBLE_SALE = datetime(2009, 1, 1, tzinfo=timezone.utc)

COMPLETED = "COMPLETED"


@dataclass(frozen=True)
class ExtractWindow:
    """Half-open range of UTC moments."""

    start: datetime
    end: datetime

    @classmethod
    def last_hours(cls, hours: int = 24, end: datetime | None = None) -> "ExtractWindow":
        end = end or datetime.now(timezone.utc)
        return cls(end - timedelta(hours=hours), end)

    @classmethod
    def backfill(cls, end: datetime | None = None) -> "ExtractWindow":
        return cls(FIRST_POSSIBLE_SALE, end or datetime.now(timezone.utc))

    def snapped_to_midnight(self, zone: str) -> "ExtractWindow":
        """Widened to whole local days.

        The load replaces whole sale dates, so a window that starts in the
        middle of a day would replace that day by its later part.
        """
        tz = ZoneInfo(zone)
        first = self.start.astimezone(tz).date()
        last = self.end.astimezone(tz)
        stop = last.date() if last.time() == time(0) else last.date() + timedelta(days=1)
        return ExtractWindow(
            datetime.combine(first, time(0), tz).astimezone(timezone.utc),
            datetime.combine(stop, time(0), tz).astimezone(timezone.utc),
        )

    def contains(self, utc: Column) -> Column:
        """Filter on a zone-less UTC timestamp column; reaches a Parquet scan."""
        return (utc >= _utc_literal(self.start)) & (utc < _utc_literal(self.end))


def _utc_literal(moment: datetime) -> Column:
    plain = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(plain.isoformat(sep=" ")).cast("timestamp_ntz")


def stored(page: StructType) -> StructType:
    """Page columns plus the two the archive's folders carry, read as text."""
    return StructType([*page.fields, *record(extracted_date=TEXT, extracted_at=TEXT).fields])


def tidy_pages(stored_pages: DataFrame, content: str) -> DataFrame:
    """Stored pages with a number for every page and the moment of extraction."""
    return stored_pages.select(
        # Position in the file orders pages that carry no number of their own.
        F.coalesce("page_no", F.monotonically_increasing_id()).alias("page_no"),
        content,
        F.to_date("extracted_date").alias("extracted_date"),
        F.to_timestamp_ntz("extracted_at", F.lit("yyyyMMdd'T'HHmmss'Z'")).alias("extracted_at"),
    )


def extracted_between(since: datetime | None, until: datetime | None) -> Column:
    """Filter on the archive's folders: extracts from ``since`` to ``until``, both included.

    Both columns are compared as the text they have in a path, so whole folders fall out while
    the scan is planned, dates first. The names sort like the moments they stand for.
    """
    kept = F.lit(True)
    for moment, inside in ((since, Column.__ge__), (until, Column.__le__)):
        if moment is not None:
            utc = moment.astimezone(timezone.utc)
            kept = kept & inside(F.col("extracted_date"), F.lit(f"{utc:%Y-%m-%d}"))
            kept = kept & inside(F.col("extracted_at"), F.lit(f"{utc:%Y%m%dT%H%M%SZ}"))
    return kept


def _read_pages(
    spark: SparkSession, path: str, page: StructType, layout: str, since: datetime | None, until: datetime | None
) -> DataFrame:
    """
    ``lines`` is what our archive writes: one page per line, so a large extract
    is many files read in parallel. ``array`` reads files that hold one JSON
    array of pages; such a file cannot be split and takes one task.
    """
    if layout not in ("lines", "array"):
        raise ValueError(f"unknown layout {layout!r}")
    pages = spark.read.schema(stored(page)).json(path, multiLine=layout == "array")
    return tidy_pages(pages.filter(extracted_between(since, until)), page.names[-1])


def read_order_pages(
    spark: SparkSession, path: str, layout: str = "lines", since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Order pages of the extracts from ``since`` to ``until``; of one extract if both are its moment."""
    return _read_pages(spark, path, ORDER_PAGE, layout, since, until)


def read_catalog_pages(
    spark: SparkSession, path: str, layout: str = "lines", since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    return _read_pages(spark, path, CATALOG_PAGE, layout, since, until)


def orders_in_pages(pages: DataFrame) -> DataFrame:
    """One row per order document, in every extract that holds it."""
    return pages.select(
        "page_no", "extracted_at", F.posexplode("orders").alias("place", "doc")
    ).select("doc.*", "page_no", "place", "extracted_at")


def objects_in_pages(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_no", "extracted_at", F.posexplode("objects").alias("place", "doc")
    ).select("doc.*", "page_no", "place", "extracted_at")


def _keep_last(docs: DataFrame, *identity: str) -> DataFrame:
    """The newest version of each document.

    The filter on the row number lets Spark cut each map task's output to one
    row per document, so an id that holds a large part of all rows never meets
    in one task.
    """
    newest_first = Window.partitionBy(*identity).orderBy(
        F.desc("extracted_at"), F.desc("page_no"), F.desc("place")
    )
    return (
        docs.withColumn("_age", F.row_number().over(newest_first))
        .filter(F.col("_age") == 1)
        .drop("_age")
    )


def latest_orders(pages: DataFrame) -> DataFrame:
    """One row per order id: the version seen last."""
    return _keep_last(orders_in_pages(pages), "id")


def completed_orders(
    orders: DataFrame,
    window: ExtractWindow,
    locations: DataFrame | None = None,
    *,
    state: str = "state",
    closed_at: str = "closed_at",
    location: str = "location_id",
    order_id: str = "id",
    completed: str = COMPLETED,
) -> DataFrame:
    """Paid orders closed inside the window, at the given locations, oldest first.

    An open order is a cart in progress and a cancelled one took no money. The
    column names are parameters so that the filter can run on a table as it is
    stored and be pushed into its scan.
    """
    closed = F.col(closed_at)
    if dict(orders.dtypes)[closed_at] == "string":
        closed = iso_to_utc(closed)
    kept = orders.filter((F.col(state) == completed) & window.contains(closed))
    if locations is not None:
        ids = locations.select(F.col("id").alias(location)).distinct()
        kept = kept.join(ids, location, "left_semi")
    # The id keeps orders of one moment from all landing in one sort partition.
    return kept.orderBy(closed_at, order_id)


def closed_in_last_hours(orders: DataFrame, closed_at: str, hours: int = 24) -> DataFrame:
    """The window of a scheduled run that starts at the newest moment in the data."""
    end = orders.agg(F.max(closed_at)).scalar()
    zero = F.lit(0)
    start = end - F.make_dt_interval(zero, F.lit(hours), zero, F.lit(0.0))
    return orders.filter((F.col(closed_at) >= start) & (F.col(closed_at) < end))


def read_locations(
    spark: SparkSession, path: str, only: str | None = None
) -> DataFrame:
    locations = spark.read.schema(LOCATIONS).json(path)
    return locations if only is None else locations.filter(F.col("id") == only)


def location_zones(locations: DataFrame) -> DataFrame:
    """Location id to a zone name that is safe to convert with.

    A location without a zone is left out; its sales fall back to UTC later on.
    """
    usable = F.col("id").isNotNull() & (F.col("id") != "") & (F.col("timezone") != "")
    return (
        locations.filter(usable)
        .groupBy("id")
        .agg(F.max("timezone").alias("timezone"))
        .select("id", known_zone_or_utc(F.col("timezone")).alias("zone"))
    )


def catalog_lookup(objects: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Variation id to item name, SKU, variation name and category name.

    Sales refer to a variation and carry no category. A reference that leads
    nowhere leaves NULLs and keeps the variation. With ``as_of``, snapshots extracted
    later are not seen, so that replayed orders keep the labels they had.
    """
    if as_of is not None:
        objects = objects.filter(F.col("extracted_at") <= _utc_literal(as_of))
    newest = _keep_last(objects, "type", "id")
    categories = newest.filter(
        (F.col("type") == "CATEGORY") & F.col("category_data").isNotNull()
    ).select(F.col("id").alias("category_id"), F.col("category_data.name").alias("category_name"))
    items = newest.filter((F.col("type") == "ITEM") & F.col("item_data").isNotNull()).select(
        F.col("id").alias("item_id"),
        F.col("item_data.name").alias("item_name"),
        category_id(F.col("item_data")).alias("category_id"),
    )
    variations = newest.filter(
        (F.col("type") == "ITEM_VARIATION") & F.col("item_variation_data").isNotNull()
    ).select(
        F.col("id").alias("variation_id"),
        F.nullif("item_variation_data.item_id", F.lit("")).alias("item_id"),
        F.col("item_variation_data.sku").alias("sku"),
        F.col("item_variation_data.name").alias("variation_name"),
    )
    return (
        variations.join(items, "item_id", "left")
        .join(categories, "category_id", "left")
        .select("variation_id", "item_name", "sku", "variation_name", "category_name")
    )


def catalog_stats(objects: DataFrame) -> DataFrame:
    """Documents seen and distinct objects of every type."""
    versions = objects.groupBy("type", "id").agg(F.count("*").alias("_n"))
    return versions.groupBy("type").agg(
        F.sum("_n").alias("documents"), F.count("*").alias("objects")
    )
