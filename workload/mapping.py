"""The driver's tables as point-of-sale data.

Every mapping reads its whole tables. Arithmetic on keys gives rows different
values (a missing SKU, a token charge, a time of day); it never leaves one out.

Sales: a line item is a sold line and its order a basket. Orders are placed on
the opening days of their quarter, so that each quarter is one event of three to
five days. Every tenth order is a terminal test, charged and voided 40 days into
the quarter: those dates take nothing and are no trading days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import pseudonym
from eventmart.sources.schemas import CATALOG_OBJECT, LANDED_LINES, ORDER

ZONES = ["America/Los_Angeles", "America/New_York", "Not/ARealZone"]
LOCATIONS = 25


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarter() -> Column:
    return F.trunc("o_orderdate", "quarter")


def _open_day() -> Column:
    days_open = 3 + F.quarter("o_orderdate") % 3
    return F.date_add(_quarter(), F.dayofmonth("o_orderdate") % days_open)


def _sale_date() -> Column:
    return F.when(_is_test(), F.date_add(_quarter(), 40)).otherwise(_open_day())


def _is_test() -> Column:
    return F.col("o_orderkey") % 10 == 0


def _money(value: Column) -> Column:
    return value.cast("decimal(12,2)")


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as they land, rebalanced by sale date.

    What moves between tasks are the tables' own columns; the texts made of them come after
    the last shuffle.
    """
    part = F.col("p_partkey")
    kind = F.col("p_type")
    test = _is_test()
    price = _money(F.col("l_extendedprice"))
    gross = F.when(test, _money(F.lit(3))).otherwise(price)
    off = _money(price * F.col("l_discount").cast("decimal(4,2)"))
    discounts = F.when(test, _money(F.lit(3))).otherwise(off)
    quantity = F.when(test, _money(F.lit(1))).otherwise(_money(F.col("l_quantity")))
    key = F.col("o_orderkey")
    clock = F.concat(
        two_digits(10 + key * 37 % 9), F.lit(":"), two_digits(key * 13 % 60), F.lit(":00")
    )
    category = (
        F.when(part % 7 == 0, F.lit(None))
        .when(part % 7 == 1, F.lit("None"))
        .when(part % 7 == 2, F.lower(kind))
        .when(part % 7 == 3, F.concat(F.lower(kind), F.lit("_goods")))
        .when(part % 7 == 4, F.concat(F.lit(" "), kind, F.lit(" ")))
        .otherwise(kind)
    )
    sku = (
        F.when(part % 16 == 0, F.lit(None))
        .when(part % 16 == 1, F.lit("  "))
        .otherwise(F.concat(F.lit("SKU-"), part.cast("string")))
    )
    typed_in = test | (F.col("o_orderpriority") == "1-URGENT")
    columns = {
        "sale_date": F.col("sale_date"),
        "sale_time": clock,
        "time_zone": F.lit(ZONES[0]),
        "category": category,
        # Part names repeat; the number tells items apart.
        "item": F.concat(F.col("p_name"), F.lit(" "), part.cast("string")),
        "qty": quantity,
        "price_point_name": F.col("p_brand"),
        "sku": sku,
        "gross_sales": gross,
        "discounts": discounts,
        "net_sales": _money(gross - discounts),
        "tax": _money(gross * F.col("l_tax").cast("decimal(4,2)")),
        "transaction_id": key.cast("string"),
        "location": F.concat(F.lit("LOC-"), (F.col("o_custkey") % LOCATIONS).cast("string")),
        "unit": F.lit("ea"),
        "count": quantity,
        "itemization_type": F.when(typed_in, F.lit("CUSTOM_AMOUNT")).otherwise(F.lit("ITEM")),
        "channel": F.col("o_orderpriority"),
        "device_name_key": pseudonym(device_name()),
        "convention_day": F.lit(None),
        "source_file": F.lit("lineitem"),
        "line_no": F.col("l_linenumber"),
        "extracted_at": F.col("o_orderdate"),
    }
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", _sale_date().alias("sale_date")
    )
    used = ["partkey", "suppkey", "orderkey", "linenumber", "quantity", "extendedprice", "discount", "tax"]
    lines = (
        read(spark, sf_dir, "lineitem")
        .select([f"l_{name}" for name in used])
        .join(orders, F.col("l_orderkey") == key)
        .drop("l_orderkey")
        .join(parts, F.col("l_partkey") == part)
        .drop("l_partkey")
        .hint("rebalance", F.col("sale_date"))
    )
    return lines.select(
        [columns[f.name].cast(f.dataType).alias(f.name) for f in LANDED_LINES.fields]
    )


def device_name() -> Column:
    return F.concat(F.lit("till of clerk "), F.col("l_suppkey").cast("string"))


# ---------------------------------------------------------------------------
# Orders as nested documents: one page per order, holding the order with its line items as
# the driver's tables have them and, for every third one, an earlier cart of the same order.
# An order with many lines is recorded as several documents, ``LINES_A_DOCUMENT`` line
# numbers in each, so that no task collects the lines of one that holds a third of all.
# ---------------------------------------------------------------------------

LINES_A_DOCUMENT = 500
ENVIRONMENT = "point_of_sale:archive"


def iso(moment: Column) -> Column:
    """``2000-01-31T05:06:07Z`` from a zone-less UTC timestamp."""
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def sold_at() -> Column:
    """A minute of the order's opening day, in UTC."""
    minutes = (F.col("o_orderkey") * 37 % 1440).cast("int")
    zero = F.lit(0)
    midnight = _open_day().cast("timestamp_ntz")
    return midnight + F.make_dt_interval(zero, zero, minutes, F.lit(0.0))


def _amount(cents: Column) -> Column:
    return F.struct(cents.cast("bigint").alias("amount"), F.lit("USD").alias("currency"))


def _line(row: Column) -> Column:
    """A row of ``lineitem``, its columns of ``LINE_ORDER``, as a line of its order's document."""
    key, part, kind = F.col("o_orderkey"), row["l_partkey"], row["l_linenumber"] % 3
    cents = F.round(row["l_extendedprice"] * 100).cast("bigint")
    typed = key % 2 == 1
    number = part.cast("string")
    reference = F.when(kind == 0, "").when((kind == 2) & (part % 4 == 0), F.concat(F.lit("GONE-"), number))
    loose = F.when(part % 4 == 0, F.lit("loose item"))
    name = F.when(kind == 1, "typed at the till").when(kind == 2, loose).when(key % 5 == 0, "gift wrap").otherwise("")
    unit = F.struct(F.struct(F.lit("kg").alias("type")).alias("measurement_unit"))
    return F.struct(
        F.concat_ws("-", F.lit("line"), key.cast("string"), row["l_linenumber"].cast("string")).alias("uid"),
        name.alias("name"),
        F.when(part % 11 == 0, "").otherwise(row["l_quantity"].cast("bigint").cast("string")).alias("quantity"),
        F.when(key % 6 == 0, unit).alias("quantity_unit"),
        reference.otherwise(F.concat(F.lit("VAR-"), number)).alias("catalog_object_id"),
        F.when(key % 3 == 0, "Large").alias("variation_name"),
        F.when(kind == 0, "CUSTOM_AMOUNT").otherwise("ITEM").alias("item_type"),
        _amount(F.when(~((kind == 0) & typed), cents)).alias("gross_sales_money"),
        _amount(F.when(~typed, cents % 500)).alias("total_discount_money"),
        _amount(cents % 97).alias("total_tax_money"),
    )


# What settles the order of lines with one number.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document, in order: l_orderkey, chunk, rows.

    Rows hold the columns of ``LINE_ORDER`` only; they become lines behind the last shuffle.
    """
    lines = read(spark, sf_dir, "lineitem")
    chunk = F.floor((F.col("l_linenumber") - 1) / LINES_A_DOCUMENT)
    placed = F.collect_list(F.struct(*LINE_ORDER))
    return lines.groupBy("l_orderkey", chunk.alias("chunk")).agg(F.sort_array(placed).alias("rows"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every document: the order's columns, ``chunk`` and ``lines``, empty where it has none."""
    lines = line_documents(spark, sf_dir)
    joined = read(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    nothing = F.array().cast(lines.schema["rows"].dataType)
    rows = F.transform(F.coalesce("rows", nothing), _line)
    return joined.withColumns({"chunk": F.coalesce("chunk", F.lit(0).cast("long")), "lines": rows}).drop("rows")


def _first_line() -> Column:
    return F.slice("lines", 1, 1)


def order_document(
    state: Column, closed: Column, lines: Column | None = None, created: Column | None = None
) -> Column:
    document = F.struct(
        F.concat(
            F.lit("ORD-"),
            F.col("o_orderkey").cast("string"),
            F.when(F.col("chunk") > 0, F.concat(F.lit("/"), F.col("chunk").cast("string"))).otherwise(""),
        ).alias("id"),
        F.concat(F.lit("LOC-"), (F.col("o_custkey") % LOCATIONS).cast("string")).alias(
            "location_id"
        ),
        state.alias("state"),
        closed.alias("closed_at"),
        (iso(sold_at()) if created is None else created).alias("created_at"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("source"),
        (F.col("lines") if lines is None else lines).alias("line_items"),
    )
    return document.cast(ORDER)


def order_state() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "OPEN")
        .otherwise("CANCELED")
    )


def order_pages(spark: SparkSession, sf_dir: str, final: bool = True) -> DataFrame:
    """Pages of an extract. The earlier extract saw every order as an open cart.

    A page of the later extract lists the outdated cart first and the order
    second, as a page does when an order changes while it is being read.
    """
    cart = order_document(F.lit("OPEN"), F.lit(None), _first_line())
    closed = F.when(F.col("o_orderstatus") != "O", iso(sold_at()))
    settled = order_document(order_state(), closed)
    orders = F.when(F.col("o_orderkey") % 3 == 0, F.array(cart, settled)).otherwise(
        F.array(settled)
    )
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("page_no"),
        F.lit(None).cast("string").alias("cursor"),
        (orders if final else F.array(cart)).alias("orders"),
    )


def is_undated() -> Column:
    """Orders that the till lost the moment of."""
    return F.col("o_orderkey") % 50 == 7


def order_versions(spark: SparkSession, sf_dir: str, early: bool) -> DataFrame:
    """Pages with one order each, as two extracts saw them.

    The early extract holds orders that are withdrawn, that change their lines or move
    to another day later, and open carts. The late one holds every order as it ended;
    every third one also as the outdated cart of an earlier page, anywhere in the files.
    """
    key, later = F.col("o_orderkey"), iso(sold_at() + F.expr("interval 30 hours"))
    cart = order_document(F.lit("OPEN"), F.lit(None), _first_line())
    if early:
        moved = order_document(F.lit("COMPLETED"), later)
        longer = order_document(F.lit("COMPLETED"), iso(sold_at()), F.concat("lines", _first_line()))
        versions = F.array(F.when(key % 4 < 2, moved).when(key % 4 == 2, longer).otherwise(cart))
    else:
        closed = F.when(F.col("o_orderstatus") != "O", iso(sold_at()))
        undated = order_document(order_state(), F.lit(None), created=F.lit(None))
        final = F.when(is_undated(), undated).otherwise(order_document(order_state(), closed))
        versions = F.when(key % 3 == 0, F.array(cart, final)).otherwise(F.array(final))
    seen = _orders(spark, sf_dir).select(key, F.posexplode(versions).alias("place", "order"))
    return seen.repartition(2 if early else 4, "place", F.col("o_orderkey") % 7).select(
        (2 * key + F.col("place")).alias("page_no"),
        F.lit(None).cast("string").alias("cursor"),
        F.array("order").alias("orders"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (key % 3 + 1).cast("int"))
    return read(spark, sf_dir, "nation").select(
        F.concat(F.lit("LOC-"), key.cast("string")).alias("id"),
        F.col("n_name").alias("name"),
        zone.alias("timezone"),
    )


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part: its category, its item and its variation.

    The category id sits in one of three fields or nowhere; a variation of every
    ninth part refers to an item that does not exist. Each page repeats the
    category, so later pages overwrite earlier ones.
    """
    part = F.col("p_partkey")
    text = part.cast("string")
    category = F.concat(F.lit("CAT-"), F.lower("p_type"))
    ids = F.struct(category.alias("id"))
    item_data = F.struct(
        F.col("p_name").alias("name"),
        F.when(part % 4 == 0, category).alias("category_id"),
        F.when(part % 4 == 1, ids).alias("reporting_category"),
        F.when(
            part % 4 == 2, F.array(F.struct(F.lit(None).cast("string").alias("id")), ids)
        ).alias("categories"),
    )
    owner = F.when(part % 9 == 8, F.lit("ITEM-none")).otherwise(F.concat(F.lit("ITEM-"), text))
    variation_data = F.struct(
        owner.alias("item_id"),
        F.when(part % 16 != 0, F.concat(F.lit("SKU-"), text)).alias("sku"),
        F.col("p_brand").alias("name"),
    )
    nothing = F.lit(None)

    def thing(kind: str, key: Column, **data: Column) -> Column:
        fields = ("category_data", "item_data", "item_variation_data")
        built = F.struct(
            F.lit(kind).alias("type"),
            key.alias("id"),
            *[data.get(f, nothing).alias(f) for f in fields],
        )
        return built.cast(CATALOG_OBJECT)

    objects = F.array(
        thing("CATEGORY", category, category_data=F.struct(F.col("p_type").alias("name"))),
        thing("ITEM", F.concat(F.lit("ITEM-"), text), item_data=item_data),
        thing("ITEM_VARIATION", F.concat(F.lit("VAR-"), text), item_variation_data=variation_data),
    )
    return read(spark, sf_dir, "part").select(
        part.alias("page_no"),
        F.lit(None).cast("string").alias("cursor"),
        objects.alias("objects"),
    )
