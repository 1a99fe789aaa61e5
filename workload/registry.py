"""Every query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType

from eventmart import functions as fn
from eventmart.operators import flatten, islands
from eventmart.plans import analysis, checks, dashboard, facts, scheduled
from eventmart.plans.star import Star
from eventmart.session import fresh_folder
from eventmart.sources import archive, catalog, export, landing, pos_api, pos_export
from eventmart.streaming.incremental import IncrementalLoad
from workload import mapping

Query = Callable[[SparkSession, str], DataFrame]

FIRST_EXTRACT = datetime(2002, 1, 1, 6, 0, 0, tzinfo=timezone.utc)
SECOND_EXTRACT = datetime(2002, 1, 1, 18, 0, 0, tzinfo=timezone.utc)


def comparable(table: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as doubles, whole numbers as bigint."""

    def plain(field) -> Column:
        kind = field.dataType
        if isinstance(kind, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, (ByteType, ShortType, IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return table.select([plain(f) for f in table.schema.fields])


class Workspace:
    """What several queries share for one data folder: landed lines, star, archive."""

    _known: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = fresh_folder(spark, "star")
        self._star: Star | None = None
        self._landed: str | None = None
        self._archived: str | None = None
        self._loaded: IncrementalLoad | None = None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    @property
    def star(self) -> Star:
        if self._star is None:
            raw = landing.read_lines(self.spark, self.landed)
            self._star = Star(self.spark, raw, self.root, by_date=True)
        return self._star

    @property
    def landed(self) -> str:
        """The folder of the landed raw lines."""
        if self._landed is None:
            self._landed = f"{self.root}/raw"
            landing.full_refresh(mapping.raw_lines(self.spark, self.sf_dir), self._landed, dealt=True)
        return self._landed

    def use(self, star: Star) -> None:
        """Ask an already built star instead of building one."""
        self._star = star

    def table(self, name: str) -> DataFrame:
        return self.star.table(name)

    @property
    def archived(self) -> str:
        """Two extracts of the orders, one of catalog and locations."""
        if self._archived is None:
            root = f"{self.root}/archive"
            store = archive.build_archive(root)
            first = mapping.order_pages(self.spark, self.sf_dir, final=False)
            written = [
                store.write("orders", first, FIRST_EXTRACT),
                store.write("orders", mapping.order_pages(self.spark, self.sf_dir), SECOND_EXTRACT),
                store.write("catalog", mapping.catalog_pages(self.spark, self.sf_dir), SECOND_EXTRACT),
            ]
            if None in written:
                raise OSError("the archive could not be written")
            self._archived = root
        return self._archived

    @property
    def loaded(self) -> IncrementalLoad:
        """An early extract loaded as it came, then a later one that changes what it said."""
        if self._loaded is None:
            root = fresh_folder(self.spark, "bronze")
            store = archive.build_archive(root)
            load = IncrementalLoad(
                self.spark,
                f"{root}/orders",
                fresh_folder(self.spark, "stream-table"),
                fresh_folder(self.spark, "stream-checkpoint"),
                pos_api.catalog_lookup(self.objects()),
                self.zones(),
                mapping.ENVIRONMENT,
                files_per_batch=2,
                buckets=16,
            )
            for early, moment in ((True, FIRST_EXTRACT), (False, SECOND_EXTRACT)):
                if store.write("orders", mapping.order_versions(self.spark, self.sf_dir, early), moment) is None:
                    raise OSError("the archive could not be written")
                load.start().awaitTermination()
            self._loaded = load
        return self._loaded

    def orders(self) -> DataFrame:
        return pos_api.latest_orders(pos_api.read_order_pages(self.spark, f"{self.archived}/orders"))

    def objects(self) -> DataFrame:
        pages = pos_api.read_catalog_pages(self.spark, f"{self.archived}/catalog")
        return pos_api.objects_in_pages(pages)

    def zones(self) -> DataFrame:
        return pos_api.location_zones(mapping.locations(self.spark, self.sf_dir))

    def documents(self) -> DataFrame:
        """Order documents straight from the mapping, without the detour over files."""
        pages = mapping.order_pages(self.spark, self.sf_dir)
        return pages.select(F.element_at("orders", -1).alias("doc")).select("doc.*")


# --------------------------------------------------------------------------
# Sources and sinks
# --------------------------------------------------------------------------


def orders_replay(ws: Workspace) -> DataFrame:
    return ws.orders().select("id", "state", "closed_at", F.size("line_items").alias("lines"))


def replay_one_extract(ws: Workspace) -> DataFrame:
    """The first of two extracts again: every order as the open cart that it saw."""
    pages = pos_api.read_order_pages(
        ws.spark, f"{ws.archived}/orders", since=FIRST_EXTRACT, until=FIRST_EXTRACT
    )
    return pos_api.latest_orders(pages).select("id", "state", F.size("line_items").alias("lines"))


def completed_orders_window(ws: Workspace) -> DataFrame:
    window = pos_api.ExtractWindow(
        datetime(1996, 1, 1, tzinfo=timezone.utc), datetime(1999, 1, 1, tzinfo=timezone.utc)
    )
    orders = mapping.read(ws.spark, ws.sf_dir, "orders").withColumn(
        "location_id",
        F.concat(F.lit("LOC-"), (F.col("o_custkey") % mapping.LOCATIONS).cast("string")),
    )
    paid = pos_api.completed_orders(
        orders,
        window,
        mapping.locations(ws.spark, ws.sf_dir),
        state="o_orderstatus",
        closed_at="o_orderdate",
        order_id="o_orderkey",
        completed="F",
    )
    return paid.select("o_orderkey", "location_id", F.to_date("o_orderdate").alias("closed_on"))


def incremental_window(ws: Workspace) -> DataFrame:
    recent = pos_api.closed_in_last_hours(mapping.read(ws.spark, ws.sf_dir, "events"), "ts")
    return recent.select("event_id", "user_id", "event_type", "value")


def archive_roundtrip(ws: Workspace) -> DataFrame:
    pages = pos_api.read_order_pages(ws.spark, f"{ws.archived}/orders")
    return pos_api.orders_in_pages(pages).groupBy(
        F.hour("extracted_at").alias("extract_hour"), "location_id", "state"
    ).agg(F.count("*").alias("documents"), F.sum(F.size("line_items")).alias("lines"))


def csv_landing_roundtrip(ws: Workspace) -> DataFrame:
    path = fresh_folder(ws.spark, "csv")
    landing.write_csv_batch(ws.star.raw, path)
    return landing.read_csv_batch(ws.spark, path)


def _per_date(lines: DataFrame) -> DataFrame:
    return lines.groupBy("sale_date").agg(
        F.count("*").alias("lines"), F.sum("qty").alias("qty"), F.sum("net_sales").alias("net_sales")
    )


def idempotent_date_replace(ws: Workspace) -> DataFrame:
    """The last quarter's dates arrive again with corrected quantities, twice."""
    raw = ws.star.raw
    table = fresh_folder(ws.spark, "landed")
    landing.full_refresh(raw, table)
    batch = raw.filter(F.quarter("sale_date") == 4).withColumn(
        "qty", (F.col("qty") + 1).cast("decimal(12,2)")
    )
    for attempt in (1, 2):
        landing.replace_dates(batch, table, fresh_folder(ws.spark, f"staged-{attempt}"))
    return _per_date(landing.read_lines(ws.spark, table))


def full_refresh(ws: Workspace) -> DataFrame:
    """An empty batch changes nothing; a full one replaces everything."""
    raw = ws.star.raw
    table = fresh_folder(ws.spark, "refreshed")
    landing.full_refresh(raw, table)
    doubled = landing.read_lines(ws.spark, table).withColumn(
        "net_sales", (F.col("net_sales") * 2).cast("decimal(12,2)")
    )
    again = fresh_folder(ws.spark, "refreshed")
    landing.full_refresh(doubled, again)
    landing.full_refresh(doubled.filter(F.lit(False)), again)
    return landing.load_report(landing.read_lines(ws.spark, again))


def observed_loads(ws: Workspace) -> DataFrame:
    """What a refresh and a date replace tell of themselves, observed while they wrote."""
    table = fresh_folder(ws.spark, "observed")
    landing.full_refresh(ws.star.raw, table)
    landing.replace_dates(ws.star.raw.filter(F.quarter("sale_date") == 4), table, "fourth quarter")
    return landing.reported_loads(ws.spark, table).drop("load")


EXPORT_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
    "l_returnflag",
]


def _pos_export(ws: Workspace) -> DataFrame:
    """The line items as a till would export them, in one order over all files."""
    part = F.col("p_partkey")
    amount = F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(12,2)"), 2))
    rows = (
        mapping.read(ws.spark, ws.sf_dir, "lineitem")
        .join(mapping.read(ws.spark, ws.sf_dir, "part"), F.col("l_partkey") == part)
        .select(
            *EXPORT_ORDER,
            # Columns a till adds of its own, and not in the order that we read them in.
            F.col("l_shipdate").cast("date").alias("Date"),
            F.col("p_type").alias("Notes, \"as typed\""),
            F.concat(F.col("p_name"), F.lit(' 12" wide,\nboxed')).alias("Item"),
            F.when(part % 16 > 1, F.concat(F.lit("SKU-"), part.cast("string"))).alias("SKU"),
            F.when(F.col("l_linenumber") < 7, F.col("l_quantity").cast("string")).alias("Qty"),
            F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), amount, F.lit(")")))
            .otherwise(amount)
            .alias("Gross Sales"),
            F.when(F.col("l_linenumber") == 1, F.lit("None"))
            .otherwise(F.col("p_type"))
            .alias("Category"),
            F.col("l_orderkey").cast("string").alias("Transaction ID"),
        )
    )
    path = fresh_folder(ws.spark, "export")
    (
        rows.repartitionByRange(*EXPORT_ORDER)
        .sortWithinPartitions(*EXPORT_ORDER)
        .drop(*EXPORT_ORDER)
        .write.option("header", True)
        .options(**landing.CSV_TEXT)
        .csv(path)
    )
    return pos_export.read_export(ws.spark, f"{path}/*.csv")


def pos_export_items(ws: Workspace) -> DataFrame:
    return pos_export.export_items(_pos_export(ws))


def pos_export_lines(ws: Workspace) -> DataFrame:
    return (
        pos_export.export_lines(_pos_export(ws))
        .groupBy("transaction_id", "natural_key")
        .agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))
    )


def _exported(ws: Workspace, table: DataFrame) -> DataFrame:
    path = fresh_folder(ws.spark, "star-csv")
    export.export_table(table, path)
    files = ws.spark.read.schema(export.exportable(table).schema)
    return files.options(header=True, **landing.CSV_TEXT).csv(path)


def export_fact_sales_line(ws: Workspace) -> DataFrame:
    return _exported(ws, ws.table("fact_sales_line"))


def export_dim_item(ws: Workspace) -> DataFrame:
    """Names with quotes, commas, line breaks and blanks at their ends."""
    quoted = F.concat(F.lit(' 12" '), F.col("item_name"), F.lit(', "boxed"\n\\ '))
    return _exported(ws, ws.table("dim_item").withColumn("item_name", quoted))


def incremental_load(ws: Workspace) -> DataFrame:
    return _per_date(landing.read_lines(ws.spark, ws.loaded.table))


def window_load(ws: Workspace) -> DataFrame:
    """A window that starts and ends within a day, loaded twice into a new raw table."""
    table = fresh_folder(ws.spark, "window-table")
    landing.create_table(ws.spark, table)
    window = pos_api.ExtractWindow(
        datetime(1995, 1, 2, 15, tzinfo=timezone.utc), datetime(1997, 7, 3, 9, tzinfo=timezone.utc)
    )
    for attempt in (1, 2):
        scheduled.load_window(
            ws.orders(),
            window,
            mapping.locations(ws.spark, ws.sf_dir),
            pos_api.catalog_lookup(ws.objects()),
            ws.zones(),
            mapping.ENVIRONMENT,
            table,
            fresh_folder(ws.spark, f"window-staged-{attempt}"),
            zone="UTC",
        )
    lines = landing.read_lines(ws.spark, table)
    return lines.groupBy("sale_date").agg(F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales"))


def catalog_as_of(ws: Workspace) -> DataFrame:
    """Two catalog extracts that disagree, looked up as of the first."""
    root = fresh_folder(ws.spark, "catalog-extracts")
    store = archive.build_archive(root)
    new = mapping.catalog_pages(ws.spark, ws.sf_dir)
    renamed = F.transform(
        "objects",
        lambda o: o.withField(
            "item_data", F.when(o["item_data"].isNotNull(), o["item_data"].withField("name", F.concat(F.lit("old "), o["item_data"]["name"])))
        ),
    )
    early = new.filter(F.col("page_no") % 5 != 0).withColumn("objects", renamed)
    for pages, moment in ((early, FIRST_EXTRACT), (new, SECOND_EXTRACT)):
        if store.write("catalog", pages, moment) is None:
            raise OSError("the archive could not be written")
    objects = pos_api.objects_in_pages(pos_api.read_catalog_pages(ws.spark, f"{root}/catalog"))
    return pos_api.catalog_lookup(objects, as_of=FIRST_EXTRACT).select("variation_id", "item_name", "sku")


def quarantined_lines(ws: Workspace) -> DataFrame:
    """Lines of orders without any moment, which no date replace could clear."""
    return ws.loaded.quarantined().select("transaction_id", "line_no", "item", "qty", "net_sales")


# --------------------------------------------------------------------------
# Flattening and expressions
# --------------------------------------------------------------------------


def _lines(ws: Workspace) -> DataFrame:
    return flatten.explode_lines(ws.documents())


def flatten_line_items(ws: Workspace) -> DataFrame:
    paid = ws.orders().filter(F.col("state") == pos_api.COMPLETED)
    flat = flatten.flatten_orders(
        paid, pos_api.catalog_lookup(ws.objects()), ws.zones(), mapping.ENVIRONMENT
    )
    return flat.drop("extracted_at", "device_name_key", "convention_day")


def net_sales_calc(ws: Workspace) -> DataFrame:
    return flatten.with_money(_lines(ws)).select(
        "transaction_id", "line_no", "gross_sales", "discounts", "net_sales", "tax"
    )


def device_pseudonym(ws: Workspace) -> DataFrame:
    return (
        mapping.read(ws.spark, ws.sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.count("*").alias("lines"))
        .select(fn.pseudonym(mapping.device_name()).alias("device_name_key"), "lines")
    )


def catalog_lookup(ws: Workspace) -> DataFrame:
    return pos_api.catalog_lookup(ws.objects())


def catalog_stats(ws: Workspace) -> DataFrame:
    return pos_api.catalog_stats(ws.objects())


def enrich_lines(ws: Workspace) -> DataFrame:
    lines = flatten.with_catalog(_lines(ws), pos_api.catalog_lookup(ws.objects()))
    return lines.select("transaction_id", "line_no", "item_name", "sku", "category_name")


def local_sale_time(ws: Workspace) -> DataFrame:
    sales = mapping.read(ws.spark, ws.sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("LOC-"), (F.col("user_id") % mapping.LOCATIONS).cast("string")).alias(
            "location_id"
        ),
        mapping.iso(F.col("ts")).alias("sold_at"),
    )
    return flatten.with_local_time(sales, ws.zones()).select(
        "event_id", "time_zone", "sale_date", "sale_time"
    )


def cents_to_money(ws: Workspace) -> DataFrame:
    cents = F.when(F.col("event_type") != "error", F.round(F.col("value") * 100).cast("bigint"))
    return mapping.read(ws.spark, ws.sf_dir, "events").select(
        "event_id", fn.from_minor_units(cents).alias("amount")
    )


def parse_currency(ws: Workspace) -> DataFrame:
    amount = F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(12,2)"), 2))
    text = (
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("("), amount, F.lit(")")))
        .when(F.col("l_linenumber") == 7, F.lit("  "))
        .otherwise(amount)
    )
    cents = fn.currency_to_cents(text)
    return (
        mapping.read(ws.spark, ws.sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_returnflag")
        .agg(F.sum(cents).alias("cents"), F.min(cents).alias("least"))
    )


def slug(ws: Workspace) -> DataFrame:
    return mapping.read(ws.spark, ws.sf_dir, "pages").select(
        "page_id", fn.slug(F.col("url")).alias("slug")
    )


def item_natural_key(ws: Workspace) -> DataFrame:
    return (
        ws.star.raw.groupBy("sku", "item")
        .agg(F.count("*").alias("lines"))
        .select(
            "sku", "item", fn.natural_key(F.col("sku"), F.col("item")).alias("item_natural_key"), "lines"
        )
    )


def category_normalise(ws: Workspace) -> DataFrame:
    return (
        ws.star.raw.groupBy("category")
        .agg(F.count("*").alias("lines"))
        .select("category", fn.clean_category(F.col("category")).alias("category_name"), "lines")
    )


def pair_label(ws: Workspace) -> DataFrame:
    return (
        ws.table("fact_item_pairs")
        .groupBy("pair_label")
        .agg(F.count("*").alias("pairs"), F.sum("baskets").alias("baskets"))
    )


def surrogate_keys(ws: Workspace) -> DataFrame:
    optional = F.when(F.col("p_partkey") % 16 != 0, F.col("p_type"))
    return mapping.read(ws.spark, ws.sf_dir, "part").select(
        "p_partkey",
        fn.surrogate_key("p_partkey").alias("single_key"),
        fn.surrogate_key("p_name", optional, "p_size").alias("joint_key"),
    )


def calendar_attrs(ws: Workspace) -> DataFrame:
    days = (
        mapping.read(ws.spark, ws.sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("full_date"))
        .agg(F.count("*").alias("orders"))
    )
    day = F.col("full_date")
    return days.select(
        "full_date",
        fn.weekday_name(day).alias("day_of_week"),
        fn.is_weekend(day).alias("is_weekend"),
        "orders",
    )


def line_item_name(ws: Workspace) -> DataFrame:
    lines = flatten.with_catalog(_lines(ws), pos_api.catalog_lookup(ws.objects()))
    name = fn.line_name(F.col("item_name"), F.col("line.name"), F.col("line.item_type"))
    return lines.groupBy(name.alias("item"), F.col("line.item_type").alias("item_type")).agg(
        F.count("*").alias("lines")
    )


def category_resolution(ws: Workspace) -> DataFrame:
    items = ws.objects().filter(F.col("type") == "ITEM")
    return items.select("id", fn.category_id(F.col("item_data")).alias("category_id"))


# --------------------------------------------------------------------------
# Models and their parts
# --------------------------------------------------------------------------


def _of_table(name: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: ws.table(name)


def catalog_floor(ws: Workspace) -> DataFrame:
    return islands.catalog_floor(ws.table("stg_sales")).select(
        F.round("floor_amount", 6).alias("floor_amount")
    )


def _trading(ws: Workspace) -> DataFrame:
    return islands.mark_event_starts(islands.classify_days(ws.table("stg_sales")))


def trading_days(ws: Workspace) -> DataFrame:
    return islands.classify_days(ws.table("stg_sales"))


def trading_day_gaps(ws: Workspace) -> DataFrame:
    return _trading(ws).filter("is_trading_day").select("sale_date", "prev_date", "is_event_start")


def event_islands(ws: Workspace) -> DataFrame:
    return islands.number_events(_trading(ws)).filter("is_trading_day").select(
        "sale_date", "event_number"
    )


def event_days(ws: Workspace) -> DataFrame:
    return islands.number_days(islands.number_events(_trading(ws))).filter("is_trading_day").select(
        "sale_date", "event_number", "event_start_date", "day_in_event"
    )


def item_day_grid(ws: Workspace) -> DataFrame:
    return facts.item_day_grid(ws.table("dim_item"), ws.table("dim_date"))


def item_daily_actual(ws: Workspace) -> DataFrame:
    return facts.item_day_actuals(ws.table("fact_sales_line"))


def basket_items(ws: Workspace) -> DataFrame:
    return facts.basket_items(ws.table("fact_sales_line"), ws.table("dim_date"))


def pairs_for_item(ws: Workspace) -> DataFrame:
    return dashboard.pairs_for_item(ws.table, dashboard.best_selling_item(ws.table))


def _ask(question: Callable[[analysis.Tables], DataFrame]) -> Callable[[Workspace], DataFrame]:
    return lambda ws: question(ws.table)


# The driver's quarters open on five days at most.
HEATMAP_DAYS = 5


def item_day_heatmap_wide(ws: Workspace) -> DataFrame:
    return dashboard.item_day_heatmap_wide(ws.table, HEATMAP_DAYS)


def named_tables(ws: Workspace) -> DataFrame:
    """The layers' tables asked by name: rows, and revenue where a table has it."""
    names = catalog.Catalog(ws.spark, f"shop_{ws.root[-8:]}", fresh_folder(ws.spark, "catalog"))
    names.create()
    names.register_lines(ws.landed)
    names.register_star(ws.star)
    parts = [
        f"SELECT '{table}' AS table_name, count(*) AS rows, sum({revenue}) AS net_sales FROM {names.name(table)}"
        for table, revenue in (
            ("raw_lines", "net_sales"), ("stg_sales", "net_sales"), ("dim_item", "cast(null as decimal(12,2))"),
            ("fact_sales_line", "net_sales"), ("fact_item_daily", "net_sales"),
        )
    ]
    return ws.spark.sql(" UNION ALL ".join(parts))


def named_revenue_by_category(ws: Workspace) -> DataFrame:
    """A numbered question answered from the catalog's tables."""
    names = catalog.Catalog(ws.spark, f"asked_{ws.root[-8:]}", fresh_folder(ws.spark, "catalog"))
    names.create()
    names.register_star(ws.star)
    return analysis.revenue_by_category(names.table)


# --------------------------------------------------------------------------
# Checks: on the star, and on the same tables deliberately damaged
# --------------------------------------------------------------------------


def _both(sound: DataFrame, damaged: DataFrame) -> DataFrame:
    renamed = damaged.withColumn("check_name", F.concat("check_name", F.lit("_damaged")))
    return checks.in_turn([sound, renamed])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_not_null(ws: Workspace) -> DataFrame:
    sound = _union([checks.not_null(ws.table(t), t, c) for t, c in checks.NOT_NULL.items()])
    lost = F.when(F.col("channel") != "5-LOW", F.col("transaction_id"))
    damaged = ws.table("raw_lines").withColumn("transaction_id", lost)
    return _both(sound, checks.not_null(damaged, "raw_lines", ["transaction_id"]))


def check_unique(ws: Workspace) -> DataFrame:
    sound = checks.in_turn([checks.unique(ws.table(t), t, c) for t, cs in checks.UNIQUE.items() for c in cs])
    uid = checks.unique(ws.table("fact_sales_line"), "fact_sales_line", "sale_line_uid")
    items = ws.table("dim_item")
    damaged = items.unionByName(items.filter(F.col("sku").isNull()))
    return _both(sound.unionByName(uid), checks.unique(damaged, "dim_item", "item_key"))


def check_orphans(ws: Workspace) -> DataFrame:
    table = ws.table
    sound = checks.in_turn(
        [
            checks.references(table(name), name, column, table(parent), parent_column)
            for name, wanted in checks.REFERENCES.items()
            for column, parent, parent_column in wanted
        ]
    )
    lines, items, dates = table("fact_sales_line"), table("dim_item"), table("dim_date")
    whole = checks.facts_have_parents(lines, items, dates)
    fewer = items.filter(F.col("sku").isNotNull())
    damaged = checks.references(lines, "fact_sales_line", "item_key", fewer, "item_key")
    return _both(
        sound.unionByName(whole),
        damaged.unionByName(checks.facts_have_parents(lines, fewer, dates.filter("is_trading_day"))),
    )


def check_hours(ws: Workspace) -> DataFrame:
    lines = ws.table("fact_sales_line")
    late = lines.withColumn("hour_of_day", F.col("hour_of_day") + 10)
    return _both(checks.accepted_hours(lines), checks.accepted_hours(late))


def check_raw_vs_staging(ws: Workspace) -> DataFrame:
    from eventmart.plans.staging import stage_sales

    raw = ws.table("raw_lines")
    nameless = raw.withColumn("item", F.when(F.col("category").isNotNull(), F.col("item")))
    return _both(
        checks.raw_matches_staging(raw, ws.table("stg_sales")),
        checks.raw_matches_staging(nameless, stage_sales(nameless)),
    )


def check_fact_revenue(ws: Workspace) -> DataFrame:
    sales, lines = ws.table("stg_sales"), ws.table("fact_sales_line")
    paid = lines.filter(F.col("channel") != "5-LOW")
    return _both(
        checks.fact_revenue_matches(sales, lines), checks.fact_revenue_matches(sales, paid)
    )


def check_fact_rows(ws: Workspace) -> DataFrame:
    sales, lines = ws.table("stg_sales"), ws.table("fact_sales_line")
    paid = lines.filter(F.col("net_sales") != 0)
    return _both(checks.fact_rows_match(sales, lines), checks.fact_rows_match(sales, paid))


def check_grid_complete(ws: Workspace) -> DataFrame:
    items, dates, daily = (ws.table(t) for t in ("dim_item", "dim_date", "fact_item_daily"))
    return _both(
        checks.grid_is_complete(items, dates, daily),
        checks.grid_is_complete(items, dates, daily.filter("sold_that_day")),
    )


def check_dense_revenue(ws: Workspace) -> DataFrame:
    daily, lines, dates = (ws.table(t) for t in ("fact_item_daily", "fact_sales_line", "dim_date"))
    fanned = daily.unionByName(daily.filter("day_in_event = 1"))
    return _both(
        checks.dense_revenue_matches(daily, lines, dates),
        checks.dense_revenue_matches(fanned, lines, dates),
    )


def check_daily_labels(ws: Workspace) -> DataFrame:
    daily, items, dates = (ws.table(t) for t in ("fact_item_daily", "dim_item", "dim_date"))
    stale = daily.withColumn("event_name", F.when(F.col("day_in_event") > 1, F.col("event_name")))
    return _both(
        checks.daily_labels_match(daily, items, dates),
        checks.daily_labels_match(stale, items, dates),
    )


def check_pair_dim_labels(ws: Workspace) -> DataFrame:
    pairs, items, dates = (ws.table(t) for t in ("fact_item_pairs", "dim_item", "dim_date"))
    swapped = pairs.withColumns({"item_a": F.col("item_b"), "item_b": F.col("item_a")})
    return _both(
        checks.pair_labels_match(pairs, items, dates), checks.pair_labels_match(swapped, items, dates)
    )


def check_pairs_unordered(ws: Workspace) -> DataFrame:
    pairs = ws.table("fact_item_pairs")
    mirrored = pairs.withColumns(
        {"item_a_key": F.col("item_b_key"), "item_b_key": F.col("item_a_key")}
    )
    return _both(
        checks.pairs_are_unordered(pairs), checks.pairs_are_unordered(pairs.unionByName(mirrored))
    )


def check_pair_labels(ws: Workspace) -> DataFrame:
    pairs = ws.table("fact_item_pairs")
    return _both(
        checks.pair_labels_are_unique(pairs),
        checks.pair_labels_are_unique(pairs.withColumn("pair_label", F.col("item_a"))),
    )


def check_bridge(ws: Workspace) -> DataFrame:
    pairs, bridge = ws.table("fact_item_pairs"), ws.table("bridge_item_pair")
    firsts = pairs.select("item_pair_key", F.col("item_a_key").alias("item_key"))
    return _both(checks.bridge_resolves(pairs, bridge), checks.bridge_resolves(pairs, firsts))


def check_event_floor(ws: Workspace) -> DataFrame:
    sales, lines, dates = (ws.table(t) for t in ("stg_sales", "fact_sales_line", "dim_date"))
    every = dates.withColumn("is_trading_day", F.lit(True))
    return _both(
        checks.events_clear_the_floor(sales, lines, dates),
        checks.events_clear_the_floor(sales, lines, every),
    )


def check_category_spellings(ws: Workspace) -> DataFrame:
    known = ws.table("dim_category")
    typed = known.unionByName(
        ws.table("raw_lines").select(F.col("category").alias("category_name")).distinct(),
        allowMissingColumns=True,
    )
    return _both(checks.categories_are_normalised(known), checks.categories_are_normalised(typed))


def check_quantity(ws: Workspace) -> DataFrame:
    lines = ws.table("fact_sales_line")
    sign = F.when(F.col("channel") == "2-HIGH", -1).otherwise(1)
    refunds = lines.withColumn("quantity", F.col("quantity") * sign)
    return _both(
        checks.quantities_are_not_negative(lines), checks.quantities_are_not_negative(refunds)
    )


BUILT: dict[str, Callable[[Workspace], DataFrame]] = {
    # sources and sinks
    "orders_replay": orders_replay,
    "replay_one_extract": replay_one_extract,
    "completed_orders_window": completed_orders_window,
    "incremental_window": incremental_window,
    "archive_roundtrip": archive_roundtrip,
    "csv_landing_roundtrip": csv_landing_roundtrip,
    "idempotent_date_replace": idempotent_date_replace,
    "full_refresh": full_refresh,
    "observed_loads": observed_loads,
    "pos_export_items": pos_export_items,
    "pos_export_lines": pos_export_lines,
    "export_fact_sales_line": export_fact_sales_line,
    "export_dim_item": export_dim_item,
    "incremental_load": incremental_load,
    "quarantined_lines": quarantined_lines,
    "window_load": window_load,
    "catalog_as_of": catalog_as_of,
    # flattening and expressions
    "flatten_line_items": flatten_line_items,
    "net_sales_calc": net_sales_calc,
    "device_pseudonym": device_pseudonym,
    "catalog_lookup": catalog_lookup,
    "catalog_stats": catalog_stats,
    "enrich_lines": enrich_lines,
    "local_sale_time": local_sale_time,
    "cents_to_money": cents_to_money,
    "parse_currency": parse_currency,
    "slug": slug,
    "item_natural_key": item_natural_key,
    "category_normalise": category_normalise,
    "pair_label": pair_label,
    "surrogate_keys": surrogate_keys,
    "calendar_attrs": calendar_attrs,
    "line_item_name": line_item_name,
    "category_resolution": category_resolution,
    # models
    "stg_sales": _of_table("stg_sales"),
    "dim_category": _of_table("dim_category"),
    "dim_item": _of_table("dim_item"),
    "dim_date": _of_table("dim_date"),
    "fact_sales_line": _of_table("fact_sales_line"),
    "fact_item_daily": _of_table("fact_item_daily"),
    "fact_item_pairs": _of_table("fact_item_pairs"),
    "bridge_item_pair": _of_table("bridge_item_pair"),
    "catalog_floor": catalog_floor,
    "trading_days": trading_days,
    "trading_day_gaps": trading_day_gaps,
    "event_islands": event_islands,
    "event_days": event_days,
    "item_day_grid": item_day_grid,
    "item_daily_actual": item_daily_actual,
    "basket_items": basket_items,
    "basket_lines": _ask(analysis.basket_lines),
    # numbered questions
    "revenue_by_category": _ask(analysis.revenue_by_category),
    "top3_items_per_category": _ask(analysis.top_items_per_category),
    "cumulative_revenue": _ask(analysis.cumulative_revenue),
    "basket_stats": _ask(analysis.basket_stats),
    "hourly_curve": _ask(analysis.hourly_curve),
    "items_bought_together": _ask(analysis.items_bought_together),
    "velocity_sparse": _ask(analysis.velocity_sparse),
    # dashboards
    "headline_tiles": _ask(dashboard.headline_tiles),
    "revenue_index": _ask(dashboard.revenue_index),
    "item_revenue_share_top12": _ask(dashboard.item_revenue_share),
    "item_day_heatmap": _ask(dashboard.item_day_heatmap),
    "item_day_heatmap_wide": item_day_heatmap_wide,
    "velocity_dense": _ask(dashboard.velocity_dense),
    "dropped_to_zero": _ask(dashboard.dropped_to_zero),
    "peak_hour": _ask(dashboard.peak_hour),
    "top_pairs": _ask(dashboard.top_pairs),
    "pairs_for_item": pairs_for_item,
    "event_filter": _ask(dashboard.units_of_latest_event),
    "trading_hours": _ask(dashboard.trading_hours),
    # by name
    "named_tables": named_tables,
    "named_revenue_by_category": named_revenue_by_category,
    # checks
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_orphans": check_orphans,
    "check_hours": check_hours,
    "check_raw_vs_staging": check_raw_vs_staging,
    "check_fact_revenue": check_fact_revenue,
    "check_fact_rows": check_fact_rows,
    "check_grid_complete": check_grid_complete,
    "check_dense_revenue": check_dense_revenue,
    "check_daily_labels": check_daily_labels,
    "check_pair_dim_labels": check_pair_dim_labels,
    "check_pairs_unordered": check_pairs_unordered,
    "check_pair_labels": check_pair_labels,
    "check_bridge": check_bridge,
    "check_event_floor": check_event_floor,
    "check_category_spellings": check_category_spellings,
    "check_quantity": check_quantity,
}


def _bound(build: Callable[[Workspace], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(Workspace.of(spark, sf_dir)))


QUERIES: dict[str, Query] = {name: _bound(build) for name, build in BUILT.items()}
