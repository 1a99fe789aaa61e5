"""New archive files to landed lines, as they appear."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructType, TimestampNTZType

from eventmart.operators.flatten import flatten_orders
from eventmart.sources import snapshots
from eventmart.sources.landing import read_lines, replace_dates, split_undated
from eventmart.sources.pos_api import COMPLETED, latest_orders, stored, tidy_pages
from eventmart.sources.schemas import LANDED_LINES, ORDER_PAGE, TEXT, WHOLE, record
from eventmart.sources.snapshots import children, current, delete, path_exists

FILES_PER_BATCH = 1_000
# Parts of the version log by the hash of the order's id, and the loads a part takes in before it
# is written anew with the newest version of each order only.
BUCKETS = 256
MOST_LOADS = 8

# The newest versions of orders that took effect, and a date their lines were landed on.
VERSIONS = record(
    bucket=IntegerType(),
    id=TEXT,
    extracted_at=TimestampNTZType(),
    page_no=WHOLE,
    place=IntegerType(),
    sale_date=DateType(),
    run=TEXT,
    batch=WHOLE,
)


def _version() -> Column:
    """What orders versions: the extract, then the page in it, then the place on the page."""
    return F.struct("extracted_at", "page_no", "place")


def _days(table: DataFrame) -> set[date]:
    """The sale dates of a table: never more values than the calendar has."""
    dates = table.select("sale_date").filter("sale_date is not null").distinct()
    return {row.sale_date for row in dates.collect()}


def only_newest(log: DataFrame) -> DataFrame:
    """The newest version of every order, a row for every date it was landed on."""
    newest = Window.partitionBy("id").orderBy(F.desc("extracted_at"), F.desc("page_no"), F.desc("place"))
    return log.withColumn("_age", F.rank().over(newest)).filter("_age = 1").drop("_age")


def newest_versions(log: DataFrame, ids: DataFrame) -> DataFrame:
    """The newest logged version of the given ids, a row for every date it was landed on."""
    held = only_newest(log.join(ids, "id", "left_semi"))
    return held.select("id", _version().alias("known"), "sale_date").distinct()


def newer_orders(orders: DataFrame, known: DataFrame) -> DataFrame:
    """Orders of which no version as new has been seen, whatever batch it came in."""
    seen = known.select("id", "known").distinct()
    return (
        orders.join(seen, "id", "left")
        .filter(F.col("known").isNull() | (_version() > F.col("known")))
        .drop("known")
    )


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


class VersionLog:
    """The versions in ``buckets`` parts, of which a batch reads those its ids fall in.

    A batch adds its versions to the parts they belong to. A part that already holds the
    rows of ``most_loads`` batches is written anew instead, without versions that newer ones
    replaced, so what a batch reads does not grow with the number of batches before it.
    Each batch is one commit and is known by name, so repeating it changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, most_loads: int = MOST_LOADS):
        self.spark = spark
        self.path = path
        self.buckets = buckets
        self.most_loads = most_loads

    def holds(self, load: str) -> bool:
        now = current(self.spark, self.path)
        return now is not None and now.load(load) is not None

    def _parts(self, ids: DataFrame) -> list[str]:
        """The parts that hold the ids: never more than there are buckets."""
        found = ids.select(bucket_of(self.buckets).alias("bucket")).distinct().collect()
        return [f"bucket={row.bucket}" for row in found]

    def read(self, ids: DataFrame | None = None) -> DataFrame:
        """All versions, or those in the parts of some ids (a column ``id``)."""
        now = current(self.spark, self.path)
        if now is None:
            return self.spark.createDataFrame([], VERSIONS)
        return snapshots.read(self.spark, self.path, VERSIONS, now, None if ids is None else self._parts(ids))

    def add(self, versions: DataFrame, load: str) -> None:
        """Commits a batch's versions (columns of ``VERSIONS`` but the bucket)."""
        now = current(self.spark, self.path) or snapshots.Snapshot()
        rows = versions.withColumn("bucket", bucket_of(self.buckets)).select(VERSIONS.names)
        full = [part for part in self._parts(versions) if len(now.parts.get(part, [])) >= self.most_loads]
        if full:
            held = snapshots.read(self.spark, self.path, VERSIONS, now, full)
            rows = only_newest(held.unionByName(rows))
        written = snapshots.stage(rows, self.path, "bucket", load)

        def change(parts: snapshots.Parts) -> snapshots.Parts:
            return parts | {p: [load] if p in full else [*parts.get(p, []), load] for p in written.parts}

        snapshots.publish(self.spark, self.path, change, written)


class IncrementalLoad:
    """Loads whatever the archive holds beyond the last run, then stops.

    Beside the table lie ``<table>_versions``, the log of versions that took effect, and
    ``<table>_quarantine``, lines without a sale date, a folder for each micro-batch,
    which it writes anew when it is repeated. The versions decide
    what is new, so the result does not depend on how files fall into batches, and
    they tell which dates an order was landed on, so that one whose date moves leaves
    the old date. A late order needs no watermark: it reopens its sale date.

    Quarantine, table and log are changed in this order, the last two in one commit each, so a
    batch that the log holds is done and one that was cut off is done again.

    A batch's work is kept below the run it belongs to (the id that the checkpoint gives the
    query), so what another run left is never taken for its own. Work
    of earlier batches is deleted when a batch begins.
    """

    def __init__(
        self,
        spark: SparkSession,
        archive: str,
        table: str,
        checkpoint: str,
        catalog: DataFrame,
        zones: DataFrame,
        source: str,
        files_per_batch: int = FILES_PER_BATCH,
        buckets: int = BUCKETS,
    ):
        self.spark = spark
        self.archive = archive
        self.table = table.rstrip("/")
        self.checkpoint = checkpoint
        self.catalog = catalog
        self.zones = zones
        self.source = source
        self.files_per_batch = files_per_batch
        self.log = VersionLog(spark, f"{self.table}_versions", buckets)

    @property
    def quarantine_path(self) -> str:
        return f"{self.table}_quarantine"

    def _run(self) -> str:
        """The identity that Spark wrote into the checkpoint when the query first started."""
        return self.spark.read.schema("id string").json(f"{self.checkpoint}/progress/metadata").first()["id"]

    def land(self, pages: DataFrame, batch: int) -> None:
        run = self._run()
        work, load = f"{self.checkpoint}/work/{run}/{batch}", f"{run}-{batch}"
        self._tidy(run, batch)
        if self.log.holds(load):
            return
        incoming = self._kept(latest_orders(tidy_pages(pages, "orders")), f"{work}/incoming")
        ids = incoming.select("id")
        known = self._kept(newest_versions(self.log.read(ids), ids), f"{work}/known")
        orders = self._kept(newer_orders(incoming, known), f"{work}/orders")

        completed = orders.filter(F.col("state") == COMPLETED)
        lines = self._kept(flatten_orders(completed, self.catalog, self.zones, self.source), f"{work}/lines")
        fresh, undated = split_undated(lines)
        undated.write.mode("overwrite").parquet(f"{self.quarantine_path}/run={run}/batch={batch}")

        ids = orders.select(F.col("id").alias("transaction_id"))
        dates = _days(fresh) | _days(known.join(orders, "id", "left_semi"))
        if dates:
            self._replace(fresh, ids, dates, f"{work}/staged")
        landed_on = fresh.select(F.col("transaction_id").alias("id"), "sale_date").distinct()
        versions = orders.select("id", "extracted_at", "page_no", "place").join(landed_on, "id", "left")
        self.log.add(versions.withColumns({"run": F.lit(run), "batch": F.lit(batch).cast("long")}), load)

    def _replace(self, fresh: DataFrame, ids: DataFrame, dates: set[date], load: str) -> None:
        """Puts the fresh lines in place of all landed lines of the ids, in one commit."""
        if current(self.spark, self.table):
            touched = read_lines(self.spark, self.table, days=dates).select(fresh.columns)
            fresh = touched.join(ids, "transaction_id", "left_anti").unionByName(fresh)
        # A date whose last order was withdrawn or moved has no rows to overwrite it with.
        replace_dates(fresh, self.table, load, also=dates)

    def _kept(self, table: DataFrame, path: str) -> DataFrame:
        """The table written next to the checkpoint: several plans read it."""
        table.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def _tidy(self, run: str, batch: int) -> None:
        root = f"{self.checkpoint}/work"
        for other in set(children(self.spark, root)) - {run}:
            delete(self.spark, f"{root}/{other}")
        for other in set(children(self.spark, f"{root}/{run}")) - {str(batch)}:
            delete(self.spark, f"{root}/{run}/{other}")

    def quarantined(self) -> DataFrame:
        """Lines without a sale date of the orders' newest versions."""
        if not path_exists(self.spark, self.quarantine_path):
            return self.spark.createDataFrame([], LANDED_LINES)
        origin = record(run=TEXT, batch=WHOLE).fields
        lines = self.spark.read.schema(StructType([*LANDED_LINES.fields, *origin])).parquet(self.quarantine_path)
        newest = self.log.read().groupBy(F.col("id").alias("transaction_id")).agg(
            F.max_by(F.struct("run", "batch"), _version()).alias("origin")
        )
        return lines.join(newest.select("transaction_id", "origin.*"), ["transaction_id", "run", "batch"], "left_semi").select(
            LANDED_LINES.names
        )

    def start(self) -> StreamingQuery:
        return (
            self.spark.readStream.schema(stored(ORDER_PAGE))
            .option("maxFilesPerTrigger", self.files_per_batch)
            .json(self.archive)
            .writeStream.foreachBatch(self.land)
            .option("checkpointLocation", f"{self.checkpoint}/progress")
            .trigger(availableNow=True)
            .start()
        )
