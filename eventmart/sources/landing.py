"""Landing of sale lines: CSV batches, idempotent loads, quarantine."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from eventmart.sources import snapshots
from eventmart.sources.schemas import LANDED_LINES, RAW_LINES
from eventmart.sources.snapshots import Load

ROWS_PER_CSV_FILE = 1_000_000

# Text comes back exactly as it was: blanks at its ends, quotes and line breaks.
CSV_TEXT = {
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    "multiLine": "true",
}


def write_csv_batch(lines: DataFrame, path: str) -> None:
    """Header-less gzip CSV in raw column order, NULL as an empty field."""
    (
        lines.select(RAW_LINES.names)
        .write.mode("errorifexists")
        .option("compression", "gzip")
        .option("nullValue", "")
        .option("emptyValue", "")
        .options(**CSV_TEXT)
        .option("maxRecordsPerFile", ROWS_PER_CSV_FILE)
        .csv(path)
    )


def read_csv_batch(spark: SparkSession, path: str) -> DataFrame:
    """A CSV batch back as raw lines; empty and blank text becomes NULL."""
    batch = spark.read.schema(RAW_LINES).option("nullValue", "").options(**CSV_TEXT).csv(path)
    return batch.select(
        *[
            F.when(F.trim(f.name) != "", F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else f.name
            for f in RAW_LINES
        ]
    )


def split_undated(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Loadable lines, and lines without a sale date.

    A dateless line is never cleared by a load that replaces dates, so loading
    it twice would count it twice. It goes to a quarantine table instead.
    """
    dated = F.col("sale_date").isNotNull()
    return lines.filter(dated), lines.filter(~dated)


MEASURES = ["net_sales"]


def _part(day: date | None) -> str:
    return f"sale_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def _days(load: Load) -> set[date]:
    names = (name.removeprefix("sale_date=") for name in load.parts)
    return {date.fromisoformat(name) for name in names if name != "__HIVE_DEFAULT_PARTITION__"}


def read_lines(
    spark: SparkSession, table: str, schema: StructType = LANDED_LINES, days: Iterable[date] | None = None
) -> DataFrame:
    """The lines of the newest commit, or those of the given sale dates only."""
    return snapshots.read(spark, table, schema, only=None if days is None else [_part(day) for day in sorted(days)])


def create_table(spark: SparkSession, table: str, schema: StructType = LANDED_LINES) -> DataFrame:
    """An empty table, in one step, in place of whatever it held."""
    snapshots.publish(spark, table, lambda _: {})
    return read_lines(spark, table, schema)


def full_refresh(batch: DataFrame, table: str, dealt: bool = False) -> bool:
    """Replace the table by the batch. An empty batch leaves the table alone.

    The table's readers see all of the old rows until they see all of the new ones.
    ``dealt`` says that the batch was rebalanced by sale date already.
    """
    spark, table = batch.sparkSession, table.rstrip("/")
    load = snapshots.stage(batch, table, "sale_date", uuid.uuid4().hex, MEASURES, dealt)
    if not load.parts:
        snapshots.delete(spark, f"{table}/load={load.name}")
        return False
    snapshots.publish(spark, table, lambda _: {name: [load.name] for name in load.parts}, load)
    return True


def replace_dates(batch: DataFrame, table: str, staging: str, also: Iterable[date] = ()) -> set[date]:
    """Replace exactly the sale dates the batch holds, which are returned; other dates stay.

    Dates of ``also`` that the batch does not hold are emptied in the same commit.
    ``staging`` names the load: a call that was cut off is finished by calling again with the
    same name, which takes a whole staged batch as it is, and changes nothing once
    the load has been committed.
    """
    spark, table = batch.sparkSession, table.rstrip("/")
    name = hashlib.md5(staging.encode()).hexdigest()
    now = snapshots.current(spark, table)
    done = now and now.load(name)
    if done:
        return _days(done)
    load = snapshots.stage(batch, table, "sale_date", name, MEASURES)
    emptied = {_part(day) for day in also}
    if load.parts or emptied:

        def change(parts: snapshots.Parts) -> snapshots.Parts:
            left = {part: loads for part, loads in parts.items() if part not in emptied}
            return left | {part: [name] for part in load.parts}

        snapshots.publish(spark, table, change, load)
    return _days(load)


def drop_dates(spark: SparkSession, table: str, dates: Iterable[date]) -> None:
    """Remove the dates' lines, all in one commit."""
    gone = {_part(day) for day in dates}
    snapshots.publish(spark, table, lambda parts: {part: loads for part, loads in parts.items() if part not in gone})


def replaced_view(target: DataFrame, batch: DataFrame) -> DataFrame:
    """What ``replace_dates`` leaves behind, without writing anything."""
    dates = batch.select("sale_date").filter("sale_date is not null").distinct()
    return target.join(dates, "sale_date", "left_anti").unionByName(batch)


def load_report(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count("*").alias("table_rows"),
        F.count_distinct("sale_date").alias("sale_dates"),
        F.sum("net_sales").alias("net_sales"),
    )


def reported_loads(spark: SparkSession, table: str) -> DataFrame:
    """Rows, dates and revenue of the table's last loads, as observed while they were written.

    No line is read. A load that was staged before it was cut off has no observed numbers.
    """
    now = snapshots.current(spark, table)
    rows = [
        (number, load.name, load.rows, len(load.parts), load.sums.get("net_sales"))
        for number, load in enumerate(now.loads if now else [], 1)
    ]
    found = spark.createDataFrame(rows, "number int, load string, table_rows long, sale_dates long, net_sales string")
    return found.withColumn("net_sales", F.col("net_sales").cast("decimal(22,2)"))
