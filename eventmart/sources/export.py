"""Star tables as CSV for tools that read files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventmart.sources.landing import CSV_TEXT

# Columns that never leave the warehouse.
PRIVATE_COLUMNS = ("location_id", "device_name_key")


def exportable(table: DataFrame) -> DataFrame:
    return table.drop(*PRIVATE_COLUMNS)


def export_table(table: DataFrame, path: str) -> None:
    """A folder of CSV files with a header; written by all tasks in parallel.

    Quotes are doubled, and blanks and line breaks stay, so any CSV reader gives the
    text back. NULL and empty text both become an empty field. Rows are written where
    they are read, so that none moves; empty tasks write no file.
    """
    (
        exportable(table)
        .write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .options(**CSV_TEXT)
        .csv(path)
    )


def export_star(tables: dict[str, DataFrame], root: str) -> list[str]:
    written = []
    for name, table in tables.items():
        export_table(table, f"{root}/{name}")
        written.append(f"{root}/{name}")
    return written
