"""The untouched payloads, kept by the moment they were extracted."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, TimestampNTZType, TimestampType

from eventmart.functions import wall_clock_in_utc
from eventmart.session import shuffles_released

log = logging.getLogger(__name__)

# Gzip files cannot be split, so a page count per file keeps read tasks even.
PAGES_PER_FILE = 2_000


def extract_path(root: str, dataset: str, extracted_at: datetime) -> str:
    """``<root>/<dataset>/extracted_date=…/extracted_at=…``: two runs a day both survive."""
    moment = extracted_at.astimezone(timezone.utc)
    return (
        f"{root.rstrip('/')}/{dataset}/extracted_date={moment.date().isoformat()}"
        f"/extracted_at={moment:%Y%m%dT%H%M%SZ}"
    )


def _plain(name: str, kind: DataType) -> Column:
    """Numbers with a fixed scale and dates as text: JSON would change their shape."""
    value = F.col(name)
    if isinstance(kind, TimestampType):
        return F.concat(wall_clock_in_utc(value).cast("string"), F.lit("+00:00")).alias(name)
    if isinstance(kind, (DecimalType, DateType, TimestampNTZType)):
        return value.cast("string").alias(name)
    return value


class PayloadArchive:
    """Writes pages as gzipped JSON, one page per line.

    A write that fails is logged and gives None; whoever needs the copy must ask.
    """

    def __init__(self, root: str):
        self.root = root

    def write(
        self, dataset: str, pages: DataFrame, extracted_at: datetime | None = None
    ) -> str | None:
        path = extract_path(self.root, dataset, extracted_at or datetime.now(timezone.utc))
        try:
            with shuffles_released(pages.sparkSession):
                (
                    pages.select(*[_plain(f.name, f.dataType) for f in pages.schema.fields])
                    .write.mode("append")
                    .option("compression", "gzip")
                    .option("maxRecordsPerFile", PAGES_PER_FILE)
                    .json(path)
                )
        except Exception:
            log.exception("archiving %s to %s failed; going on", dataset, path)
            return None
        return path


def build_archive(root: str | None) -> PayloadArchive | None:
    """No folder configured means archiving is off."""
    return PayloadArchive(root) if root else None
