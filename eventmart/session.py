"""What the running session decides: where written tables live, how wide a shuffle is."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Written tables are made of hashes in hexadecimal, which Snappy stores at full length.
COMPRESSION = "zstd"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_writing: dict[int, tuple[int, str | None]] = {}  # by session: writes that run, the setting before them


def is_shared(master: str, folder: str) -> bool:
    """Whether all executors see a folder: on one machine any, on a cluster none of a machine's own."""
    return master == "local" or master.startswith("local[") or not (folder.startswith("/") or folder.startswith("file:"))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a folder of this application below the warehouse;
    it is deleted when the application ends. On a cluster the warehouse must be shared for that.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not is_shared(spark.sparkContext.master, warehouse):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    root = f"{warehouse}/_scratch/{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return root


def shuffle_width(table: DataFrame) -> int:
    """The configured number of shuffle partitions.

    Passing it to ``repartition`` fixes the width of a step whose output is far
    larger than its input; left alone, the adaptive planner would size its tasks
    by the input.
    """
    return int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet below the scratch root."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Deletes the shuffle files of each query run inside as soon as it ends.

    For writes, whose plan nobody runs again. Else the files stay until the driver happens to
    collect its garbage, and those of one table lie beside those of the next.
    """
    session = id(spark._jsparkSession)
    with _lock:
        running, before = _writing.get(session, (0, spark.conf.get(RELEASE, None)))
        _writing[session] = running + 1, before
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _lock:
            running, before = _writing.pop(session)
            if running > 1:
                _writing[session] = running - 1, before
            elif before is None:
                spark.conf.unset(RELEASE)
            else:
                spark.conf.set(RELEASE, before)


def written(table: DataFrame, purpose: str) -> DataFrame:
    """The table written to the scratch root and read again, without the shuffle files that made it."""
    spark, path = table.sparkSession, fresh_folder(table.sparkSession, purpose)
    with shuffles_released(spark):
        table.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def known_size(table: DataFrame) -> int:
    """Bytes of the table by what Spark knows of its files."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
