"""Partitioned tables whose loads appear to readers at once.

A load writes its rows once, to ``<table>/load=<load>/<column>=<value>``, where nobody looks
for them yet. Then one small file in ``<table>/_commits`` says, for every partition, which loads'
folders hold its rows; the file with the highest number counts. It gets its name by renaming, so
a reader sees all partitions of a load or none, and a load that is cut off anywhere has
changed nothing. Moving no data, this needs no store with cheap renames.

Loads of one table run one after the other. What the newest ``KEPT`` commits do not mention is
deleted after a commit, so a reader has until the next load but one to finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventmart.session import COMPRESSION, shuffles_released

# Commits whose files are kept: the newest, and the one that running readers may have begun with.
KEPT = 2
# Loads that a commit remembers by name, so that repeating one changes nothing.
REMEMBERED = 100
ATTEMPTS = 5

Parts = dict[str, list[str]]


@dataclass(frozen=True)
class Load:
    """What one load wrote: its partitions' folder names, its rows, and sums as text."""

    name: str
    parts: list[str]
    rows: int | None = None
    sums: dict[str, str | None] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """One commit: the loads that hold each partition's rows, and the last loads."""

    version: int = 0
    parts: Parts = field(default_factory=dict)
    loads: list[Load] = field(default_factory=list)

    def load(self, name: str) -> Load | None:
        return next((load for load in self.loads if load.name == name), None)


# ------------------------------------------------------------------ files


def hadoop_path(spark: SparkSession, path: str):
    """File system and path of a place that any executor can reach."""
    context = spark.sparkContext
    jvm_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(context._jsc.hadoopConfiguration()), jvm_path


def delete(spark: SparkSession, path: str) -> None:
    files, jvm_path = hadoop_path(spark, path)
    files.delete(jvm_path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, jvm_path = hadoop_path(spark, path)
    return files.exists(jvm_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder; none if there is no such folder."""
    files, jvm_path = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(jvm_path)) if files.exists(jvm_path) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this path was committed."""
    return path_exists(spark, f"{path}/_SUCCESS")


def _read_text(spark: SparkSession, path: str) -> str:
    files, jvm_path = hadoop_path(spark, path)
    stream = files.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _name_text(spark: SparkSession, text: str, path: str) -> bool:
    """Writes a whole file and gives it its name; False if the name is taken."""
    folder, name = path.rsplit("/", 1)
    files, draft = hadoop_path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if path_exists(spark, path) or not files.rename(draft, hadoop_path(spark, path)[1]):
        files.delete(draft, False)
        return False
    return True


# ------------------------------------------------------------------ commits


def _commits(spark: SparkSession, table: str) -> list[int]:
    names = children(spark, f"{table}/_commits")
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def _snapshot(spark: SparkSession, table: str, version: int) -> Snapshot:
    held = json.loads(_read_text(spark, f"{table}/_commits/{version:010d}.json"))
    return Snapshot(version, held["parts"], [Load(**load) for load in held["loads"]])


def current(spark: SparkSession, table: str) -> Snapshot | None:
    """The newest commit; None if the table does not exist."""
    versions = _commits(spark, table)
    return _snapshot(spark, table, versions[-1]) if versions else None


def stage(
    batch: DataFrame, table: str, by: str, load: str, sums: Collection[str] = (), dealt: bool = False
) -> Load:
    """Writes a load's rows where readers don't look; a load staged whole before is taken as it is.

    Rows and sums are observed while they are written, behind the last shuffle, so that they cost
    no scan of their own and a task that ran twice counts once. ``dealt`` says that the batch's
    last shuffle was that by the partition, of rows narrower than those that are written.
    """
    spark, path = batch.sparkSession, f"{table}/load={load}"
    rows, found = None, {}
    if not is_complete(spark, path):
        seen = Observation()
        totals: list[Column] = [F.sum(name).cast("string").alias(name) for name in sums]
        # Rebalancing puts a partition in one file where it fits and lets AQE split a large one.
        laid_out = batch if dealt else batch.hint("rebalance", F.col(by))
        watched = laid_out.observe(seen, F.count(F.lit(1)).alias("rows_written"), *totals)
        writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "static")
        with shuffles_released(spark):
            writer.option("compression", COMPRESSION).partitionBy(by).parquet(path)
        found = dict(seen.get)
        rows = found.pop("rows_written")
    return Load(load, [name for name in children(spark, path) if name.startswith(f"{by}=")], rows, found)


def publish(spark: SparkSession, table: str, change: Callable[[Parts], Parts], load: Load | None = None) -> Snapshot:
    """Commits what ``change`` makes of the current partitions."""
    table = table.rstrip("/")
    for _ in range(ATTEMPTS):
        old = current(spark, table) or Snapshot()
        loads = [*old.loads, load][-REMEMBERED:] if load else old.loads
        new = Snapshot(old.version + 1, change(dict(old.parts)), loads)
        text = json.dumps({"parts": new.parts, "loads": [vars(each) for each in new.loads]})
        if _name_text(spark, text, f"{table}/_commits/{new.version:010d}.json"):
            _tidy(spark, table)
            return new
    raise OSError(f"other loads keep changing {table}")


def _tidy(spark: SparkSession, table: str) -> None:
    """Deletes commits older than the kept ones, and what none of the kept ones mentions."""
    versions = _commits(spark, table)
    kept = [_snapshot(spark, table, version) for version in versions[-KEPT:]]
    needed = {(load, name) for each in kept for name, loads in each.parts.items() for load in loads}
    held = {load for load, _ in needed}
    gone = {name for name in children(spark, table) if name.startswith("load=") and name.removeprefix("load=") not in held}
    for version in versions[:-KEPT]:
        # Of loads that are still needed, the partitions that only an older commit mentions.
        for name, loads in _snapshot(spark, table, version).parts.items():
            gone |= {f"load={load}/{name}" for load in loads if load in held and (load, name) not in needed}
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda name: delete(spark, f"{table}/{name}"), sorted(gone)))
    for version in versions[:-KEPT]:
        delete(spark, f"{table}/_commits/{version:010d}.json")


# ------------------------------------------------------------------ reading


def folders(snapshot: Snapshot, only: Collection[str] | None = None) -> list[str]:
    """The folders below the table that hold the partitions, or those of the given names."""
    wanted = snapshot.parts.items() if only is None else ((n, snapshot.parts[n]) for n in only if n in snapshot.parts)
    return sorted(f"load={load}/{name}" for name, loads in wanted for load in loads)


def read(
    spark: SparkSession, table: str, schema: StructType, snapshot: Snapshot | None = None, only: Collection[str] | None = None
) -> DataFrame:
    """The table as of one commit, the newest if none is given; ``only`` names partitions to read.

    Nothing else is listed: neither replaced rows nor loads that are being written.
    """
    table = table.rstrip("/")
    snapshot = snapshot or current(spark, table)
    if snapshot is None:
        raise FileNotFoundError(f"no table at {table}")
    places = folders(snapshot, only)
    if not places:
        return spark.createDataFrame([], schema)
    laid_out = StructType([*schema.fields, StructField("load", StringType())])
    rows = spark.read.schema(laid_out).option("basePath", table).parquet(*[f"{table}/{place}" for place in places])
    return rows.select(schema.names)
