"""Small Spark helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.session import fresh_folder

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package, wherever the session was started from."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def materialise(frame: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: no lineage, known size."""
    spark = frame.sparkSession
    path = fresh_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send Python workers at most so many rows in a batch, for rows with whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns or ("*",))


def key_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


def likely_among_lowest(key: Column, wanted: Column | int, there: Column | int) -> Column:
    """Whether a key's hash is low enough to be one of the ``wanted`` lowest of ``there``.

    True for twice as many as wanted, so that what has to meet in one place to be
    ranked does not grow with the table.
    """
    return F.xxhash64(key) / F.lit(2.0**64) + 0.5 < F.lit(2.0) * wanted / there


def first_by_hash(keys: DataFrame, column: str, bound: int) -> DataFrame:
    """At most ``bound`` keys, the same ones in every run and spread evenly."""
    low = keys.where(likely_among_lowest(F.col(column), bound, max(1, keys.count())))
    return low.orderBy(F.xxhash64(column), column).limit(bound)


def one_a_key(rows: DataFrame, key: str, text: str) -> DataFrame:
    """One row of every key, that with the lowest hash of its text; other columns must follow from the key."""
    others = [c for c in rows.columns if c not in (key, text)]
    best = F.min(F.struct(F.xxhash64(text).alias("hash"), F.col(text).alias("text"))).alias("_best")
    found = rows.groupBy(key).agg(best, *(F.first(c).alias(c) for c in others))
    return found.select(*(F.col("_best.text").alias(c) if c == text else F.col(c) for c in rows.columns))


def own_columns(frame: DataFrame, *names: str) -> list[str]:
    """Names like the ones asked for that no column of ``frame`` bears, in any letter case."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches short enough that long texts do not pile up in Python."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bounds(texts: pa.Array, most: int) -> list[int]:
    """Where runs of texts begin, each of ``most`` bytes and one text at most, with the length at the end."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(sizes) - sizes) // most
    return run_bounds(block).tolist()


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with so many bytes of text, and one row at most."""
    for batch in batches:
        bounds = text_bounds(batch.column(column), most)
        for start, stop in zip(bounds, bounds[1:]):
            yield batch.slice(start, stop - start)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``key`` from a partition sorted by it, runs unbroken.

    Many short runs come in one table; what is held is the longest run and one batch.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key)
        last = pc.index(pc.equal(values, values[-1]), True).as_py()
        if last or (held and held[-1].column(key)[-1] != values[0]):
            if last:
                held.append(batch.slice(0, last))
            yield pa.Table.from_batches(held)
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def run_bounds(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, with the length at the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
