"""Runs registered queries next to their SQL and compares every value."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime"):
            frame[column] = frame[column].astype(str)
        frame[column] = frame[column].map(lambda v: None if v is None or v != v or v in ("NaT",) else str(v))
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def _kind(dtype: str) -> str:
    return {"int": "int", "bigint": "int", "double": "double", "string": "text", "boolean": "bool", "date": "date"}.get(
        dtype, dtype
    )


def _oracle_kind(dtype: str) -> str:
    return {"BIGINT": "int", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date"}.get(dtype, dtype)


def differences(spark_frame, relation) -> str | None:
    """None if both hold the same rows, else what differs first."""
    ours_types = {n: _kind(t) for n, t in spark_frame.dtypes}
    theirs_types = {n: _oracle_kind(str(t)) for n, t in zip(relation.columns, relation.types)}
    if ours_types != theirs_types:
        odd = {k: (ours_types.get(k), theirs_types.get(k)) for k in {*ours_types, *theirs_types} if ours_types.get(k) != theirs_types.get(k)}
        return f"schema {odd}"
    names = sorted(ours_types)
    ours = _canonical(pd.DataFrame([tuple(r) for r in spark_frame.select(names).collect()], columns=names, dtype=object))
    theirs = _canonical(pd.DataFrame(relation.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall(), columns=names, dtype=object))
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    unequal = (ours != theirs) & ~(ours.isna() & theirs.isna())
    if unequal.to_numpy().any():
        at = unequal.any(axis=1).idxmax()
        return f"{int(unequal.any(axis=1).sum())} rows; first {ours.loc[at].to_dict()} != {theirs.loc[at].to_dict()}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    texts = driver.oracle_sql()
    bad = 0
    for name, query in driver.queries().items():
        if only and name not in only:
            continue
        begun = time.time()
        try:
            frame = query(spark, sf_dir)
            built = time.time() - begun
            problem = differences(frame, connection.sql(texts[name])) if name in texts else "no SQL"
        except Exception as error:  # noqa: BLE001
            built, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {built:.1f}/{time.time() - begun:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
