"""The star as written tables, built in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.plans import checks, dims, facts
from eventmart.plans.staging import stage_labels, stage_sales
from eventmart.session import COMPRESSION, shuffles_released
from eventmart.sources.snapshots import delete

BUILDERS: dict[str, Callable[["Star"], DataFrame]] = {
    "dim_category": lambda s: dims.category_dimension(stage_labels(s.raw, "category")),
    "dim_item": lambda s: dims.item_dimension(stage_labels(s.raw, "item", "sku", "category")),
    "dim_date": lambda s: dims.date_dimension(s.table("stg_sales")),
    "fact_sales_line": lambda s: facts.sales_line_fact(s.table("stg_sales")),
    # Sums and counted pairs are written before the days between and the names come to them, so
    # that the shuffles of the sums and of the self-join are gone by then.
    "fact_item_daily": lambda s: facts.dense_item_days(
        s.table("dim_item"),
        s.table("dim_date"),
        s.draft("item_days", facts.packed_item_days(s.table("fact_sales_line"))),
    ),
    "fact_item_pairs": lambda s: facts.labelled_pairs(
        s.draft("pair_counts", facts.pair_counts(s.table("dim_date"), s.table("fact_sales_line"))),
        s.table("dim_item"),
        s.table("dim_date"),
    ),
    "bridge_item_pair": lambda s: facts.pair_bridge(s.table("fact_item_pairs")),
}

# Tables of one step depend on earlier steps only; Spark runs their jobs side by side.
STEPS = [
    ["raw_lines"],
    ["dim_category", "dim_item", "dim_date", "fact_sales_line"],
    ["fact_item_daily", "fact_item_pairs"],
    ["bridge_item_pair"],
]

# Storing sale lines by date lets a date filter skip files. Rebalancing before the write
# puts a date in one file where it fits, and splits a date too large for one task. Raw lines
# whose files hold a date each are read that way already and are not moved again.
PARTITIONED = {"fact_sales_line": ["date_key"]}

# Table -> drafts that go once it is written.
DRAFTS = {"fact_item_daily": ["item_days"], "fact_item_pairs": ["pair_counts"]}


class Star:
    """Star tables below one folder.

    A table is written when it is first asked for and read back from then on, so
    later plans start from files whose sizes Spark knows and a lost executor
    costs no more than the stage at hand. ``by_date`` says that each file of ``raw`` holds
    one sale date, as those of a landed table do.
    """

    def __init__(self, spark: SparkSession, raw: DataFrame, root: str, by_date: bool = False):
        self.spark = spark
        self.raw = raw
        self.root = root
        self.by_date = by_date
        self._read: dict[str, DataFrame] = {"raw_lines": raw, "stg_sales": stage_sales(raw)}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._write(name)
        return self._read[name]

    def draft(self, name: str, built: DataFrame) -> DataFrame:
        """What a table is made of, written beside it until it is whole."""
        path = f"{self.root}/_draft_{name}"
        with shuffles_released(self.spark):
            built.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(built.schema).parquet(path)

    def _write(self, name: str) -> None:
        built = BUILDERS[name](self)
        path = f"{self.root}/{name}"
        by = PARTITIONED.get(name, [])
        laid_out = built.hint("rebalance", *[F.col(c) for c in by]) if by and not self.by_date else built
        with shuffles_released(self.spark):
            laid_out.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*by).parquet(path)
        self._read[name] = self.spark.read.schema(built.schema).parquet(path)
        for draft in DRAFTS.get(name, []):
            delete(self.spark, f"{self.root}/_draft_{draft}")

    def check(self, name: str) -> dict[str, int]:
        return checks.failures(checks.check_table(name, self.table))

    def build(self, tolerate: Collection[str] = ()) -> dict[str, int]:
        """Write and check every table; a step with a failing check is the last one.

        Checks named in ``tolerate`` may fail. All violations are returned.
        """
        found: dict[str, int] = {}
        for step in STEPS:
            with ThreadPoolExecutor(len(step)) as jobs:
                # First all tables, as a check may compare two of one step.
                list(jobs.map(self.table, step))
                results = list(jobs.map(self.check, step))
            for name, broken in zip(step, results, strict=True):
                fatal = {check: n for check, n in broken.items() if check not in tolerate}
                if fatal:
                    raise checks.CheckFailed(name, fatal)
                found |= broken
        return found
