"""The layers as named tables: databases ``raw_data``, ``staging`` and ``warehouse``, with or without a prefix.

Whoever asks by name needs no folder. Names refer to files that are already there, so
registering copies nothing but the staging layer. The raw lines are a view that is switched
to a newer commit in one step: a query by name sees one commit or the next one, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from eventmart.plans.star import PARTITIONED, STEPS, Star
from eventmart.session import COMPRESSION
from eventmart.sources import snapshots
from eventmart.sources.schemas import LANDED_LINES

LAYERS = ("raw_data", "staging", "warehouse")
# Where tables are found that are not of the star.
LAYER_OF = {"raw_lines": "raw_data", "stg_sales": "staging"}


class Catalog:
    """Tables of one environment, told apart from others by the prefix of its databases."""

    def __init__(self, spark: SparkSession, prefix: str, root: str):
        self.spark = spark
        self.prefix = prefix
        self.root = root.rstrip("/")

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.prefix}_{layer}" if self.prefix else layer

    def name(self, table: str) -> str:
        return f"`{self.database(LAYER_OF.get(table, 'warehouse'))}`.`{table}`"

    def table(self, table: str) -> DataFrame:
        """A table by its short name, as the numbered questions ask for it."""
        return self.spark.table(self.name(table))

    def create(self) -> None:
        for layer in LAYERS:
            place = f"{self.root}/{self.database(layer)}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}` LOCATION '{place}'")

    def drop(self) -> None:
        """Forgets all names; files outside the databases' own folders stay."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database(layer)}` CASCADE")

    def _versions(self, table: str) -> list[str]:
        found = self.spark.sql(f"SHOW TABLES IN `{self.database('raw_data')}` LIKE '{table}_v*'").collect()
        return sorted(row["tableName"] for row in found)

    def register_lines(self, path: str, schema: StructType = LANDED_LINES) -> None:
        """Lets ``raw_lines`` show the newest commit of a landed table, an empty one included."""
        now = snapshots.current(self.spark, path)
        if now is None:
            raise FileNotFoundError(f"no table at {path}")
        database, old = self.database("raw_data"), self._versions("raw_lines")
        new = f"raw_lines_v{now.version:010d}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{new}` ({columns}, `load` string) USING parquet "
            f"PARTITIONED BY (`load`, `sale_date`) LOCATION '{path}'"
        )
        parts = []
        for place in snapshots.folders(now):
            load, day = (piece.split("=", 1)[1] for piece in place.split("/"))
            value = "null" if day == "__HIVE_DEFAULT_PARTITION__" else f"'{day}'"
            parts.append(f"PARTITION (`load`='{load}', `sale_date`={value}) LOCATION '{path}/{place}'")
        if parts:
            self.spark.sql(f"ALTER TABLE `{database}`.`{new}` ADD IF NOT EXISTS {' '.join(parts)}")
        chosen = ", ".join(f"`{name}`" for name in schema.names)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name('raw_lines')} AS SELECT {chosen} FROM `{database}`.`{new}`")
        for name in old:
            if name != new:
                self.spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")

    def register_star(self, star: Star) -> None:
        """Names the star's written tables; staged sales are written into their own layer."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name('stg_sales')}")
        staged = star.table("stg_sales").write.mode("overwrite").option("compression", COMPRESSION)
        staged.saveAsTable(self.name("stg_sales").replace("`", ""))
        for table in (name for step in STEPS for name in step if name not in LAYER_OF):
            written = star.table(table)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema)
            by = PARTITIONED.get(table, [])
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
            layout = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
            self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {layout} LOCATION '{star.root}/{table}'")
            if by:
                self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)}")
