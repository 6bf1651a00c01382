"""A source whose tables are Parquet files; extract queries run on Spark SQL.

Each table is registered as a temporary view under its own name, then the
query text runs through ``spark.sql``. Catalyst pushes its filters and column
pruning into the Parquet scans (``PushedFilters`` / ``ReadSchema``), which is
what the JDBC source does by sending the text to the database.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from landfall.sources.jdbc import clean_query


@dataclass(frozen=True)
class ParquetSource:
    name: str
    tables: Mapping[str, str] = field(default_factory=dict)  # view name → path

    @classmethod
    def from_dir(cls, name: str, directory: str, tables: list[str]) -> "ParquetSource":
        return cls(name, {t: f"{directory.rstrip('/')}/{t}.parquet" for t in tables})

    def register(self, spark: SparkSession) -> None:
        for view, path in self.tables.items():
            spark.read.parquet(path).createOrReplaceTempView(view)

    def extract(self, spark: SparkSession, query: str, registered: bool = False) -> DataFrame:
        if not registered:
            self.register(spark)
        return spark.sql(clean_query(query))


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
