"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import scratch_dir


def col(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"__{stem}_{uuid.uuid4().hex[:6]}"
    return name


def written(spark: SparkSession, df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Cut the lineage: write to the shared folder, read back.

    The table lies below ``spark.checkpoint.dir``, so every executor can read
    it and a lost executor costs no recomputation of what came before.
    """
    path = scratch_dir(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
