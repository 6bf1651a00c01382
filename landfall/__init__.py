"""landfall: warehouse loading on Spark.

Extract tables (JDBC or lake files), land them as text, type them with every
unconvertible value kept in a rejects table, remove duplicates, and publish
fact, dimension and report tables so that readers never see a half-finished
load. Every load writes one audit row with times, status and exact counts.

The caller owns the ``SparkSession``; every public function takes and returns
DataFrames or writes through :class:`landfall.tables.TableStore`.
"""

from landfall.functions.casts import (
    parse_boolean,
    parse_date,
    parse_decimal,
    parse_int,
    parse_timestamp,
)
from landfall.operators.dedup import drop_exact, duplicate_groups, keep_first_copy, keep_latest
from landfall.operators.staging import stage, to_text
from landfall.operators.typed import ColumnSpec, apply_types, split_typed
from landfall.operators.upsert import merge_latest
from landfall.plans.layers import TableRule, run_layer, run_pipeline
from landfall.plans.steps import Step, run_steps, steps_from_dir
from landfall.sources.catalog import Extract, catalog_from_dir, stage_catalog
from landfall.sources.incremental import load_increment
from landfall.sources.jdbc import JdbcPartitioning, JdbcSource, load_table, load_table_once
from landfall.sources.lake import ParquetSource
from landfall.streaming.landing import Landing, load_landed_files
from landfall.tables.audit import AUDIT_SCHEMA, reconcile
from landfall.tables.store import LoadResult, TableStore

__all__ = [
    "AUDIT_SCHEMA",
    "ColumnSpec",
    "Extract",
    "JdbcPartitioning",
    "JdbcSource",
    "Landing",
    "LoadResult",
    "ParquetSource",
    "Step",
    "TableRule",
    "TableStore",
    "catalog_from_dir",
    "load_increment",
    "load_landed_files",
    "load_table",
    "load_table_once",
    "run_layer",
    "run_pipeline",
    "run_steps",
    "stage_catalog",
    "steps_from_dir",
    "apply_types",
    "drop_exact",
    "duplicate_groups",
    "keep_first_copy",
    "keep_latest",
    "merge_latest",
    "parse_boolean",
    "parse_date",
    "parse_decimal",
    "parse_int",
    "parse_timestamp",
    "reconcile",
    "split_typed",
    "stage",
    "to_text",
]
