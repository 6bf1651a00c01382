from landfall.sources.catalog import Extract, catalog_from_dir, stage_catalog, staging_table
from landfall.sources.incremental import load_increment, since_filter
from landfall.sources.jdbc import (
    JdbcPartitioning,
    JdbcSource,
    clean_query,
    extract,
    extract_options,
    key_bounds,
    key_strides,
    load,
    load_table,
    load_table_once,
    snapshot_query,
    target_rows,
    text_column_types,
    wrap_query,
    write_options,
)
from landfall.sources.lake import ParquetSource, read_table

__all__ = [
    "Extract",
    "JdbcPartitioning",
    "JdbcSource",
    "ParquetSource",
    "catalog_from_dir",
    "clean_query",
    "extract",
    "extract_options",
    "key_bounds",
    "key_strides",
    "load",
    "load_increment",
    "load_table",
    "load_table_once",
    "read_table",
    "since_filter",
    "snapshot_query",
    "stage_catalog",
    "staging_table",
    "target_rows",
    "text_column_types",
    "wrap_query",
    "write_options",
]
