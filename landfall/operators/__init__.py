from landfall.operators.dedup import (
    drop_exact,
    duplicate_groups,
    fingerprint,
    keep_first_copy,
    keep_latest,
    order_spec,
)
from landfall.operators.staging import stage, to_text, union_sources
from landfall.operators.typed import (
    REJECTED,
    REJECTS,
    ColumnSpec,
    accepted_rows,
    apply_types,
    reject_entries,
    split_typed,
)
from landfall.operators.upsert import insert_new, merge_latest

__all__ = [
    "REJECTED",
    "REJECTS",
    "ColumnSpec",
    "accepted_rows",
    "apply_types",
    "drop_exact",
    "duplicate_groups",
    "fingerprint",
    "insert_new",
    "keep_first_copy",
    "keep_latest",
    "merge_latest",
    "order_spec",
    "reject_entries",
    "split_typed",
    "stage",
    "to_text",
    "union_sources",
]
