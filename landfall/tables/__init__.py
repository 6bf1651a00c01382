from landfall.tables.audit import AUDIT_SCHEMA, STATUS_FAILED, STATUS_OK, read_audit, reconcile
from landfall.tables.store import LoadResult, NoVisibleVersion, TableStore, new_load_id

__all__ = [
    "AUDIT_SCHEMA",
    "STATUS_FAILED",
    "STATUS_OK",
    "LoadResult",
    "NoVisibleVersion",
    "TableStore",
    "new_load_id",
    "read_audit",
    "reconcile",
]
