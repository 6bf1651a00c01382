"""Where the library may write scratch and lineage-cutting tables.

On a cluster that is the shared folder named by ``spark.checkpoint.dir``;
a machine-local temporary folder would vanish with its executor. Only when
the session names no such folder (unit tests, a laptop) do we create one and
register it, so later ``checkpoint()`` calls land in the same place.
"""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

_CONF_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, creating a local one only if unset."""
    configured = spark.conf.get(_CONF_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the session conf is visible
        sc = None
    if not configured and sc is not None:
        configured = sc.getConf().get(_CONF_KEY, None)
    if not configured:
        current = sc.getCheckpointDir() if sc is not None else None
        if current:
            return current.rstrip("/")
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CONF_KEY} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="landfall-ckpt-")
        log.warning("spark.checkpoint.dir is unset; using local %s (tests only)", configured)
        if sc is not None:
            sc.setCheckpointDir(configured)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/landfall/{label}-{uuid.uuid4().hex[:12]}"
