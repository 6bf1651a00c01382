"""Run in its own process: a session that retries tasks, and a write whose
first attempt of one task fails. The observed count must not double."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from landfall.tables.store import TableStore  # noqa: E402

spark = (
    SparkSession.builder.master("local[2,4]")  # up to 4 attempts per task
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
store = TableStore(spark, tempfile.mkdtemp(prefix="landfall-retry-"))


def flaky(batches):
    ctx = TaskContext.get()
    for pdf in batches:
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated lost executor")
        yield pdf


df = spark.range(0, 10000, numPartitions=4).mapInPandas(flaky, "id long")
res = store.refresh(df, "t.flaky")
print("ROWS", res.rows_written, store.read("t.flaky").count(), store.audit().count())
spark.stop()
