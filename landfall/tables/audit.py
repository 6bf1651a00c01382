"""The load log: one row per load attempt, success or failure, append only.

The first six columns are the load log the reference keeps; the rest are ours
(source, layer, mode, exact counts, high-water mark, partition layout, the
written schema of the version, rows that came too late for an increment, and the
last version of other tables that the load has taken in). Rows are appended as one small Parquet folder
each, under a folder per table and month
(``<audit>/<table>/<YYYYMM>/<load_id>-s<status>``), so concurrent loads never
share an output folder and a table's readers list only its own recent loads.

Past months can be folded (:func:`fold_audit`): a copy of a month's rows in one
file beside the log, named by their number. Readers take it as long as the month
has that many entries, so a row that comes late is never missed: it only makes
them read the entries themselves until the month is folded again.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("database_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("comment", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_duplicate", T.LongType()),
        T.StructField("high_water", T.StringType()),
        T.StructField("partitions", T.StringType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("rows_late", T.LongType()),
        T.StructField("consumed", T.StringType()),
    ]
)

STATUS_OK = 1
STATUS_FAILED = 0


def audit_row(
    *,
    database_name: str,
    table_name: str,
    start_time: datetime,
    end_time: datetime,
    status: int,
    comment: str,
    source: str | None = None,
    load_id: str | None = None,
    layer: str | None = None,
    mode: str | None = None,
    rows_read: int | None = None,
    rows_written: int | None = None,
    rows_rejected: int | None = None,
    rows_duplicate: int | None = None,
    high_water: str | None = None,
    partitions: str | None = None,
    schema_json: str | None = None,
    rows_late: int | None = None,
    consumed: str | None = None,
) -> Row:
    return Row(
        database_name=database_name,
        table_name=table_name,
        start_time=start_time,
        end_time=end_time,
        status=status,
        comment=comment,
        source=source,
        load_id=load_id,
        layer=layer,
        mode=mode,
        rows_read=rows_read,
        rows_written=rows_written,
        rows_rejected=rows_rejected,
        rows_duplicate=rows_duplicate,
        high_water=high_water,
        partitions=partitions,
        schema_json=schema_json,
        rows_late=rows_late,
        consumed=consumed,
    )


def audit_frame(spark: SparkSession, row: Row) -> DataFrame:
    """The row as a one-row frame of literals (no Python worker is involved)."""
    values = row.asDict()
    return spark.range(1).select(
        *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA.fields]
    )


def month_of(load_id: str | None) -> str:
    """``YYYYMM`` bucket of a load (load ids start with their UTC time)."""
    if load_id and len(load_id) >= 6 and load_id[:6].isdigit():
        return load_id[:6]
    return datetime.now(timezone.utc).strftime("%Y%m")


def append_audit(spark: SparkSession, path: str, row: Row) -> None:
    """Write one audit row into its own new folder, independent of the load's job.

    Two jobs must never write into the same folder at once (their commit
    protocols share a ``_temporary`` directory), and loads may run
    concurrently, so every row gets a folder named by its load and status,
    under a folder per table and month: ``<audit>/<table>/<YYYYMM>/<load>-s<status>``.
    A table's readers list only its own loads, and usually only recent months.
    """
    name = f"{row['load_id'] or uuid.uuid4().hex}-s{row['status']}"
    month = month_of(row["load_id"])
    audit_frame(spark, row).write.mode("errorifexists").parquet(f"{path}/{row['table_name']}/{month}/{name}")


def read_audit(
    spark: SparkSession, path: str, table: str | None = None, month: str | None = None
) -> DataFrame:
    """The whole log, the rows of one ``table``, or of one table and ``month``; folded months from their one file."""
    paths = []
    for name in _children(spark, path) if table is None else [table]:
        for m in logged_months(spark, path, name) if month is None else [month]:
            entries = len(_children(spark, f"{path}/{name}/{m}"))
            fold = _fold_path(path, name, m, entries)
            if entries:
                paths.append(fold if _children(spark, fold, "_SUCCESS") else f"{path}/{name}/{m}/*")
    if not paths:  # nothing logged (in that month) yet
        return spark.createDataFrame([], AUDIT_SCHEMA)
    df = spark.read.schema(AUDIT_SCHEMA).parquet(*paths)
    return df if table is None else df.filter(F.col("table_name") == table)


def _children(spark: SparkSession, path: str, only: str | None = None) -> list[str]:
    """Names below a folder (those named ``only``); none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return [n for n in names if only is None or n == only]


def logged_months(spark: SparkSession, path: str, table: str) -> list[str]:
    """The months in which ``table`` has log rows, newest first (one folder per month, whatever the clock says)."""
    return sorted((n for n in _children(spark, f"{path}/{table}") if n.isdigit()), reverse=True)


def _fold_path(path: str, table: str, month: str, entries: int) -> str:
    return f"{path}_folded/{table}/{month}/of-{entries}"


def fold_audit(spark: SparkSession, path: str, table: str, before: str) -> list[str]:
    """Copy each month of ``table``'s log before the month ``before`` into one file; the months folded now.

    A month with an entry that is not committed (yet) is left as it is. The log
    itself stays, nothing is deleted. A fold that a lost driver left unfinished
    has no success mark: readers pass it over and the next call writes it again.
    """
    folded = []
    for month in logged_months(spark, path, table):
        entries = len(_children(spark, f"{path}/{table}/{month}"))
        target = _fold_path(path, table, month, entries)
        if month >= before or not entries or _children(spark, target, "_SUCCESS"):
            continue
        rows = spark.read.schema(AUDIT_SCHEMA).parquet(f"{path}/{table}/{month}/*")
        if rows.count() != entries:
            continue
        rows.coalesce(1).write.mode("overwrite").parquet(target)
        folded.append(month)
    return folded


def reconcile(audit: DataFrame) -> DataFrame:
    """Count check per successful load.

    * read = written + rejected + duplicate, and
    * for a transformed table ``<src>_tf.<t>``, read = rows written by the
      newest successful staging load of ``<src>_stg.<t>`` (``staged_rows``):
      the two counts come from different jobs, so a row lost between the
      layers shows up here.
    """
    ok = audit.filter(F.col("status") == STATUS_OK)
    staged = (
        ok.filter(F.col("layer") == "stg")
        .groupBy(F.col("table_name").alias("_stg_table"))
        .agg(F.max_by("rows_written", "load_id").alias("staged_rows"))
    )
    loads = ok.filter(F.col("rows_read").isNotNull()).withColumn(
        "_stg_table", F.regexp_replace("table_name", r"_tf\.", "_stg.")
    )
    loads = loads.join(staged, "_stg_table", "left")
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in ("rows_written", "rows_rejected", "rows_duplicate")]
    counts_add_up = F.col("rows_read") == parts[0] + parts[1] + parts[2]
    is_tf = F.col("layer") == "tf"
    matches_staging = ~is_tf | F.col("staged_rows").isNull() | (F.col("rows_read") == F.col("staged_rows"))
    return loads.select(
        "source",
        "table_name",
        "load_id",
        "rows_read",
        parts[0].alias("rows_written"),
        parts[1].alias("rows_rejected"),
        parts[2].alias("rows_duplicate"),
        F.when(is_tf, F.col("staged_rows")).alias("staged_rows"),
        (counts_add_up & matches_staging).alias("balanced"),
    )
