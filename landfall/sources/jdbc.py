"""Extract by query over JDBC, and bulk load over JDBC.

The query text is wrapped as a derived table and read with Spark's JDBC
source. Unlike a one-partition read, :func:`extract` accepts a partition
column with bounds, so ``num_partitions`` executors each read one stride of the
key range, or conditions from :func:`key_strides`, strides of equally many rows
for keys that bunch; Spark pushes filters and the column projection into the remote
query. Credentials come as ``properties``, of the source or of a call, and
never show in a source's ``repr``.

:func:`load` only writes; :func:`load_table` also checks the columns, counts
the rows as they are written and logs the load. :func:`load_table_once` does so
through a side table and one transaction, for loads that survive lost tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.dedup import keep_latest
from landfall.session import scratch_dir
from landfall.tables.store import LoadResult, TableStore


@dataclass(frozen=True)
class JdbcSource:
    """A source database: a full ``url``, or ``server`` + ``database`` for SQL Server."""

    name: str
    url: str | None = None
    server: str | None = None
    database: str | None = None
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)  # user, password
    num_partitions: int = 8  # of reads that name a partition column
    balanced: bool = False  # strides of equally many rows instead of equal width; costs the source a sort

    def jdbc_url(self) -> str:
        if self.url:
            return self.url
        if self.server and self.database:
            return f"jdbc:sqlserver://{self.server};databaseName={self.database}"
        raise ValueError(f"source {self.name!r} needs url, or server and database")

    def reader_options(self, properties: Mapping[str, str] | None = None) -> dict[str, str]:
        opts = {"url": self.jdbc_url()}
        if self.driver:
            opts["driver"] = self.driver
        opts.update(self.options)
        opts.update(self.properties)
        opts.update(properties or {})
        return opts

    def extract(
        self, spark: SparkSession, query: str, partition_column: str | None = None, changed_at: str | None = None
    ) -> DataFrame:
        """Rows of ``query``; in parallel strides of ``partition_column``, if the query has one, and
        as of one moment, if it has a column ``changed_at``."""
        if changed_at:
            query = snapshot_query(spark, self, query, changed_at)
        parts = None
        if partition_column and self.balanced:
            strides = key_strides(spark, self, query, partition_column, self.num_partitions)
            return extract(spark, self, query, predicates=strides)
        if partition_column:
            parts = key_bounds(spark, self, query, partition_column, self.num_partitions)
        return extract(spark, self, query, partitioning=parts)


@dataclass(frozen=True)
class JdbcPartitioning:
    """Parallel read: ``num_partitions`` strides of ``column`` between the bounds.

    Bounds only set the stride; rows outside them still land in the first or
    last partition, so no row is lost when bounds are stale.
    """

    column: str
    lower: int | str
    upper: int | str
    num_partitions: int


def clean_query(sql: str) -> str:
    """Query text without surrounding whitespace and trailing semicolons."""
    text = sql.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise ValueError("empty query")
    return text


def wrap_query(sql: str, alias: str = "q") -> str:
    """``(<sql>) q`` – a trailing ``;`` would break the derived table, so it is removed;
    a line break ends a trailing comment."""
    query = clean_query(sql)
    return f"({query}\n) {alias}" if "--" in query else f"({query}) {alias}"


def extract_options(
    source: JdbcSource,
    query: str,
    *,
    partitioning: JdbcPartitioning | None = None,
    fetchsize: int = 10_000,
    prepare_query: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    opts = source.reader_options(properties)
    opts["dbtable"] = wrap_query(query)
    opts["fetchsize"] = str(fetchsize)
    opts["preferTimestampNTZ"] = "true"
    if prepare_query:
        # For a leading WITH on SQL Server: the CTE goes here, the SELECT in `query`.
        opts["prepareQuery"] = prepare_query
    if partitioning is not None:
        opts["partitionColumn"] = partitioning.column
        opts["lowerBound"] = str(partitioning.lower)
        opts["upperBound"] = str(partitioning.upper)
        opts["numPartitions"] = str(partitioning.num_partitions)
    return opts


def extract(
    spark: SparkSession,
    source: JdbcSource,
    query: str,
    *,
    partitioning: JdbcPartitioning | None = None,
    fetchsize: int = 10_000,
    prepare_query: str | None = None,
    properties: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``query``: by one connection, in strides of ``partitioning``, or one task per predicate."""
    if predicates and partitioning:
        raise ValueError("give partitioning or predicates, not both")
    opts = extract_options(
        source, query, partitioning=partitioning, fetchsize=fetchsize,
        prepare_query=prepare_query, properties=properties,
    )
    if predicates:
        return spark.read.jdbc(opts.pop("url"), opts.pop("dbtable"), predicates=list(predicates), properties=opts)
    return spark.read.format("jdbc").options(**opts).load()


def key_bounds(
    spark: SparkSession,
    source: JdbcSource,
    query: str,
    column: str,
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
) -> JdbcPartitioning | None:
    """Bounds for a parallel read, computed *in the source database* (one row back)."""
    bounds_sql = f"select min({column}) as lo, max({column}) as hi from {wrap_query(query, 'b')}"
    row = extract(spark, source, bounds_sql, properties=properties).first()
    if row is None or row["lo"] is None:
        return None
    return JdbcPartitioning(column, row["lo"], row["hi"], num_partitions)


def sql_literal(value) -> str:
    """A key value as text in a condition."""
    if isinstance(value, (dt.date, dt.datetime, str)):
        return "'" + str(value).replace("'", "''") + "'"
    return str(value)


def key_strides(
    spark: SparkSession,
    source: JdbcSource,
    query: str,
    column: str,
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
) -> list[str]:
    """Conditions that deal the rows of ``query`` into strides of about equally many rows.

    The source ranks the keys and sends one row per stride. Every row, with a
    NULL key or one that arrives later too, meets exactly one condition. Rows
    of one key stay together. No rows: no conditions.
    """
    lows_sql = (
        f"select part, min({column}) as lo from (select {column}, ntile({num_partitions}) over (order by {column}) "
        f"as part from {wrap_query(query, 'b')} where {column} is not null) s group by part"
    )
    rows = extract(spark, source, lows_sql, properties=properties).collect()
    lows = [sql_literal(r["lo"]) for r in sorted(rows, key=lambda r: r["part"])]
    edges = [lo for i, lo in enumerate(lows) if i and lo != lows[i - 1]]
    if not edges:
        return []
    between = [f"{column} >= {a} and {column} < {b}" for a, b in zip(edges, edges[1:], strict=False)]
    return [f"{column} < {edges[0]} or {column} is null", *between, f"{column} >= {edges[-1]}"]


def snapshot_query(
    spark: SparkSession,
    source: JdbcSource,
    query: str,
    changed_at: str,
    properties: Mapping[str, str] | None = None,
) -> str:
    """``query`` without the rows that change after now, by its column of the last change.

    Strides are read by separate statements. A row whose key changes in between
    could come in two of them, or in none; with this condition it comes at most
    once, and if it is passed over, an increment by ``changed_at`` reads it next
    time, since the high-water mark is not above the moment taken here.
    """
    latest = f"select max({changed_at}) as hi from {wrap_query(query, 'b')}"
    row = extract(spark, source, latest, properties=properties).first()
    if row is None or row["hi"] is None:
        return query
    return f"select * from {wrap_query(query, 's')} where {changed_at} <= {sql_literal(row['hi'])} or {changed_at} is null"


def write_options(
    target: JdbcSource,
    table: str,
    *,
    batchsize: int = 10_000,
    num_partitions: int | None = None,
    truncate: bool = False,
    column_types: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    opts = target.reader_options(properties)
    opts["dbtable"] = table
    opts["batchsize"] = str(batchsize)
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)  # caps concurrent connections
    if truncate:
        opts["truncate"] = "true"
    if column_types:
        opts["createTableColumnTypes"] = column_types
    return opts


def text_column_types(df: DataFrame, length: int) -> str:
    """``createTableColumnTypes`` for an all-text staging table whose texts are known to fit ``length``.

    Without it Spark creates string columns as the database's large-text type,
    which takes any text but in some databases cannot be compared in a
    predicate. A longer text makes the database refuse the load.
    """
    return ", ".join(f"{c} VARCHAR({length})" for c in df.columns)


def load(
    df: DataFrame,
    target: JdbcSource,
    table: str,
    mode: str = "append",
    **kw,
) -> None:
    """Bulk write over JDBC. ``mode="overwrite", truncate=True`` is the non-atomic
    refresh; for an atomic one load a side table and let the database swap it."""
    opts = write_options(target, table, **kw)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def load_table(
    store: TableStore,
    df: DataFrame,
    target: JdbcSource,
    table: str,
    mode: str = "append",
    *,
    layer: str | None = None,
    properties: Mapping[str, str] | None = None,
    **kw,
) -> LoadResult:
    """:func:`load`, logged in ``store`` as ``<target>_jdbc.<table>`` with its row count.

    An append is refused, and logged as failed, if ``df`` has a column that
    the target lacks. JDBC tasks commit one by one: a task that is lost after
    its commit writes its rows again, and only a key in the database keeps
    them out (:func:`load_table_once` needs none). ``target_rows`` counts what arrived.
    """

    def write(observed: DataFrame) -> None:
        if mode == "append":
            none = f"select * from {table} where 1 = 0"
            check_append_schema(observed, extract(store.spark, target, none, properties=properties).columns)
        load(observed, target, table, mode, properties=properties, **kw)

    return store.log_write(df, f"{target.name}_jdbc.{table}", write, f"jdbc_{mode}", source=target.name, layer=layer)


#: Run once in a target database whose loads are named (``load_key``); fixed names.
LOADS_TABLE = "landfall_loads"
LOADS_TABLE_DDL = f"create table {LOADS_TABLE} (load_key varchar(200) not null primary key, rows_loaded bigint)"

ROW = "landfall_row"
ONCE_MODES = ("append", "overwrite", "upsert")


def load_table_once(
    store: TableStore,
    df: DataFrame,
    target: JdbcSource,
    table: str,
    mode: str = "append",
    *,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    load_key: str | None = None,
    side_table: str | None = None,
    layer: str | None = None,
    properties: Mapping[str, str] | None = None,
    **kw,
) -> LoadResult | None:
    """Load ``df`` into an existing ``table`` so that every row arrives once and all of them become visible together.

    JDBC tasks commit one by one, so tasks write numbered rows into a side table
    (``<table>_load``, made anew). A task that is lost after its commit writes the
    same numbers again, since they are given to a written copy of ``df``. Then
    one transaction in the database empties the target (``overwrite``) or
    deletes the rows of the keys that come (``upsert``, the latest row per key under ``order``; rows
    with a NULL key are added), takes one row of each number, and rolls back unless their count is that of the rows written.

    ``load_key`` names the load in :data:`LOADS_TABLE` within that transaction:
    a run that crashed before its log row can be repeated, and gives None if
    the load is there already. One job at a time may load a table.
    """
    if mode not in ONCE_MODES or (mode == "upsert") != bool(keys):
        raise ValueError(f"mode must be one of {ONCE_MODES}, with keys for an upsert")
    spark, side = store.spark, side_table or f"{table}_load"
    if load_key is not None:
        done = f"select rows_loaded from {LOADS_TABLE} where load_key = {sql_literal(load_key)}"
        if extract(spark, target, done, properties=properties).first() is not None:
            return None

    def write(observed: DataFrame) -> None:
        columns = extract(spark, target, f"select * from {table} where 1 = 0", properties=properties).columns
        check_append_schema(observed, columns)
        path = scratch_dir(spark, "jdbc")
        observed.write.parquet(path)
        rows = spark.read.schema(observed.schema).parquet(path)
        expected = rows.count()
        load(rows.withColumn(ROW, F.monotonically_increasing_id()), target, side, "overwrite", properties=properties, **kw)
        own = {c.lower(): c for c in columns}
        quoted = {c: quote(spark, target, c) for c in observed.columns}
        into = {c: quote(spark, target, own[c.lower()]) for c in observed.columns}
        statements = merge_statements(table, side, quoted, into, quote(spark, target, ROW), mode, keys, expected)
        if load_key is not None:
            statements.append((f"insert into {LOADS_TABLE} (load_key, rows_loaded) values ({sql_literal(load_key)}, {expected})", 1))
        in_one_transaction(spark, target, statements, properties)
        in_one_transaction(spark, target, [(f"drop table {side}", None)], properties)

    rows = keep_latest(df, keys, order) if keys else df
    return store.log_write(rows, f"{target.name}_jdbc.{table}", write, f"jdbc_{mode}", source=target.name, layer=layer)


def merge_statements(
    table: str,
    side: str,
    quoted: Mapping[str, str],
    into: Mapping[str, str],
    row: str,
    mode: str,
    keys: Sequence[str],
    expected: int,
) -> list[tuple[str, int | None]]:
    """Statements that take the numbered rows of ``side`` into ``table``, with the rows each must change (None: any).

    ``quoted`` and ``into`` are the columns as the side table and the target name them.
    """
    statements: list[tuple[str, int | None]] = []
    if mode == "overwrite":
        statements.append((f"delete from {table}", None))
    if mode == "upsert":
        same = " and ".join(f"s.{quoted[k]} = {table}.{into[k]}" for k in keys)
        statements.append((f"delete from {table} where exists (select 1 from {side} s where {same})", None))
    names = ", ".join(quoted.values())
    copies = f"select {names}, row_number() over (partition by {row} order by {row}) as landfall_copy from {side}"
    insert = f"insert into {table} ({', '.join(into.values())}) select {names} from ({copies}) s where landfall_copy = 1"
    return [*statements, (insert, expected)]


def quote(spark: SparkSession, target: JdbcSource, column: str) -> str:
    """A column name as the target's dialect quotes it (as Spark does where it makes a table)."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(target.jdbc_url()).quoteIdentifier(column)


def in_one_transaction(
    spark: SparkSession,
    target: JdbcSource,
    statements: Sequence[tuple[str, int | None]],
    properties: Mapping[str, str] | None = None,
) -> None:
    """Run statements in the database over one connection of the driver: all of them, or none.

    A statement that must change a number of rows and changes another ends the transaction.
    """
    opts = target.reader_options(properties)
    jvm, url = spark._jvm, opts.pop("url")
    if "driver" in opts:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(opts.pop("driver"))
    given = jvm.java.util.Properties()
    for name, value in opts.items():
        given.setProperty(name, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        for sql, expected in statements:
            statement = connection.createStatement()
            large = expected is not None and expected > 2**31 - 1
            changed = statement.executeLargeUpdate(sql) if large else statement.executeUpdate(sql)
            check_changed(sql, changed, expected)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def check_changed(sql: str, changed: int, expected: int | None) -> None:
    if expected is not None and changed != expected:
        raise RuntimeError(f"{changed} rows changed where {expected} were written: {sql}")


def target_rows(
    spark: SparkSession, target: JdbcSource, table: str, properties: Mapping[str, str] | None = None
) -> int:
    """Rows of a target table, counted in its database (one row back)."""
    return int(extract(spark, target, f"select count(*) as n from {table}", properties=properties).first()[0])


def check_append_schema(df: DataFrame, target_columns: list[str]) -> None:
    """JDBC append matches by name; an extra column fails late, so fail early."""
    extra = [c for c in df.columns if c.lower() not in {t.lower() for t in target_columns}]
    if extra:
        raise ValueError(f"columns not in the target table: {extra}")
