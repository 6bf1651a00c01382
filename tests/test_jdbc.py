import datetime as dt
import decimal

import pytest

from landfall.plans.layers import run_pipeline
from landfall.sources.catalog import Extract
from landfall.sources.jdbc import (
    JdbcPartitioning,
    JdbcSource,
    check_append_schema,
    clean_query,
    extract,
    extract_options,
    load_table,
    sql_literal,
    target_rows,
    wrap_query,
    write_options,
)


def test_url_from_server_and_database():
    src = JdbcSource("erp_a", server="host:1433", database="erp", driver="com.example.Driver")
    assert src.jdbc_url() == "jdbc:sqlserver://host:1433;databaseName=erp"
    assert JdbcSource("x", url="jdbc:postgresql://h/db").jdbc_url() == "jdbc:postgresql://h/db"
    with pytest.raises(ValueError):
        JdbcSource("y").jdbc_url()


def test_wrap_strips_semicolons():
    assert wrap_query("  select 1 ;; \n") == "(select 1) q"
    with pytest.raises(ValueError):
        wrap_query(" ; ")


def test_partitioned_extract_options():
    src = JdbcSource("s", url="jdbc:x:y", driver="d")
    opts = extract_options(src, "select * from t;", partitioning=JdbcPartitioning("id", 1, 1000, 8),
                           properties={"user": "u", "password": "p"})
    assert opts["dbtable"] == "(select * from t) q"
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("id", "1", "1000", "8")
    assert opts["preferTimestampNTZ"] == "true" and opts["fetchsize"] == "10000"
    assert opts["user"] == "u" and opts["driver"] == "d"


def test_write_options():
    opts = write_options(JdbcSource("t", url="jdbc:x:y"), "stg.t", truncate=True, num_partitions=4)
    assert opts == {"url": "jdbc:x:y", "dbtable": "stg.t", "batchsize": "10000", "numPartitions": "4", "truncate": "true"}


def test_append_schema_check(spark):
    df = spark.range(1).selectExpr("id", "id as extra")
    with pytest.raises(ValueError):
        check_append_schema(df, ["ID"])
    check_append_schema(df.select("id"), ["ID"])


def test_text_column_types_for_staging(spark):
    from landfall.operators.staging import to_text
    from landfall.sources.jdbc import text_column_types

    df = to_text(spark.range(1).selectExpr("id as a", "cast(id as double) as b"))
    assert text_column_types(df, 100) == "a VARCHAR(100), b VARCHAR(100)"
    opts = write_options(JdbcSource("t", url="jdbc:x:y"), "stg.t", column_types=text_column_types(df, 100))
    assert opts["createTableColumnTypes"] == "a VARCHAR(100), b VARCHAR(100)"
    # Without given types Spark takes the database's own large-text type: nothing caps a text by default.
    assert "createTableColumnTypes" not in write_options(JdbcSource("t", url="jdbc:x:y"), "stg.t")


def test_credentials_reach_the_options_but_not_the_repr():
    src = JdbcSource("s", url="jdbc:x:y", properties={"user": "u", "password": "secret"})
    assert src.reader_options()["password"] == "secret"
    assert "secret" not in repr(src)


@pytest.fixture()
def remote(spark, monkeypatch):
    """Stands in for the database: queries run on views, loads append to lists."""
    calls = {"queries": [], "written": []}

    def extract(spark, source, query, *, partitioning=None, predicates=None, **kw):
        calls["queries"].append((query, partitioning or predicates))
        return spark.sql(clean_query(query))

    def load(df, target, table, mode="append", **kw):
        calls["written"] += [(table, mode, r.id) for r in df.collect()]

    monkeypatch.setattr("landfall.sources.jdbc.extract", extract)
    monkeypatch.setattr("landfall.sources.jdbc.load", load)
    return calls


def test_catalog_of_a_jdbc_source(spark, store, remote):
    spark.range(100).createOrReplaceTempView("remote_t")
    src = JdbcSource("db", url="jdbc:x:y", num_partitions=4)
    catalog = {"plain": "select * from remote_t;", "strides": Extract("select * from remote_t", read_by="id")}
    out = run_pipeline(spark, store, sources=[src], catalogs={"db": catalog})
    assert [r.rows_written for r in out["stg"]] == [100, 100]
    assert store.read("db_stg.strides").schema["id"].dataType.simpleString() == "string"
    used = [p for q, p in remote["queries"] if p]
    assert used == [JdbcPartitioning("id", 0, 99, 4)]


@pytest.mark.parametrize("key", ["id", "cast(id as string)", "date_add(date'2024-01-01', cast(id as int))", "7", "null"])
def test_balanced_strides_hold_every_row_once(spark, remote, key):
    # A third of all rows has one key; further rows have none.
    q = "select case when id % 3 = 0 then 5 else id * id end as id from range(300)"
    q = f"select {key} as k from ({q}) union all select null from range(10)"
    src = JdbcSource("db", url="jdbc:x:y", num_partitions=6, balanced=True)
    src.extract(spark, q, "k")
    strides = remote["queries"][-1][1]
    if key in ("7", "null"):
        assert not strides  # one key can't be dealt
        return
    rows = spark.sql(q)
    sizes = [rows.filter(s).count() for s in strides]
    assert 4 <= len(strides) <= 6 and sum(sizes) == rows.count() == 310
    assert max(sizes) < 310 / 2


def test_literals_of_keys():
    assert [sql_literal(v) for v in (3, "o'k", dt.date(2024, 1, 2), decimal.Decimal("1.50"))] == [
        "3", "'o''k'", "'2024-01-02'", "1.50"]
    with pytest.raises(ValueError):
        extract(None, JdbcSource("s", url="u"), "q", partitioning=JdbcPartitioning("k", 0, 1, 2), predicates=["k = 1"])


def test_logged_load_counts_and_checks_columns(spark, store, remote):
    spark.range(3).createOrReplaceTempView("target_t")
    target = JdbcSource("db", url="jdbc:x:y")
    done = load_table(store, spark.range(5), target, "target_t", layer="dwh")
    assert done.rows_written == 5 and remote["written"] == [("target_t", "append", i) for i in range(5)]
    with pytest.raises(ValueError):
        load_table(store, spark.range(5).selectExpr("id", "id as extra"), target, "target_t")
    assert len(remote["written"]) == 5
    log = store.audit("db_jdbc.target_t").orderBy("load_id").collect()
    assert [(r["status"], r["mode"], r["rows_written"]) for r in log] == [(1, "jdbc_append", 5), (0, "jdbc_append", None)]
    assert target_rows(spark, target, "target_t") == 3
    # A load elsewhere is no table of the store.
    assert store.tables() == [] and store.register_views() == [] and not store.exists("db_jdbc.target_t")
