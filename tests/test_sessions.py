"""Whole sessions over the given tables: what a server's tables return equals DuckDB over the same files."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as fn
from tessera.registry import Registry
from tessera.sources.writer import UnsupportedWriteError

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shop(spark, tmp_path):
    """A server on an empty folder, with the given tables imported as they are."""
    registry = Registry(spark)
    registry.create_server("shop", database=str(tmp_path / "shop"))
    registry.import_schema("shop", SF, only={"customer", "orders", "nation"})
    yield registry
    registry.drop_server("shop", cascade=True)


def expected(sql):
    con = duckdb.connect()
    for name in ("customer", "orders", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con.execute(sql).fetchall()


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT o_orderstatus, count(*), min(o_orderkey), max(o_orderkey) FROM orders GROUP BY o_orderstatus ORDER BY 1",
        "SELECT o_orderkey, o_orderdate FROM orders WHERE o_custkey = 7 OR o_orderpriority LIKE '1-%' ORDER BY o_orderkey",
        "SELECT n_name, count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name HAVING count(*) > 2 ORDER BY n_name",
        "SELECT c_custkey, count(o_orderkey) FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey ORDER BY 2 DESC, 1 LIMIT 20",
        "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) ORDER BY 1",
    ],
)
def test_imported_tables_answer_as_duckdb_does(shop, sql):
    assert rows(shop.query(sql)) == expected(sql)


def test_filters_of_a_query_reach_the_scan(shop):
    plan = shop.explain("SELECT o_orderkey FROM orders WHERE o_custkey = 7")
    assert "EqualTo(o_custkey,7)" in plan and "o_orderpriority" not in plan.split("ReadSchema")[-1]


def test_a_table_stored_in_two_parts_is_the_whole(shop):
    shop.store("shop", "split", shop.query("SELECT * FROM orders WHERE o_orderkey % 3 = 0"))
    shop.create_table("split", "shop")
    shop.insert("split", shop.query("SELECT * FROM orders WHERE o_orderkey % 3 <> 0"))
    differs = shop.query("(SELECT * FROM orders EXCEPT ALL SELECT * FROM split) UNION ALL (SELECT * FROM split EXCEPT ALL SELECT * FROM orders)")
    assert differs.count() == 0
    for refused in (shop.update, shop.delete):
        with pytest.raises(UnsupportedWriteError):
            refused("split")


def test_columns_left_out_of_an_append_are_null(shop):
    shop.create_stored_table("shop", "visits", {"customer": "BIGINT", "day": "DATE", "paid": "DECIMAL(12,2)", "member": "BOOLEAN"})
    shop.create_table("visits", "shop")
    customers = shop.table("customer")
    shop.insert("visits", customers.select(F.col("c_custkey").alias("customer"), fn.date_plus(F.lit("2023-02-27"), F.col("c_custkey") % 5).alias("day")))
    n = customers.count()
    assert rows(shop.query("SELECT count(*), count(paid), count(member), count(day) FROM visits")) == [(n, 0, 0, n)]
    assert rows(shop.query("SELECT DISTINCT CAST(day AS STRING) FROM visits WHERE customer % 5 = 2")) == [("2023-03-01",)]


def test_a_copy_is_a_table_again(shop, tmp_path):
    sql = "SELECT n_nationkey, upper(n_name) AS loud FROM nation WHERE n_regionkey >= 2"
    shop.copy_to(sql, str(tmp_path / "loud.parquet"))
    assert shop.import_schema("shop", str(tmp_path / "loud.parquet"), prefix="copied_") == ["copied_loud"]
    assert sorted(rows(shop.table("copied_loud"))) == sorted(expected(sql))
    direct = shop.create_table("direct", "shop", {"n_nationkey": "INT", "loud": "TEXT"}, table=str(tmp_path / "loud.parquet"))
    assert direct.exceptAll(shop.table("copied_loud").select(F.col("n_nationkey").cast("int"), "loud")).isEmpty()


def test_arrays_and_json_of_stored_tables(shop):
    shop.create_stored_table("shop", "points", {"name": "TEXT", "at": "FLOAT[2]", "about": "JSON"})
    points = shop.create_table("points", "shop")
    shop.execute("shop", """INSERT INTO points SELECT n_name, CAST(array(n_nationkey, n_regionkey) AS array<float>), to_json(named_struct('region', n_regionkey)) FROM parquet.`%s/nation.parquet`""" % SF)
    points = shop.table("points")
    origin = F.array(F.lit(0.0).cast("float"), F.lit(0.0).cast("float"))
    found = points.select("name", fn.l2_distance("at", origin).alias("far"), F.get_json_object("about", "$.region").cast("int").alias("region"))
    want = expected("SELECT n_name, sqrt(n_nationkey * n_nationkey + n_regionkey * n_regionkey), n_regionkey FROM nation")
    assert sorted((n, round(d, 6), r) for n, d, r in rows(found)) == sorted((n, round(d, 6), r) for n, d, r in want)
