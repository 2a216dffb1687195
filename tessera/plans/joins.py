"""Joins of every kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import joins as op
from tessera.plans.catalog import query
from tessera.session import table


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return c.join(o, (c.c_custkey == o.o_custkey) & (o.o_totalprice > 300000), "left").select("c_custkey", "o_orderkey")


@query("SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_orderstatus = 'P') RIGHT JOIN customer ON o_custkey = c_custkey")
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "right").select("o_orderkey", "c_custkey")


@query("""
    SELECT s_suppkey, c_custkey FROM (SELECT * FROM supplier WHERE s_acctbal > 2000) FULL JOIN (SELECT * FROM customer WHERE c_acctbal < 3000)
    ON s_suppkey = c_custkey""")
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = table(spark, sf_dir, "supplier").filter("s_acctbal > 2000"), table(spark, sf_dir, "customer").filter("c_acctbal < 3000")
    return s.join(c, s.s_suppkey == c.c_custkey, "full").select("s_suppkey", "c_custkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").crossJoin(table(spark, sf_dir, "nation")).select("r_name", "n_name")


@query("SELECT a.n_name AS low, b.n_name AS high FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey >= b.n_regionkey")
def join_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    a, b = n.alias("a"), n.alias("b")
    joined = a.join(b, F.expr("a.n_nationkey < b.n_nationkey AND a.n_regionkey >= b.n_regionkey"))
    return joined.select(F.col("a.n_name").alias("low"), F.col("b.n_name").alias("high"))


@query("""
    SELECT o_orderkey, p_partkey FROM orders JOIN (SELECT p_partkey, p_retailprice * 100 AS low, p_retailprice * 100 + 40 AS high FROM part)
    ON o_totalprice >= low AND o_totalprice < high""")
def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") * 100).alias("low"), (F.col("p_retailprice") * 100 + 40).alias("high"))
    return op.in_ranges(table(spark, sf_dir, "orders"), "o_totalprice", ranges, "low", "high", 40.0).select("o_orderkey", "p_partkey")


@query("""
    SELECT r_name, n_name, c_custkey, o_orderkey FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 200000""")
def join_multiway(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, n, c, o = (table(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))
    joined = r.join(n, r.r_regionkey == n.n_regionkey).join(c, c.c_nationkey == n.n_nationkey).join(o, o.o_custkey == c.c_custkey)
    return joined.filter("o_totalprice > 200000").select("r_name", "n_name", "c_custkey", "o_orderkey")


@query("SELECT a.s_suppkey AS a_key, b.s_suppkey AS b_key FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def join_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    joined = s.alias("a").join(s.alias("b"), F.expr("a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey"))
    return joined.select(F.col("a.s_suppkey").alias("a_key"), F.col("b.s_suppkey").alias("b_key"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'"), table(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders").filter("o_totalprice > 400000"), table(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey", "c_name")


@query("""
    SELECT o_orderkey, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderstatus = 'O' AND upper(o_orderpriority) = '1-URGENT' AND l_quantity > 40 AND l_discount * 100 > o_custkey % 10""")
def join_with_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, i = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    joined = o.join(i, o.o_orderkey == i.l_orderkey)
    rows = joined.filter("o_orderstatus = 'O' AND upper(o_orderpriority) = '1-URGENT' AND l_quantity > 40 AND l_discount * 100 > o_custkey % 10")
    return rows.select("o_orderkey", "l_linenumber", "l_quantity")


@query("SELECT event_id, c_name FROM events JOIN customer ON user_id = c_custkey")
def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return op.salted(table(spark, sf_dir, "events"), customers, ["user_id"], 8).select("event_id", "c_name")
