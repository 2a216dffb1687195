"""Scans, projections and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import predicates as p
from tessera.plans.catalog import query
from tessera.session import table
from tessera.sources.relation import resolve, series


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT count(*) AS n_rows FROM orders")
def scan_no_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(spark, f"read_parquet('{sf_dir}/nation.parquet')")


@query("SELECT n_name FROM nation WHERE n_regionkey = 1")
def scan_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve(spark, f"(SELECT n_name FROM parquet.`{sf_dir}/nation.parquet` WHERE n_regionkey = 1)")


@query("SELECT range AS i, range * range AS square FROM range(1, 1000)")
def scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, 1, 1000).select(F.col("range").alias("i"), (F.col("range") * F.col("range")).alias("square"))


@query("SELECT generate_series AS i FROM generate_series(10, 1, -3)")
def scan_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, 10, 1, -3, closed=True).toDF("i")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice >= 100000 AND o_orderdate < TIMESTAMP '1996-06-01' AND o_orderstatus <> 'P'""")
def filter_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter((F.col("o_totalprice") >= 100000) & (F.col("o_orderdate") < F.expr("timestamp_ntz'1996-06-01'")) & (F.col("o_orderstatus") != "P"))
    return rows.select("o_orderkey", "o_totalprice")


@query("""
    SELECT c_custkey, c_acctbal FROM customer
    WHERE (c_mktsegment = 'BUILDING' OR c_acctbal < 0) AND NOT (c_nationkey = 3 OR c_nationkey > 20)""")
def filter_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.filter(((c.c_mktsegment == "BUILDING") | (c.c_acctbal < 0)) & ~((c.c_nationkey == 3) | (c.c_nationkey > 20))).select("c_custkey", "c_acctbal")


@query("""
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END IS NULL AS missing FROM events
    WHERE CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END IS NULL OR (CASE WHEN event_id % 2 = 0 THEN value END) IS NOT NULL""")
def filter_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.when(F.col("event_id") % 3 != 0, F.col("user_id"))
    value = F.when(F.col("event_id") % 2 == 0, F.col("value"))
    return table(spark, sf_dir, "events").filter(user.isNull() | value.isNotNull()).select("event_id", user.isNull().alias("missing"))


@query(r"""
    SELECT p_partkey, p_name FROM part
    WHERE p_name LIKE 's%' AND p_brand NOT LIKE '%#1_' AND p_name NOT LIKE '%\_%'""")
def filter_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").filter(p.like(F.col("p_name"), "s%") & ~p.like(F.col("p_brand"), "%#1_") & ~p.like(F.col("p_name"), r"%\_%"))
    return rows.select("p_partkey", "p_name")


@query("SELECT p_partkey FROM part WHERE p_brand || '_' || p_size LIKE 'Brand#1!_1%' ESCAPE '!'")
def filter_like_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat("p_brand", F.lit("_"), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").filter(p.like(label, "Brand#1!_1%", "!")).select("p_partkey")


@query("SELECT p_partkey, p_type FROM part WHERE p_type ILIKE 'econ%' AND p_name NOT ILIKE '%RING'")
def filter_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_type").ilike("econ%") & ~F.col("p_name").ilike("%RING")).select("p_partkey", "p_type")


@query("SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '#0+[1-3]5$') AND NOT regexp_matches(c_mktsegment, '(?i)^auto')")
def filter_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").filter(p.matches(F.col("c_name"), "#0+[1-3]5$") & ~p.matches(F.col("c_mktsegment"), "^auto", ignore_case=True))
    return rows.select("c_custkey", "c_name")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', 'a,b') AND o_custkey % 10 IN (o_orderkey % 10, 3)")
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(o.o_orderpriority.isin("1-URGENT", "5-LOW", "a,b") & (o.o_custkey % 10).isin(o.o_orderkey % 10, F.lit(3))).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def filter_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(~F.col("o_orderstatus").isin("F", "O")).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (1, NULL) OR c_nationkey IN (2, NULL)")
def filter_in_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter("c_nationkey NOT IN (1, NULL) OR c_nationkey IN (2, NULL)").select("c_custkey")


@query("SELECT p_partkey FROM part WHERE p_size > ANY (SELECT unnest([45, 40])) AND p_retailprice < ALL (SELECT unnest([950.0, 1000.0])) AND p_size <> ALL (SELECT unnest([47, 49]))")
def filter_any_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    rows = table(spark, sf_dir, "part").filter(p.any_of(size, ">", [45, 40]) & p.all_of(price, "<", [950.0, 1000.0]) & p.all_of(size, "<>", [47, 49]))
    return rows.select("p_partkey")


@query("""
    SELECT event_id FROM events
    WHERE (CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END) IS DISTINCT FROM 'click'
      AND (CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END) IS NOT DISTINCT FROM NULL""")
def filter_distinct_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.when(F.col("event_id") % 5 != 0, F.col("event_type")), F.when(F.col("event_id") % 7 != 0, F.col("user_id"))
    return table(spark, sf_dir, "events").filter(p.distinct_from(kind, F.lit("click")) & ~p.distinct_from(user, F.lit(None))).select("event_id")


@query("SELECT event_id FROM events WHERE (CASE WHEN event_id % 4 = 0 THEN NULL ELSE value > 50 END) IS TRUE")
def filter_is_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(p.is_true(F.when(F.col("event_id") % 4 != 0, F.col("value") > 50))).select("event_id")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 1000 AND 50000")
def param_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT o_orderkey, o_totalprice FROM {t} WHERE o_orderstatus = :status AND o_totalprice BETWEEN :low AND :high"
    return spark.sql(text, args={"status": "F", "low": 1000, "high": 50000}, t=table(spark, sf_dir, "orders"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_custkey = 7")
def param_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_for_parameters")
    return spark.sql("SELECT o_orderkey FROM orders_for_parameters WHERE o_orderdate >= CAST(? AS timestamp_ntz) AND o_custkey = ?", args=["1997-01-01", 7])


@query("SELECT n_nationkey, {'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey}.n_name AS whole_name FROM nation")
def whole_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", F.struct("*").alias("row")).select("n_nationkey", F.col("row.n_name").alias("whole_name"))


@query("SELECT 'nation.parquet' AS file, count(*) AS n FROM nation")
def scan_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System columns: the file that a row comes from."""
    return table(spark, sf_dir, "nation").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
