"""Writes and what is read back after them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.catalog import query
from tessera.registry import Registry
from tessera.session import table
from tessera.sources.relation import read_csv
from tessera.sources.writer import copy_to_parquet, create_table_as


def shared_folder(spark: SparkSession) -> str:
    """A new path that driver and executors share: in the checkpoint folder if the session names one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tessera-")
    return f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey + 1000000000, o_custkey, NULL FROM orders WHERE o_orderstatus = 'F'")
def insert_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = Registry(spark)
    registry.create_server("insert_roundtrip", database=shared_folder(spark))
    registry.execute("insert_roundtrip", "CREATE TABLE target (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE) USING parquet")
    registry.create_table("insert_target", "insert_roundtrip", {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_totalprice": "DOUBLE"}, table="target")
    orders = table(spark, sf_dir, "orders")
    registry.insert("insert_target", orders.select("o_totalprice", "o_custkey", "o_orderkey"))
    registry.insert("insert_target", orders.filter("o_orderstatus = 'F'").select((F.col("o_orderkey") + 1000000000).alias("o_orderkey"), "o_custkey"))
    return registry.table("insert_target")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def create_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = Registry(spark)
    server = registry.create_server("ctas_roundtrip", database=shared_folder(spark))
    create_table_as((server.database, "copied"), table(spark, sf_dir, "orders"))
    return registry.execute("ctas_roundtrip", "SELECT o_orderstatus, count(*) AS n FROM copied GROUP BY o_orderstatus")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey < 5")
def copy_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}.parquet"
    copy_to_parquet(table(spark, sf_dir, "customer"), path, "c_nationkey")
    rows = spark.read.parquet(path).filter("c_nationkey < 5")  # prunes partitions
    return rows.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}.csv"
    table(spark, sf_dir, "nation").write.option("header", "true").csv(path)
    return read_csv(spark, path)


@query("SELECT count(*) AS n_rows, count(DISTINCT r_regionkey) AS n_regions FROM nation JOIN region ON n_regionkey = r_regionkey")
def import_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = Registry(spark)
    registry.create_server("imported")
    registry.import_schema("imported", sf_dir, only={"nation", "region"})
    return registry.query("SELECT count(*) AS n_rows, count(DISTINCT r_regionkey) AS n_regions FROM nation JOIN region ON n_regionkey = r_regionkey")
