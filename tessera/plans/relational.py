"""Windows, sorting, limits, set operations and subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.catalog import query
from tessera.session import table


@query("SELECT DISTINCT l_shipdate, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_shipdate", "l_linestatus").distinct()


@query("""
    SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rk,
           dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS dr, ntile(3) OVER w AS third,
           round(percent_rank() OVER w, 6) AS pr FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)""")
def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    p = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    big = lambda c: c.cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        big(F.row_number().over(w)).alias("rn"),
        big(F.rank().over(p)).alias("rk"),
        big(F.dense_rank().over(p)).alias("dr"),
        big(F.ntile(3).over(w)).alias("third"),
        F.round(F.percent_rank().over(w), 6).alias("pr"),
    )


@query("""
    SELECT event_id, lag(value) OVER w AS before, lead(value, 2, -1.0) OVER w AS after, first_value(event_type) OVER w AS first_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def window_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.lag("value").over(w).alias("before"), F.lead("value", 2, -1.0).over(w).alias("after"), F.first("event_type").over(w).alias("first_type")
    )


@query("""
    SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS last_three,
           count(*) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 500 PRECEDING AND 500 FOLLOWING) AS close_by,
           round(avg(value) OVER (PARTITION BY event_type), 6) AS type_mean FROM events""")
def window_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    # the mean of a type by aggregation and join: a window would put each type into one task
    means = rows.groupBy(F.col("event_type").alias("of_type")).agg(F.round(F.avg("value"), 6).alias("type_mean"))
    by_user = Window.partitionBy("user_id")
    framed = rows.select(
        "event_id",
        "event_type",
        F.round(F.sum("value").over(by_user.orderBy("ts", "event_id").rowsBetween(-2, 0)), 4).alias("last_three"),
        F.count(F.lit(1)).over(by_user.orderBy("event_id").rangeBetween(-500, 500)).alias("close_by"),
    )
    return framed.join(means, F.col("event_type").eqNullSafe(F.col("of_type"))).select("event_id", "last_three", "close_by", "type_mean")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50")
def order_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(50)


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS v FROM events ORDER BY v NULLS FIRST, event_id LIMIT 200")
def order_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("v")
    return table(spark, sf_dir, "events").select("event_id", v).orderBy(F.asc_nulls_first("v"), "event_id").limit(200)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20 OFFSET 30")
def offset_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey").offset(30).limit(20)


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2")
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("n", F.row_number().over(w)).filter("n <= 2").select("o_custkey", "o_orderkey")


@query("SELECT s_nationkey AS nation FROM supplier UNION ALL SELECT c_nationkey FROM customer")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")).union(table(spark, sf_dir, "customer").select("c_nationkey"))


@query("SELECT s_nationkey AS nation FROM supplier UNION SELECT c_nationkey FROM customer")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(spark, sf_dir).distinct()


@query("SELECT s_nationkey AS nation FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 0")
def intersect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")).intersect(table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_nationkey"))


@query("SELECT n_nationkey AS nation FROM nation EXCEPT SELECT s_nationkey FROM supplier")
def except_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation")).subtract(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def except_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).exceptAll(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT n_name FROM nation WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000)")
def subquery_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT n_name FROM {n} n WHERE EXISTS (SELECT 1 FROM {s} s WHERE s_nationkey = n_nationkey AND s_acctbal > 5000)"
    return spark.sql(text, n=table(spark, sf_dir, "nation"), s=table(spark, sf_dir, "supplier"))


@query("SELECT o_orderkey FROM orders o WHERE o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)")
def subquery_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    text = "SELECT o_orderkey FROM {a} o WHERE o_totalprice > 1.5 * (SELECT avg(o_totalprice) FROM {b} i WHERE i.o_custkey = o.o_custkey)"
    return spark.sql(text, a=o, b=o)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 11 AND p_type = 'ECONOMY')")
def subquery_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT l_orderkey, l_linenumber FROM {l} WHERE l_partkey IN (SELECT p_partkey FROM {p} WHERE p_size = 11 AND p_type = 'ECONOMY')"
    return spark.sql(text, l=table(spark, sf_dir, "lineitem"), p=table(spark, sf_dir, "part"))


@query("""
    WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey),
         high AS (SELECT * FROM spent WHERE total > (SELECT avg(total) FROM spent))
    SELECT c_mktsegment, count(*) AS n, round(sum(total), 2) AS total FROM high JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""")
def cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS total FROM {o} GROUP BY o_custkey),
             high AS (SELECT * FROM spent WHERE total > (SELECT avg(total) FROM spent))
        SELECT c_mktsegment, count(*) AS n, round(sum(total), 2) AS total FROM high JOIN {c} c ON c_custkey = o_custkey GROUP BY c_mktsegment"""
    return spark.sql(text, o=table(spark, sf_dir, "orders"), c=table(spark, sf_dir, "customer"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def batch_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: tumbling windows over a batch; ``tessera.streaming`` has the same over a stream."""
    grouped = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
