"""Grouping and aggregate functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import aggregates as agg
from tessera.plans.catalog import query
from tessera.session import table


@query("""
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
           round(avg(l_extendedprice), 4) AS avg_price, count(*) AS n_rows
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-01'
    GROUP BY l_returnflag, l_linestatus""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_shipdate") <= F.expr("timestamp_ntz'1998-09-01'"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query("""
    SELECT l_returnflag, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-01' GROUP BY l_returnflag""")
def discount_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.expr("timestamp_ntz'1998-09-01'")).groupBy("l_returnflag")
    return rows.agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("count_order"))


@query("SELECT count(*) AS n, count(l_tax) AS n_tax, round(sum(l_extendedprice), 2) AS total, round(avg(l_discount), 6) AS mean, min(l_shipdate) AS first_day, max(l_quantity) AS most FROM lineitem")
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("l_tax").alias("n_tax"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_discount"), 6).alias("mean"),
        F.min("l_shipdate").alias("first_day"),
        F.max("l_quantity").alias("most"),
    )


@query("SELECT year(o_orderdate)::INTEGER AS y, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2")
def agg_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
    SELECT event_type, round(stddev(value), 6) AS sd, round(stddev_pop(value), 6) AS sd_pop, round(stddev_samp(value), 6) AS sd_samp,
           round(variance(value), 4) AS var, round(var_pop(value), 4) AS var_p, round(var_samp(value), 4) AS var_s FROM events GROUP BY event_type""")
def agg_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lambda f, d, n: F.round(f("value"), d).alias(n)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        r(F.stddev, 6, "sd"), r(F.stddev_pop, 6, "sd_pop"), r(F.stddev_samp, 6, "sd_samp"), r(F.variance, 4, "var"), r(F.var_pop, 4, "var_p"), r(F.var_samp, 4, "var_s")
    )


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, sum(DISTINCT l_linenumber)::BIGINT AS lines, count(DISTINCT (l_returnflag, l_linestatus)) AS pairs FROM lineitem GROUP BY l_returnflag")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.sum_distinct("l_linenumber").alias("lines"),
        F.count_distinct(F.struct("l_returnflag", "l_linestatus")).alias("pairs"),
    )


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS filled, round(sum(o_totalprice) FILTER (WHERE o_totalprice > 100000), 2) AS large FROM orders GROUP BY o_orderpriority")
def agg_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.round(agg.where("sum(o_totalprice)", "o_totalprice > 100000"), 2)
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(agg.where("count(*)", "o_orderstatus = 'F'").alias("filled"), large.alias("large"))


@query("SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey HAVING count(*) > 12 AND avg(o_totalprice) > 200000")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"), F.avg("o_totalprice").alias("mean"))
    return grouped.filter("n > 12 AND mean > 200000").select("o_custkey", "n", F.round("total", 2).alias("total"))


@query("""
    WITH c AS (SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, min(l_linenumber) AS usual FROM c WHERE n = (SELECT max(n) FROM c AS o WHERE o.l_returnflag = c.l_returnflag) GROUP BY l_returnflag""")
def agg_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(agg.mode("l_linenumber").alias("usual"))


@query("SELECT event_type, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY value), 6) AS q1, percentile_disc(0.5) WITHIN GROUP (ORDER BY value) AS middle, percentile_disc(0.9) WITHIN GROUP (ORDER BY user_id)::BIGINT AS late_user FROM events GROUP BY event_type")
def agg_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.round(agg.percentile_cont("value", 0.25), 6).alias("q1"),
        agg.percentile_disc("value", 0.5).alias("middle"),
        agg.percentile_disc("user_id", 0.9).cast("bigint").alias("late_user"),
    )


@query("SELECT n_regionkey, array_to_string(list_sort(array_agg(n_nationkey)), ',') AS nations, len(array_agg(CASE WHEN n_nationkey % 2 = 0 THEN n_name END)) AS kept FROM nation GROUP BY n_regionkey")
def agg_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name"))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(
        F.array_join(F.array_sort(agg.array_agg("n_nationkey")).cast("array<string>"), ",").alias("nations"),
        F.size(agg.array_agg(even)).cast("bigint").alias("kept"),
    )


@query("""
    SELECT c_nationkey, array_to_string(array_agg(c_custkey ORDER BY c_acctbal DESC, c_custkey), ',') AS richest_first,
           string_agg(c_mktsegment, ';' ORDER BY c_mktsegment) AS segments, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS kinds FROM customer GROUP BY c_nationkey""")
def agg_array_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.array_join(agg.array_agg("c_custkey", "c_acctbal", descending=True).cast("array<string>"), ",").alias("richest_first"),
        agg.string_agg("c_mktsegment", ";").alias("segments"),
        agg.string_agg("c_mktsegment", ";", distinct=True).alias("kinds"),
    )


@query("""
    SELECT n_name, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM nation JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY n_name""")
def agg_over_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, c, o = (table(spark, sf_dir, t) for t in ("nation", "customer", "orders"))
    joined = o.filter("o_orderstatus = 'F'").join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderpriority)::BIGINT AS rolled FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def agg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderpriority").cast("bigint").alias("rolled"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linenumber), ())")
def agg_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    sets = [[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_linenumber")], []]
    return rows.groupingSets(sets, "l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, bool_and(value > 0) AS all_above, bool_or(value > 99.9) AS any_high, round(corr(value, user_id), 6) AS r, round(regr_slope(value, user_id), 8) AS slope FROM events GROUP BY event_type")
def agg_bool_regr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.bool_and(F.col("value") > 0).alias("all_above"),
        F.bool_or(F.col("value") > 99.9).alias("any_high"),
        F.round(F.corr("value", "user_id"), 6).alias("r"),
        F.round(F.regr_slope("value", "user_id"), 8).alias("slope"),
    )


@query("SELECT n_regionkey, '[' || string_agg('{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\"}', ',' ORDER BY n_nationkey) || ']' AS rows FROM nation GROUP BY n_regionkey")
def agg_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(agg.json_agg("n_nationkey", "n_name").alias("rows"))


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def agg_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users in two steps: the first spreads each event type over its users, so no hot type meets in one task."""
    pairs = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("event_type").agg(F.count("user_id").alias("users"))


@query()
def agg_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: sketches for counts of distinct values and quantiles."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("median"))
