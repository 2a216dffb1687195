"""Conditional expressions and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalar as fn
from tessera.plans.catalog import query
from tessera.session import table


@query("""
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
           CASE WHEN p_retailprice > 1000 THEN p_size END AS dear_size FROM part""")
def case_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large")
    return table(spark, sf_dir, "part").select("p_partkey", size.alias("size_class"), F.when(F.col("p_retailprice") > 1000, F.col("p_size")).alias("dear_size"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS code FROM orders")
def case_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS code")


@query("""
    SELECT event_id, coalesce(nullif(event_type, 'click'), 'none') AS kind, nullif(user_id, 8) AS user_not_8,
           coalesce(nullif(user_id, 8), nullif(event_id, 3), -1) AS first_known FROM events""")
def coalesce_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.nullif("user_id", F.lit(8))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.coalesce(F.nullif("event_type", F.lit("click")), F.lit("none")).alias("kind"),
        user.alias("user_not_8"),
        F.coalesce(user, F.nullif("event_id", F.lit(3)), F.lit(-1)).alias("first_known"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, greatest(l_discount, l_tax, 0.04) AS most,
           least(l_quantity, CASE WHEN l_linenumber = 1 THEN NULL ELSE 10.0 END) AS fewest FROM lineitem""")
def greatest_least(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.greatest("l_discount", "l_tax", F.lit(0.04)).alias("most"),
        F.least("l_quantity", F.when(F.col("l_linenumber") != 1, 10.0)).alias("fewest"),
    )


@query("""
    SELECT c_custkey, abs(c_acctbal) AS f_abs, floor(c_acctbal) AS f_floor, ceil(c_acctbal) AS f_ceil, round(c_acctbal, 1) AS f_round,
           trunc(c_acctbal) AS f_trunc, round(sqrt(abs(c_acctbal)), 6) AS f_sqrt, round(power(c_nationkey, 2.5), 4) AS f_power,
           c_custkey % 7 AS f_mod, sign(c_acctbal)::DOUBLE AS f_sign, round(exp(c_nationkey / 10.0), 6) AS f_exp,
           CASE WHEN c_acctbal > 0 THEN round(ln(c_acctbal), 6) END AS f_ln, CASE WHEN c_acctbal > 0 THEN round(log10(c_acctbal), 6) END AS f_log,
           -c_nationkey AS f_minus, round(c_acctbal / nullif(c_nationkey, 0), 6) AS f_divide
    FROM customer""")
def fn_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.abs("c_acctbal").alias("f_abs"),
        fn.floor("c_acctbal").alias("f_floor"),
        fn.ceil("c_acctbal").alias("f_ceil"),
        F.round("c_acctbal", 1).alias("f_round"),
        fn.trunc("c_acctbal").alias("f_trunc"),
        F.round(F.sqrt(F.abs("c_acctbal")), 6).alias("f_sqrt"),
        F.round(fn.power("c_nationkey", 2.5), 4).alias("f_power"),
        fn.mod("c_custkey", 7).alias("f_mod"),
        fn.sign("c_acctbal").alias("f_sign"),
        F.round(F.exp(F.col("c_nationkey") / 10.0), 6).alias("f_exp"),
        F.round(fn.ln("c_acctbal"), 6).alias("f_ln"),
        F.round(fn.log("c_acctbal"), 6).alias("f_log"),
        (-F.col("c_nationkey")).alias("f_minus"),
        F.round(fn.divide("c_acctbal", "c_nationkey"), 6).alias("f_divide"),
    )


@query("""
    SELECT p_partkey, length(p_name) AS n, upper(p_name) AS up, lower(p_brand) AS low, replace(p_name, ' ', '_') AS joined,
           substr(p_name, 3) AS rest, substr(p_name, 2, 4) AS middle, substr(p_name, 0, 3) AS early, trim('  ' || p_name || ' ') AS trimmed,
           ltrim(p_brand, 'Bra') AS lefted, rtrim(p_type, 'YM') AS righted, trim(p_brand, 'B#0123456789') AS both,
           p_brand || '/' || p_type AS joint
    FROM part""")
def fn_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        fn.length("p_name").alias("n"),
        F.upper("p_name").alias("up"),
        F.lower("p_brand").alias("low"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("joined"),
        fn.substr("p_name", 3).alias("rest"),
        fn.substr("p_name", 2, 4).alias("middle"),
        fn.substr("p_name", 0, 3).alias("early"),
        fn.btrim(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("trimmed"),
        fn.ltrim("p_brand", "Bra").alias("lefted"),
        fn.rtrim("p_type", "YM").alias("righted"),
        fn.btrim("p_brand", "B#0123456789").alias("both"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joint"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity::INTEGER AS i4, (l_extendedprice / 2)::BIGINT AS i8, l_quantity::FLOAT AS f4,
           l_linenumber::DOUBLE AS f8, l_linenumber::VARCHAR AS as_text, l_shipdate::DATE AS as_date, CAST(l_discount AS DECIMAL(10, 2))::DOUBLE AS as_numeric,
           CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS as_ts
    FROM lineitem""")
def fn_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.to_int("l_quantity").alias("i4"),
        fn.to_int(F.col("l_extendedprice") / 2, "bigint").alias("i8"),
        F.col("l_quantity").cast("float").alias("f4"),
        F.col("l_linenumber").cast("double").alias("f8"),
        F.col("l_linenumber").cast("string").alias("as_text"),
        F.col("l_shipdate").cast("date").alias("as_date"),
        F.col("l_discount").cast("decimal(10,2)").cast("double").alias("as_numeric"),
        F.col("l_shipdate").cast("date").cast("timestamp_ntz").alias("as_ts"),
    )


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(o_custkey % 30 AS INTEGER) AS due, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age,
           year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m, day(o_orderdate)::INTEGER AS d,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, epoch(o_orderdate)::BIGINT AS seconds
    FROM orders""")
def fn_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.date_plus("o_orderdate", F.col("o_custkey") % 30).alias("due"),
        fn.days_between("o_orderdate", F.lit("1995-01-01").cast("date")).alias("age"),
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        F.day("o_orderdate").alias("d"),
        F.trunc("o_orderdate", "month").alias("month_start"),
        fn.epoch("o_orderdate").alias("seconds"),
    )


@query("""
    SELECT n_nationkey, array_to_string([n_name, 'x', CAST(n_regionkey AS VARCHAR)], '|') AS joined, len([n_nationkey, n_regionkey, 7]) AS n,
           [n_nationkey, n_regionkey, 7][2] AS second, list_contains([n_nationkey, n_regionkey], 3) AS has_3,
           list_sum(list_transform([n_nationkey, n_regionkey, 7], lambda x: x * 2))::BIGINT AS total
    FROM nation""")
def fn_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    three = F.array("n_nationkey", "n_regionkey", F.lit(7))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.array_join(F.array("n_name", F.lit("x"), F.col("n_regionkey").cast("string")), "|").alias("joined"),
        F.size(three).cast("bigint").alias("n"),
        F.element_at(three, 2).alias("second"),
        F.array_contains(F.array("n_nationkey", "n_regionkey"), 3).alias("has_3"),
        F.aggregate(three, F.lit(0).cast("bigint"), lambda a, x: a + x * 2).alias("total"),
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def fn_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.get_json_object("props", "$.missing").alias("missing")
    )


@query("""
    SELECT a.vec_id, round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS l2,
           round(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS ip,
           round(1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine
    FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 0) b""")
def vector_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    probe = rows.filter("vec_id = 0").select(F.col("embedding").alias("probe"))  # one row
    return rows.crossJoin(F.broadcast(probe)).select(
        "vec_id",
        F.round(fn.l2_distance("embedding", "probe"), 6).alias("l2"),
        F.round(fn.inner_product("embedding", "probe"), 6).alias("ip"),
        F.round(fn.cosine_distance("embedding", "probe"), 6).alias("cosine"),
    )


@query()
def fn_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", F.rand().alias("r"))
