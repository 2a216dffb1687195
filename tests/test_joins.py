"""The joins beyond equality: against plain joins, and how many rows they make on the way."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import joins as op


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_equals_plain_join(spark, how):
    keys = [7] * 300 + [None] * 20 + list(range(2500))
    large = spark.createDataFrame([(k, k and k % 2, i) for i, k in enumerate(keys)], "k bigint, j bigint, i int")
    small = spark.createDataFrame([(k, k and k % 3, f"s{k}") for k in [7, 7, None, *range(0, 2600, 2)]], "k bigint, j bigint, _salt string")
    for on in (["k"], ["k", "j"]):
        a, b = (large, small) if len(on) == 2 else (large.drop("j"), small.drop("j"))
        got = op.salted(a, b, on, 4, how)
        assert got.columns == a.join(b, on, how).columns and rows(got) == rows(a.join(b, on, how))


def test_salted_repeats_rows_of_hot_keys_only(spark):
    large = spark.createDataFrame([(7,)] * 300 + [(k,) for k in range(2500)], "k bigint")
    small = spark.range(2500).select(F.col("id").alias("k"))
    plan = op.salted(large, small, ["k"], 8)
    assert len(plan.collect()) == 2800
    made = [n.metrics().apply("numOutputRows").value() for n in nodes(plan._jdf.queryExecution().executedPlan()) if n.nodeName() == "Generate"]
    assert made == [2507]


def nodes(plan):
    """The nodes of an executed plan, those inside stages and broadcasts too."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from nodes(plan.executedPlan())
    elif plan.nodeName().endswith("QueryStage"):
        yield from nodes(plan.plan())
    else:
        yield plan
        for k in range(plan.children().size()):
            yield from nodes(plan.children().apply(k))


def in_ranges_tables(spark):
    points = spark.createDataFrame([(i, float(i % 97)) for i in range(600)] + [(-1, None), (-2, 1e6), (-3, -1e6)], "`p.id` bigint, v double")
    ranges = [(i, float(i % 5) * 10, float(i % 5) * 10 + 7) for i in range(1200)] + [(-1, None, 5.0), (-2, 5.0, 5.0), (-3, 9.0, 2.0), (-4, 3.0, 45.5)]
    return points, spark.createDataFrame(ranges, "r bigint, low double, high double")


@pytest.mark.parametrize("run, block", [(op.RUN, op.BLOCK), (7, 3)])
def test_in_ranges_equals_plain_join(spark, monkeypatch, run, block):
    monkeypatch.setattr(op, "RUN", run)
    monkeypatch.setattr(op, "BLOCK", block)
    points, ranges = in_ranges_tables(spark)
    got = op.in_ranges(points, "v", ranges, "low", "high", 10.0)
    want = points.join(ranges, (F.col("v") >= F.col("low")) & (F.col("v") < F.col("high")))
    assert got.columns == want.columns and rows(got) == rows(want)


def test_pairs_of_equal_ranges_are_small_when_written(spark, tmp_path):
    points = spark.range(3000).select(F.col("id").alias("p"), (F.col("id") % 10).cast("double").alias("v"))
    ranges = spark.range(2000).select(F.col("id").alias("r"), (F.col("id") % 7).cast("double").alias("low"), (F.col("id") % 7 + 3).cast("double").alias("high"))
    found = op.in_ranges(points, "v", ranges, "low", "high", 3.0).select("p", "r")
    found.write.parquet(f"{tmp_path}/out")
    assert found.count() > 1_500_000 and sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 900_000
