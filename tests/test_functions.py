"""Function and predicate helpers on edge cases; joins against brute force; streams."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions import aggregates as agg
from tessera.functions import scalar as fn
from tessera.operators import joins, predicates
from tessera.streaming import windows


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("make", "want"),
    [
        (lambda: fn.log(F.lit(100.0)), 2.0), (lambda: fn.ln(F.lit(0.0)), None), (lambda: fn.trunc(F.lit(-1.7)), -1.0), (lambda: fn.trunc(F.lit(1.279), 2), 1.27),
        (lambda: fn.floor(F.lit(-0.5)), -1.0), (lambda: fn.ceil(F.lit(1.2)), 2.0), (lambda: fn.sign(F.lit(-3)), -1.0), (lambda: fn.mod(F.lit(-7), 3), -1), (lambda: fn.mod(F.lit(7), 0), None),
        (lambda: fn.divide(F.lit(1), 0), None), (lambda: fn.divide(F.lit(7), 2), 3.5), (lambda: fn.to_int(F.lit(2.5)), 2), (lambda: fn.to_int(F.lit(3.5)), 4), (lambda: fn.to_int(F.lit(-2.7)), -3),
        (lambda: fn.floor(F.lit(1e19)), 1e19), (lambda: fn.ceil(F.lit(-1e19)), -1e19), (lambda: fn.trunc(F.lit(1e19)), 1e19), (lambda: fn.trunc(F.lit(1.15), 2), 1.15), (lambda: fn.trunc(F.lit(-1.159), 2), -1.15), (lambda: fn.trunc(F.lit(1279.0), -2), 1200.0),
        (lambda: fn.to_int(F.lit(2**53 + 1), "bigint"), 2**53 + 1), (lambda: fn.to_int(F.lit(0.5).cast("decimal(3,1)")), 0), (lambda: fn.epoch(F.lit("1970-01-02 00:00:01").cast("timestamp_ntz")), 86401),
        (lambda: fn.substr(F.lit("hello"), 0, 2), "h"), (lambda: fn.substr(F.lit("hello"), -1, 4), "he"), (lambda: fn.substr(F.lit("hello"), 2), "ello"), (lambda: fn.substr(F.lit("hello"), -5, 2), ""),
        (lambda: fn.ltrim(F.lit("xxaxx"), "x"), "axx"), (lambda: fn.rtrim(F.lit("xxaxx"), "x"), "xxa"), (lambda: fn.btrim(F.lit("  a ")), "a"), (lambda: fn.length(F.lit("é😀")), 2),
        (lambda: fn.date_plus(F.lit("2025-01-01"), 31), datetime.date(2025, 2, 1)), (lambda: fn.l2_distance(F.array(F.lit(0), F.lit(3)), F.array(F.lit(4), F.lit(0))), 5.0),
        (lambda: fn.cosine_distance(F.array(F.lit(0.0)), F.array(F.lit(1.0))), None), (lambda: fn.log(F.lit(8.0), 2), 3.0),
        (lambda: predicates.like(F.lit("a_b"), r"a\_b"), False), (lambda: predicates.like(F.lit("a\\_b"), r"a\_b"), True), (lambda: predicates.like(F.lit("a_b"), "a!_b", "!"), True),
        (lambda: predicates.any_of(F.lit(3), ">", [5, 2]), True), (lambda: predicates.any_of(F.lit(3), "=", []), False), (lambda: predicates.all_of(F.lit(3), ">", []), True), (lambda: predicates.all_of(F.lit(3), "<>", [3]), False),
        (lambda: predicates.distinct_from(F.lit(None).cast("int"), F.lit(None)), False), (lambda: predicates.is_true(F.lit(None).cast("boolean")), False), (lambda: predicates.matches(F.lit("xABC"), "b", ignore_case=True), True),
    ],
)
def test_scalars(spark, make, want):
    got = value(spark, make())
    assert got == pytest.approx(want) if isinstance(want, float) else got == want


def test_negative_length_is_an_error():
    with pytest.raises(ValueError):
        fn.substr(F.lit("x"), 1, -1)


def test_aggregates_keep_nulls_and_order(spark):
    rows = spark.createDataFrame([(1, "b"), (2, None), (None, "a"), (2, "c"), (2, "c")], "k int, s string")
    r = rows.agg(
        agg.array_agg("s").alias("plain"), agg.array_agg("s", "k").alias("up"), agg.array_agg("s", "k", descending=True).alias("down"), agg.mode("k").alias("mode"), agg.mode("s", descending=True).alias("smode"),
        agg.string_agg("s", "+").alias("joined"), agg.string_agg("s", "+", distinct=True).alias("once"), agg.string_agg("s", "'", distinct=True).alias("quoted"), agg.percentile_disc("k", 0.5).cast("int").alias("p"), agg.where("count(*)", "k = 2").alias("twos"), agg.json_agg("k").alias("js"),
    ).first()
    assert sorted(map(str, r.plain)) == ["None", "a", "b", "c", "c"]
    assert r.up[0] == "b" and r.up[-1] == "a" and len(r.up) == 5 and r.down[-1] == "a" and r.down[-2] == "b"
    assert r.quoted == "a'b'c"
    assert (r.mode, r.smode, r.joined, r.once, r.p, r.twos) == (2, "c", "a+b+c+c", "a+b+c", 2, 3)


def test_range_join_equals_brute_force(spark):
    rng = random.Random(1)
    points = [(i, rng.uniform(-20, 120)) for i in range(300)] + [(900, None), (901, 10.0)]
    ranges = [(i, a := rng.uniform(-10, 100), a + rng.choice([0.0, 0.5, 3.0, 40.0])) for i in range(60)] + [(99, None, 5.0), (98, 9.0, 8.0), (97, 10.0, 10.5)]
    p = spark.createDataFrame(points, "pid int, x double")
    r = spark.createDataFrame(ranges, "rid int, low double, high double")
    want = {(i, j) for i, x in points for j, a, b in ranges if x is not None and a is not None and a <= x < b}
    for width in (0.7, 5.0, 1000.0):
        got = [(t.pid, t.rid) for t in joins.in_ranges(p, "x", r, "low", "high", width).collect()]
        assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    large = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(500)] + [(None, -1)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (6, "c"), (7000, "d"), (None, "e")], "k int, w string")
    assert sorted(map(str, joins.salted(large, small, ["k"], 5, how).collect())) == sorted(map(str, large.join(small, ["k"], how).collect()))


def test_joins_keep_columns_of_their_own_names(spark):
    large = spark.createDataFrame([(1, 2, 3)], "k int, _salt int, _bucket int")
    small = spark.createDataFrame([(1, "a", 0.0, 5.0)], "k int, w string, low double, high double")
    assert [tuple(r) for r in joins.salted(large, small.select("k", "w"), ["k"], 3).collect()] == [(1, 2, 3, "a")]
    assert joins.in_ranges(large, "_bucket", small.drop("k"), "low", "high", 2.0).columns == ["k", "_salt", "_bucket", "w", "low", "high"]


def test_salted_full_join_is_refused(spark):
    with pytest.raises(ValueError):
        joins.salted(spark.range(1), spark.range(1), ["id"], 2, "full")


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    rows = spark.read.schema(windows.EVENTS).parquet("/root/testdata/sf0.001/events.parquet")
    for k in range(3):  # in order of time, so nothing is late
        rows.filter(f"event_id >= {k * 334} AND event_id < {(k + 1) * 334}").coalesce(1).write.mode("append").parquet(str(source))
    events = windows.first_seen(windows.read_events(spark, str(source)))
    counts = windows.tumbling_counts(windows.read_events(spark, str(source)), late="400 days")
    for name, stream in (("events", events), ("counts", counts)):
        windows.append_to(stream, str(tmp_path / name), str(tmp_path / f"{name}-cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "events")).select("event_id").distinct().count() == 1000
    assert windows.sessions(windows.read_events(spark, str(source))).isStreaming
    whole = windows.tumbling_counts(rows.withColumn("ts", F.col("ts").cast("timestamp")))
    want = duckdb.execute("SELECT count(*) FROM (SELECT DISTINCT time_bucket(INTERVAL '1 hour', ts), event_type FROM read_parquet('/root/testdata/sf0.001/events.parquet'))").fetchone()[0]
    assert whole.count() == want
