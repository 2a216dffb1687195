"""Joins beyond equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Equal ranges of one run of so many rows are put together, in blocks of at most so many.
RUN, BLOCK = 1 << 18, 512


def in_ranges(points: DataFrame, value: str, ranges: DataFrame, low: str, high: str, width: float) -> DataFrame:
    """Inner join on ``low <= value < high`` by buckets of ``width``.

    A range is dealt out to each bucket it meets, a point to its own, so the join is an equality
    with the bounds checked after it: it shuffles both sides once instead of comparing all pairs.
    Null and empty ranges match nothing. ``width`` should be about the usual length of a range.

    Equal ranges go through the join as blocks and come apart after it, block by block over the points of
    their bucket, so that a result with many pairs repeats itself and is small when written; points
    outside all ranges are not shuffled.
    """
    bucket = lambda x: F.floor(x / F.lit(width)).cast("bigint")
    names = ("_bucket", "_low", "_high", "_run", "_block", "_least", "_most")
    name, lo, hi, run, block, least, most = (free_name(n, points, ranges) for n in names)
    real = ranges.filter(F.col(low) < F.col(high))
    rows = real.select(F.col(low).alias(lo), F.col(high).alias(hi), F.floor(F.monotonically_increasing_id() / RUN).alias(run), F.struct(*map(quoted, ranges.columns)).alias(block))
    held = rows.groupBy(lo, hi, run).agg(F.collect_list(block).alias(block))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(block) - 1) / BLOCK).cast("int")), lambda k: F.slice(block, k * BLOCK + 1, BLOCK))
    held = held.select(lo, hi, F.explode(cut).alias(block))
    dealt = held.withColumn(name, F.explode(F.sequence(bucket(F.col(lo)), bucket(F.col(hi)))))
    # the blocks' side is hinted to be the one that streams past the points of a bucket
    bounds = F.broadcast(real.agg(F.min(low).alias(least), F.max(high).alias(most)))
    near = points.crossJoin(bounds).filter((F.col(value) >= F.col(least)) & (F.col(value) < F.col(most))).drop(least, most)
    met = dealt.hint("merge").join(near.withColumn(name, bucket(F.col(value))), name).filter((F.col(value) >= F.col(lo)) & (F.col(value) < F.col(hi)))
    own = [quoted(c) for c in points.columns]
    return met.select(*own, F.explode(block).alias(block)).select(*own, *(F.col(block).getField(c).alias(c) for c in ranges.columns))


def quoted(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, with as many underscores before it as none of the tables has a column of that name."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name in taken:
        name = f"_{name}"
    return name


#: A key is hot if it holds more than one row in so many: there are fewer hot keys than that, whatever the table.
HOT_SHARE = 1000


def salted(large: DataFrame, small: DataFrame, keys: list[str], salts: int, how: str = "inner") -> DataFrame:
    """Equality join whose hot keys are dealt to ``salts`` tasks: the small side's rows of these keys are repeated for each.

    Rows of all other keys are joined as they are, so the small side stays as large as it is. ``large``
    is the side kept by ``how`` (inner, left, left_semi or left_anti), and is read once more to count keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how!r} would repeat rows of the small side")
    name, mark, total = (free_name(n, large, small) for n in ("_salt", "_hot", "_total"))
    counted = large.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias(mark))
    rows = counted.agg(F.sum(mark).alias(total))
    hot = F.broadcast(counted.crossJoin(F.broadcast(rows)).filter(F.col(mark) * HOT_SHARE > F.col(total)).select(*keys, F.lit(True).alias(mark)))
    # by the row's place in its partition, so that equal rows are dealt out too; a task that is run again may deal otherwise, with the same result
    place = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    # null keys match nothing, and are dealt out too where they stay
    spread = F.col(mark) | F.greatest(F.lit(False), *(F.col(k).isNull() for k in keys))
    dealt = large.withColumn(name, place).join(hot, keys, "left").withColumn(name, F.when(spread, F.col(name)).otherwise(0)).drop(mark)
    salts_of = F.when(F.col(mark), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = small.join(hot, keys, "left").withColumn(name, F.explode(salts_of)).drop(mark)
    return dealt.join(repeated, [*keys, name], how).drop(name)
