"""Aggregates with PostgreSQL's results: ordered, null-keeping, filtered, ordered-set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.sqlsafe import quote_text


def array_agg(x: str | Column, order_by: str | Column | None = None, descending: bool = False) -> Column:
    """All values, nulls too; ordered by ``order_by`` (nulls last either way), ties by the value."""
    value = F.col(x) if isinstance(x, str) else x
    if order_by is None:
        return F.collect_list(F.struct(value.alias("v"))).getField("v")
    key = F.col(order_by) if isinstance(order_by, str) else order_by
    rows = F.collect_list(F.struct(key.alias("k"), value.alias("v")))

    def compare(a: Column, b: Column) -> Column:
        x, y = a.getField("k"), b.getField("k")
        up, down = (F.lit(1), F.lit(-1)) if descending else (F.lit(-1), F.lit(1))
        by_value = F.when(a.getField("v") < b.getField("v"), -1).when(a.getField("v") > b.getField("v"), 1).otherwise(0)
        return F.when(x.isNull() & y.isNull(), by_value).when(x.isNull(), 1).when(y.isNull(), -1).when(x < y, up).when(x > y, down).otherwise(by_value)

    return F.array_sort(rows, compare).getField("v")


def string_agg(x: str, separator: str, distinct: bool = False) -> Column:
    """The values in their own order, joined. A group's values are one text, so they must fit a task."""
    return F.expr(f"listagg({'DISTINCT ' if distinct else ''}{x}, {quote_text(separator)}) WITHIN GROUP (ORDER BY {x})")


def mode(x: str, descending: bool = False) -> Column:
    """The most frequent value; of ties the first in the order."""
    return F.expr(f"mode() WITHIN GROUP (ORDER BY {x}{' DESC' if descending else ''})")


def percentile_cont(x: str, fraction: float) -> Column:
    return F.expr(f"percentile_cont({fraction}) WITHIN GROUP (ORDER BY {x})")


def percentile_disc(x: str, fraction: float) -> Column:
    return F.expr(f"percentile_disc({fraction}) WITHIN GROUP (ORDER BY {x})")


def where(aggregate: str, condition: str) -> Column:
    """agg(x) FILTER (WHERE condition)."""
    return F.expr(f"{aggregate} FILTER (WHERE {condition})")


def json_agg(*columns: str) -> Column:
    """The rows as a JSON array of objects, in the order of the columns."""
    return F.to_json(F.sort_array(F.collect_list(F.struct(*columns))))
