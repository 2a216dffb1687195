"""Predicates as PostgreSQL reads them, as Column expressions that Catalyst can push down."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, eq, ge, gt, le, lt, ne, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE: dict[str, Callable[[Any, Any], Any]] = {"=": eq, "<>": ne, "<": lt, "<=": le, ">": gt, ">=": ge}


def like(x: Column, pattern: str, escape: str | None = None) -> Column:
    """LIKE with no escape character unless one is given."""
    if escape is None:
        unused = next(c for c in "!~^\x01" if c not in pattern)
        return F.like(x, F.lit(pattern), F.lit(unused))
    return F.like(x, F.lit(pattern), F.lit(escape))


def matches(x: Column, pattern: str, ignore_case: bool = False) -> Column:
    """``~`` and ``~*``: the pattern is found anywhere."""
    return x.rlike(f"(?i){pattern}" if ignore_case else pattern)


def any_of(x: Column, op: str, values: Iterable[Any]) -> Column:
    """``x op ANY (values)``; equality becomes one IN, which is pushed to the scan."""
    values = list(values)
    if not values:
        return F.lit(False)
    if op == "=":
        return x.isin(values)
    return reduce(or_, (_COMPARE[op](x, v) for v in values))


def all_of(x: Column, op: str, values: Iterable[Any]) -> Column:
    """``x op ALL (values)``."""
    values = list(values)
    if not values:
        return F.lit(True)
    if op == "<>":
        return ~x.isin(values)
    return reduce(and_, (_COMPARE[op](x, v) for v in values))


def distinct_from(x: Column, y: Any) -> Column:
    return ~x.eqNullSafe(y)


def is_true(x: Column) -> Column:
    return x.eqNullSafe(F.lit(True))
