"""Scalar functions with PostgreSQL's arguments and results, as expressions of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Arg = Column | str | int | float


def _col(x: Arg) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


#: From here on every double is whole.
_WHOLE = float(2**53)


def _unless_whole(x: Column, rounded: Column) -> Column:
    return F.when(F.abs(x.cast("double")) >= _WHOLE, x.cast("double")).otherwise(rounded.cast("double"))


def floor(x: Arg) -> Column:
    return _unless_whole(_col(x), F.floor(_col(x)))


def ceil(x: Arg) -> Column:
    return _unless_whole(_col(x), F.ceil(_col(x)))


def trunc(x: Arg, digits: int = 0) -> Column:
    """Towards zero; to ``digits`` decimals if given, as the number is written."""
    value = _col(x)
    if digits <= 0:
        by = F.lit(10.0**-digits)
        return _unless_whole(value, F.signum(value) * F.floor(F.abs(value) / by) * by)
    written = value.cast("decimal(38,18)").cast("string")
    return _unless_whole(value, F.regexp_extract(written, rf"^-?\d+\.\d{{0,{min(digits, 18)}}}", 0))


def sign(x: Arg) -> Column:
    return F.signum(_col(x)).cast("double")


def ln(x: Arg) -> Column:
    """Null for what is not positive, where PostgreSQL raises."""
    return F.when(_col(x) > 0, F.ln(_col(x)))


def log(x: Arg, base: Arg | None = None) -> Column:
    """Base 10, or ``log(base, x)`` as ``log(x, base)``."""
    return F.when(_col(x) > 0, F.log10(_col(x)) if base is None else F.ln(_col(x)) / F.ln(_col(base)))


def mod(x: Arg, y: Arg) -> Column:
    """With the sign of x; null where y is 0."""
    return F.when(_col(y) != 0, _col(x) % _col(y))


def divide(x: Arg, y: Arg) -> Column:
    """Null where y is 0."""
    return F.try_divide(_col(x), _col(y))


def power(x: Arg, y: Arg) -> Column:
    return F.pow(_col(x), _col(y))


def to_int(x: Arg, kind: str = "int") -> Column:
    """int4, int8 by ``kind`` int or bigint: halves go to the even neighbour."""
    return F.bround(_col(x), 0).cast(kind)


def substr(s: Arg, start: int, length: int | None = None) -> Column:
    """Positions count from 1; a start before that uses up length."""
    if length is not None and length < 0:
        raise ValueError("negative substring length")
    if start >= 1:
        return F.substring(_col(s), start, 2**31 - 1 if length is None else length)
    return F.substring(_col(s), 1, 2**31 - 1 if length is None else max(0, length + start - 1))


def ltrim(s: Arg, chars: str = " ") -> Column:
    return F.ltrim(_col(s), F.lit(chars))


def rtrim(s: Arg, chars: str = " ") -> Column:
    return F.rtrim(_col(s), F.lit(chars))


def btrim(s: Arg, chars: str = " ") -> Column:
    return F.btrim(_col(s), F.lit(chars))


def length(s: Arg) -> Column:
    return F.length(_col(s)).cast("bigint")


def date_plus(d: Arg, days: Arg) -> Column:
    return F.date_add(_col(d).cast("date"), _col(days).cast("int"))


def days_between(later: Arg, earlier: Arg) -> Column:
    return F.datediff(_col(later), _col(earlier)).cast("bigint")


def epoch(ts: Arg) -> Column:
    """Whole seconds since 1970 of a timestamp without zone, read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), _col(ts).cast("timestamp_ntz"))


def l2_distance(a: Arg, b: Arg) -> Column:
    """Euclidean distance of two numeric arrays of one length."""
    squares = F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def inner_product(a: Arg, b: Arg) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_distance(a: Arg, b: Arg) -> Column:
    norm = F.sqrt(inner_product(a, a)) * F.sqrt(inner_product(b, b))
    return F.when(norm > 0, 1 - inner_product(a, b) / norm)
