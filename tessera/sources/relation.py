"""What a table's source text may be, and the DataFrame it stands for.

A Parquet or CSV path, ``read_parquet('path')`` or ``read_csv('path', delim='|', header=false)``, with one
path or a list of them in brackets, ``range(a, b)`` or
``generate_series(a, b)``, a query in parentheses, or a name of one or more parts, quoted or not.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tessera.sqlsafe import checked_fragment, quote_path

_CALL = re.compile(r"\s*(read_parquet|read_csv|read_csv_auto|range|generate_series)\s*\((.*)\)\s*", re.I | re.S)
_QUOTED = r"'(?:[^']|'')*'"
_PATHS = re.compile(rf"\s*(?:({_QUOTED})|\[\s*({_QUOTED}(?:\s*,\s*{_QUOTED})*)\s*\])\s*")
_ARGUMENT = re.compile(rf"\s*,\s*(\w+)\s*(?:=|:=)\s*({_QUOTED}|[\w.+-]+)\s*")
#: Options of a CSV call and those of Spark's reader.
_CSV_OPTIONS = {"delim": "sep", "sep": "sep", "header": "header", "quote": "quote", "escape": "escape", "nullstr": "nullValue", "comment": "comment", "dateformat": "dateFormat", "timestampformat": "timestampFormat", "encoding": "encoding"}
_ABSOLUTE = re.compile(r"/|[A-Za-z][A-Za-z0-9+.-]*:/")
_NAME = re.compile(r'"((?:[^"]|"")+)"|([^".]+)')


class RelationError(ValueError):
    pass


def name_parts(text: str) -> list[str]:
    """``a.b."c.d"`` as its parts."""
    parts, at = [], 0
    while at < len(text):
        m = _NAME.match(text, at)
        if not m or (m.end() < len(text) and text[m.end()] != "."):
            raise RelationError(f"not a table name: {text!r}")
        parts.append(m[1].replace('""', '"') if m[1] else m[2].strip())
        at = m.end() + 1
    if not parts or not all(parts) or text.endswith("."):
        raise RelationError(f"not a table name: {text!r}")
    return parts


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, **options: str) -> DataFrame:
    """CSV files with a header, unless ``options`` (of Spark's reader) say otherwise; without a schema, types are inferred by one more pass over them."""
    reader = spark.read.options(**{"header": "true", **options})
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)


def _call(kind: str, text: str) -> tuple[list[str], dict[str, str]]:
    """The paths and Spark options of a call's arguments; one that cannot be kept to is an error."""
    m = _PATHS.match(text)
    if not m:
        raise RelationError(f"{kind} needs a path in quotes, or a list of them")
    unquoted = lambda x: x[1:-1].replace("''", "'") if x.startswith("'") else x
    paths, options, at = [unquoted(p) for p in re.findall(_QUOTED, m[0])], {}, m.end()
    while at < len(text):
        m = _ARGUMENT.match(text, at)
        known = m and (_CSV_OPTIONS.get(m[1].lower()) if kind != "read_parquet" else "mergeSchema" if m[1].lower() == "union_by_name" else None)
        if not known:
            raise RelationError(f"{kind} cannot read the argument {text[at:].strip()!r}")
        options[known] = unquoted(m[2])
        at = m.end()
    return paths, options


def resolve(spark: SparkSession, source: str, base: str | None = None) -> DataFrame:
    """The DataFrame of a source text; relative paths and plain names are looked up under ``base`` first."""
    text = source.strip()
    at = lambda path: path if base is None or _ABSOLUTE.match(path) else f"{base}/{path}"
    if text.startswith("(") and text.endswith(")"):
        return spark.sql(checked_fragment(text[1:-1]))
    if m := _CALL.fullmatch(text):
        kind = m[1].lower()
        if kind in ("range", "generate_series"):
            return series(spark, *map(int, checked_fragment(m[2]).split(",")), closed=kind == "generate_series")
        paths, options = _call(kind, m[2])
        found = [at(p) for p in paths]
        return spark.read.options(**options).parquet(*found) if kind == "read_parquet" else read_csv(spark, found, **options)
    if text.lower().endswith(".parquet"):
        return spark.read.parquet(at(text))
    if text.lower().endswith((".csv", ".csv.gz", ".tsv", ".tsv.gz")):
        return read_csv(spark, at(text), **({"sep": "\t"} if ".tsv" in text.lower()[-7:] else {}))
    return spark.table(quote_path(*name_parts(checked_fragment(text))))


def series(spark: SparkSession, *bounds: int, closed: bool = False) -> DataFrame:
    """``range(stop)``, ``range(start, stop[, step])``; ``closed`` includes the stop. One column, ``range`` or ``generate_series``."""
    if not 1 <= len(bounds) <= 3:
        raise RelationError("one to three bounds")
    start, stop, step = (0, bounds[0], 1) if len(bounds) == 1 else (*bounds, 1)[:3]
    end = stop + (1 if step > 0 else -1) if closed else stop
    return spark.range(start, end, step).toDF("generate_series" if closed else "range")
