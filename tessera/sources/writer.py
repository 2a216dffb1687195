"""Writing: appends, copies and tables made from queries. Updates and deletes are refused by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sqlsafe import quote_path


class UnsupportedWriteError(NotImplementedError):
    pass


def aligned(rows: DataFrame, target: DataFrame) -> DataFrame:
    """``rows`` with the target's columns, by name, in its order and types; columns that are missing are null."""
    from pyspark.sql import functions as F

    if extra := [c for c in rows.columns if c not in target.columns]:
        raise ValueError(f"the target has no column {extra[0]!r}")
    return rows.select([(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields])


def append(spark: SparkSession, table: tuple[str, ...], rows: DataFrame) -> None:
    """INSERT INTO table SELECT: one distributed job; it is committed whole or raises."""
    name = quote_path(*table)
    aligned(rows, spark.table(name)).write.insertInto(name)


def copy_to_parquet(rows: DataFrame, path: str, *partition_by: str, overwrite: bool = False) -> None:
    """COPY (query) TO 'path'; what is there already is an error unless it is to be overwritten."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(*partition_by).parquet(path)


def create_table_as(table: tuple[str, ...], rows: DataFrame, replace: bool = False) -> None:
    """CREATE [OR REPLACE] TABLE AS query, stored as Parquet."""
    rows.write.format("parquet").mode("overwrite" if replace else "errorifexists").saveAsTable(quote_path(*table))


def update(*_: object, **__: object) -> None:
    raise UnsupportedWriteError("UPDATE is not supported: tables are append-only")


def delete(*_: object, **__: object) -> None:
    raise UnsupportedWriteError("DELETE is not supported: tables are append-only")
