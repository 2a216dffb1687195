"""Servers, users' secrets and tables by name, over one Spark session.

A server is a database of the session's catalog, kept in the folder of its ``database`` option (or
a temporary one for ``:memory:``). A table is a view over a source: its columns are those declared,
found by name, or all of the source. Everything is planned by Catalyst as one query, so there is
no split between what runs here and elsewhere.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import __version__
from tessera.options import HADOOP, SECRETS, SERVER, TABLE, USER, OptionError, catalogs, truth, validated
from tessera.sources import writer
from tessera.sources.relation import name_parts, resolve
from tessera.sqlsafe import is_simple_name, quote_name, quote_path, quote_text, redacted
from tessera.types import struct_type

#: Rows assumed for a table whose server does not ask for counts.
DEFAULT_ROWS = 1000

_REFUSED = re.compile(r"\s*(update|delete)\b", re.I)


class RegistryError(LookupError):
    pass


@dataclass
class Server:
    name: str
    options: dict[str, str] = field(default_factory=dict)

    @property
    def database(self) -> str:
        """The catalog database: another one for each folder the server has pointed to."""
        place = self.options.get("database", ":memory:")
        return f"{self.name}_{hashlib.md5(place.encode()).hexdigest()[:8]}"

    @property
    def folder(self) -> str | None:
        place = self.options.get("database", ":memory:")
        return None if place == ":memory:" else place

    def __repr__(self) -> str:
        shown = {k: "***" if k in SECRETS else v for k, v in self.options.items()}
        return f"Server({self.name!r}, {shown})"


@dataclass
class Table:
    name: str
    server: str
    schema: T.StructType | None
    options: dict[str, str]


class Registry:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.servers: dict[str, Server] = {}
        self.tables: dict[str, Table] = {}
        self._secrets: dict[tuple[str, str], dict[str, str]] = {}
        self._stale: set[str] = set()  # tables to look up anew before the next use

    # servers and users

    def create_server(self, name: str, **options: str) -> Server:
        if not is_simple_name(name):
            raise RegistryError(f"not a server name: {name!r}")
        if name in self.servers:
            raise RegistryError(f"server {name!r} exists")
        server = Server(name, validated(options, SERVER))
        self._open(server)
        self.servers[name] = server
        return server

    def alter_server(self, name: str, **options: str) -> Server:
        """Set options; tables of the server read the new database from now on."""
        server = self.server(name)
        server.options |= validated(options, SERVER)
        self._open(server)
        self._stale |= {t.name for t in self.tables.values() if t.server == name}
        return server

    def drop_server(self, name: str, cascade: bool = False) -> None:
        own = [t.name for t in self.tables.values() if t.server == name]
        if own and not cascade:
            raise RegistryError(f"table {own[0]!r} depends on server {name!r}")
        self.server(name)
        for table in own:
            self.drop_table(table)
        del self.servers[name]
        self._secrets = {k: v for k, v in self._secrets.items() if k[0] != name}

    def server(self, name: str) -> Server:
        if name not in self.servers:
            raise RegistryError(f"no server {name!r}")
        return self.servers[name]

    def create_user_mapping(self, server: str, user: str, **options: str) -> None:
        """Keep a user's credentials apart from the server's visible options."""
        self.server(server)
        self._secrets[server, user] = validated(options, USER)

    def create_secret(self, server: str, user: str, key_id: str, secret: str, region: str | None = None) -> None:
        """Credentials of an object store for one user of a server."""
        self.create_user_mapping(server, user, s3_access_key_id=key_id, s3_secret_access_key=secret)
        if region:
            self.alter_server(server, s3_region=region)

    def store_settings(self, server: str, user: str | None = None) -> dict[str, str]:
        """Hadoop settings for the server's object store; the user's credentials come before the server's."""
        options = self.server(server).options | self._secrets.get((server, user or ""), {})
        return {HADOOP[k]: v for k, v in options.items() if k in HADOOP}

    def use_store(self, server: str, user: str | None = None) -> None:
        """Apply the settings to the session's file systems."""
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for key, value in self.store_settings(server, user).items():
            conf.set(key, value)

    def catalog_settings(self, server: str) -> dict[str, str]:
        """Spark settings of the catalogs a server attaches; Iceberg ones need its runtime among the packages."""
        found: dict[str, str] = {}
        for name, uri, settings in catalogs(self.server(server).options.get("attach_catalogs", "")):
            prefix = f"spark.sql.catalog.{name}"
            if settings.get("type", "iceberg").lower() != "iceberg":
                raise OptionError(f"catalog {name!r}: only type iceberg has a Spark catalog")
            found |= {prefix: "org.apache.iceberg.spark.SparkCatalog", f"{prefix}.warehouse": uri, f"{prefix}.type": settings.get("catalog", "hadoop")}
        return found

    def _open(self, server: Server) -> None:
        place = f" LOCATION {quote_text(server.folder)}" if server.folder else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name(server.database)}{place}")

    # tables

    def create_table(self, name: str, server: str, columns: dict[str, str] | T.StructType | None = None, **options: str) -> DataFrame:
        """Name a source: the ``table`` or ``read_parquet`` option, or else the table's own name."""
        self.server(server)
        schema = struct_type(columns) if isinstance(columns, dict) else columns
        table = Table(name, server, schema, validated(options, TABLE))
        found = self._bind(table)
        self.tables[name] = table
        return found

    def create_stored_table(self, server: str, name: str, columns: dict[str, str] | T.StructType, replace: bool = False) -> None:
        """An empty table in the server's database, its columns given by SQL type names."""
        schema = struct_type(columns) if isinstance(columns, dict) else columns
        writer.create_table_as((self.server(server).database, name), self.spark.createDataFrame([], schema), replace)

    def store(self, server: str, name: str, rows: DataFrame, replace: bool = False) -> None:
        """CREATE [OR REPLACE] TABLE AS: rows as a table in the server's database."""
        writer.create_table_as((self.server(server).database, name), rows, replace)

    def copy_to(self, sql: str, path: str, args: dict | list | None = None) -> None:
        """COPY (query) TO a Parquet folder."""
        writer.copy_to_parquet(self.query(sql, args), path)

    def drop_table(self, name: str) -> None:
        if self.tables.pop(name, None) is None:
            raise RegistryError(f"no table {name!r}")
        self._stale.discard(name)
        self.spark.catalog.dropTempView(name)

    def _refresh(self) -> None:
        """Look up stale tables; one whose source is not there (yet) has no view until it is."""
        for name in sorted(self._stale):
            try:
                self._bind(self.tables[name])
                self._stale.discard(name)
            except AnalysisException:
                self.spark.catalog.dropTempView(name)

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise RegistryError(f"no table {name!r}")
        self._refresh()
        return self.spark.table(quote_name(name))

    def _source(self, table: Table) -> str:
        return table.options.get("table") or table.options.get("read_parquet") or table.name

    def _bind(self, table: Table) -> DataFrame:
        source, server = self._source(table), self.server(table.server)
        try:
            parts = name_parts(source)
        except ValueError:
            parts = []
        if len(parts) == 1 and self.spark.catalog.tableExists(quote_path(server.database, parts[0])):
            found = self.spark.table(quote_path(server.database, parts[0]))
        else:
            found = resolve(self.spark, source, server.folder)
        if table.schema is not None:
            have = {c.lower(): c for c in found.columns}
            if missing := [f.name for f in table.schema.fields if f.name.lower() not in have]:
                raise RegistryError(f"the source of {table.name!r} has no column {missing[0]!r}")
            found = found.select([F.col(quote_name(have[f.name.lower()])).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        found.createOrReplaceTempView(table.name)
        return found

    def import_schema(self, server: str, source: str | None = None, only: set[str] | None = None, skip: set[str] = frozenset(), prefix: str = "") -> list[str]:
        """Name (with ``prefix`` before it) every table of the server's database, every Parquet file of a folder, or one Parquet file by its stem.

        A table that cannot be read is an error, not left out.
        """
        place = source or self.server(server).folder
        found: dict[str, str] = {}
        if source and source.lower().endswith(".parquet"):
            found[re.sub(r"\.parquet$", "", source.rpartition("/")[2], flags=re.I)] = source
        else:
            for t in self.spark.catalog.listTables(quote_name(self.server(server).database)) if source is None else []:
                if not t.isTemporary:
                    found[t.name] = t.name
            for path in self._children(place) if place else []:
                if path.lower().endswith(".parquet"):
                    found.setdefault(re.sub(r"\.parquet$", "", path.rpartition("/")[2], flags=re.I), path)
        names = sorted(n for n in found if (only is None or n in only) and n not in skip)
        if only and (missing := only - set(found)):
            raise RegistryError(f"nothing named {min(missing)!r} to import")
        for name in names:
            self.create_table(prefix + name, server, table=found[name])
        return [prefix + name for name in names]

    def _children(self, folder: str) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().toString() for s in files.listStatus(path)] if files.exists(path) else []

    # statements

    def query(self, sql: str, args: dict | list | None = None) -> DataFrame:
        """A query over the named tables, with ``:name`` or ``?`` parameters."""
        self._refresh()
        return self.spark.sql(sql, args=args)

    def execute(self, server: str, sql: str) -> DataFrame:
        """Any statement in the server's database; a failure raises, without what may be secret."""
        if m := _REFUSED.match(sql):
            getattr(writer, m[1].lower())()
        self._refresh()
        before = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(self.server(server).database)
        try:
            return self.spark.sql(sql)
        except Exception as error:
            text = str(error)
            raise RuntimeError(redacted(f"{sql}: {text}") if redacted(text + sql) != text + sql else text) from None
        finally:
            self.spark.catalog.setCurrentDatabase(before)

    def explain(self, sql: str, args: dict | list | None = None) -> str:
        """The formatted physical plan: pushed filters, read columns, exchanges."""
        return self.query(sql, args)._jdf.queryExecution().explainString(self.spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    def insert(self, name: str, rows: DataFrame) -> None:
        """Append rows to a stored table of the server's database, then read it anew."""
        table = self.tables.get(name)
        if table is None:
            raise RegistryError(f"no table {name!r}")
        parts = name_parts(self._source(table))
        writer.append(self.spark, (self.server(table.server).database, *parts), rows)
        self._bind(table)

    def update(self, name: str, *_: object, **__: object) -> None:
        writer.update()

    def delete(self, name: str, *_: object, **__: object) -> None:
        writer.delete()

    def updatable(self, name: str) -> frozenset[str]:
        """The writes a table takes."""
        self.table(name)
        return frozenset({"INSERT"})

    def estimated_rows(self, name: str) -> int:
        """A count if the server asks for estimates by counting, else a fixed guess."""
        table = self.tables.get(name)
        if table is None:
            raise RegistryError(f"no table {name!r}")
        return self.table(name).count() if truth(self.server(table.server).options.get("use_remote_estimate", "false")) else DEFAULT_ROWS

    # the session

    def version(self) -> str:
        return f"tessera {__version__} on Spark {self.spark.version}"

    def session_info(self) -> str:
        """Versions and settings that results depend on, as JSON."""
        keys = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
        return json.dumps({"tessera": __version__, "spark": self.spark.version, "master": self.spark.sparkContext.master, **{k: self.spark.conf.get(k) for k in keys}}, sort_keys=True)
