"""Servers, options, secrets, import, statements and writes."""

import json

import pytest
from pyspark.sql import types as T

from tessera import options
from tessera.registry import DEFAULT_ROWS, Registry, RegistryError
from tessera.sources.relation import RelationError, name_parts, resolve
from tessera.sources.writer import UnsupportedWriteError
from tessera.sqlsafe import UnsafeSqlError, checked_fragment, is_simple_name, quote_name, quote_path, quote_text, redacted
from tessera.types import spark_type, struct_type

SF = "/root/testdata/sf0.001"


@pytest.fixture
def registry(spark):
    return Registry(spark)


def test_stored_table_insert_and_filter(registry, tmp_path):
    registry.create_server("store", database=str(tmp_path / "one"))
    registry.execute("store", "CREATE TABLE lots (lot INT, weight BIGINT, share DOUBLE, note STRING) USING parquet")
    registry.execute("store", f"INSERT INTO lots SELECT p_partkey, p_size, p_size / 64D, p_name FROM parquet.`{SF}/part.parquet` WHERE p_partkey <= 20")
    registry.create_table("mine", "store", {"lot": "INTEGER", "weight": "BIGINT", "share": "DOUBLE", "note": "VARCHAR"}, table="lots")
    parts = registry.spark.read.parquet(f"{SF}/part.parquet").filter("p_partkey <= 20").collect()
    assert sorted(tuple(r) for r in registry.table("mine").collect()) == sorted((r.p_partkey, r.p_size, r.p_size / 64, r.p_name) for r in parts)
    registry.insert("mine", registry.spark.sql("SELECT 'x' AS note, CAST(-id AS INT) AS lot, id * id AS weight FROM range(1, 8)"))
    assert registry.table("mine").count() == len(parts) + 7
    assert tuple(registry.query("SELECT lot, weight, share, note FROM mine WHERE lot = :n", {"n": -4}).first()) == (-4, 16, None, "x")
    assert tuple(registry.query("SELECT lot, weight FROM mine WHERE lot = ?", [-5]).first()) == (-5, 25)
    with pytest.raises(ValueError):
        registry.insert("mine", registry.spark.sql("SELECT 1 AS nosuch"))
    assert registry.updatable("mine") == {"INSERT"}
    for refused in (registry.update, registry.delete):
        with pytest.raises(UnsupportedWriteError):
            refused("mine")
    for sql in ("UPDATE lots SET note = 'x'", "delete from lots"):
        with pytest.raises(UnsupportedWriteError):
            registry.execute("store", sql)


def test_altered_server_reads_the_new_database(registry, tmp_path):
    registry.create_server("sw", database=str(tmp_path / "one"))
    for place, value in (("one", 1), ("two", 2)):
        registry.alter_server("sw", database=str(tmp_path / place))
        registry.execute("sw", "CREATE TABLE st (i INT) USING parquet")
        registry.execute("sw", f"INSERT INTO st VALUES ({value})")
        if place == "one":
            registry.create_table("st_view", "sw", {"i": "INTEGER"}, table="st")
    for place, value in (("one", 1), ("two", 2)):
        registry.alter_server("sw", database=str(tmp_path / place))
        assert [r.i for r in registry.query("SELECT * FROM st_view").collect()] == [value]
    with pytest.raises(RegistryError):
        registry.drop_server("sw")
    registry.drop_server("sw", cascade=True)
    with pytest.raises(RegistryError):
        registry.table("st_view")


def test_types_round_trip(registry, tmp_path):
    registry.create_server("ty", database=str(tmp_path / "ty"))
    registry.execute("ty", "CREATE TABLE a (id INT, b BOOLEAN, d DATE, ts TIMESTAMP_NTZ, arr ARRAY<INT>, f FLOAT, n DECIMAL(18,3), s STRING) USING parquet")
    registry.execute("ty", "INSERT INTO a VALUES (1, true, DATE'2025-01-01', TIMESTAMP_NTZ'1960-01-01 00:00:00', array(1, 2), 1.5, 12345.678, 'x'), (2, NULL, NULL, NULL, NULL, NULL, NULL, NULL)")
    columns = {"id": "INT", "b": "BOOL", "d": "DATE", "ts": "TIMESTAMP", "arr": "INTEGER[]", "f": "FLOAT", "n": "DECIMAL(18,3)", "s": "UUID"}
    got = registry.create_table("ty_a", "ty", columns, table="a").orderBy("id").collect()
    assert got[0].arr == [1, 2] and str(got[0].n) == "12345.678" and got[0].ts.year == 1960
    assert list(got[1])[1:] == [None] * 7
    with pytest.raises(RegistryError):
        registry.create_table("ty_b", "ty", {"nosuch": "INT"}, table="a")


def test_import_and_sources(registry):
    registry.create_server("imp")
    assert registry.import_schema("imp", SF, only={"nation", "region"}) == ["nation", "region"]
    assert registry.import_schema("imp", f"{SF}/supplier.parquet") == ["supplier"]
    assert registry.query("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == 25
    with pytest.raises(RegistryError):
        registry.import_schema("imp", SF, only={"nosuch"})
    assert registry.create_table("p", "imp", read_parquet=f"{SF}/part.parquet").count() == 200
    assert registry.create_table("q", "imp", table="(SELECT n_name FROM nation WHERE n_nationkey < 3)").count() == 3
    registry.create_server("folder", database=SF, use_remote_estimate="true")
    assert registry.create_table("c", "folder", table="customer.parquet").count() == 150
    assert registry.estimated_rows("c") == 150 and registry.estimated_rows("p") == DEFAULT_ROWS
    assert "PushedFilters" in registry.explain("SELECT c_name FROM c WHERE c_custkey = 1")


def test_options_and_secrets(registry):
    with pytest.raises(options.OptionError):
        registry.create_server("bad", nosuch="x")
    with pytest.raises(options.OptionError):
        registry.create_server("bad", table="x")
    server = registry.create_server("s3", s3_region="eu-west-1", s3_access_key_id="server-key", s3_use_ssl="true", attach_catalogs="lake=s3://bucket/path;type iceberg")
    registry.create_user_mapping("s3", "ann", s3_access_key_id="ann-key", s3_secret_access_key="hush")
    assert registry.store_settings("s3")["fs.s3a.access.key"] == "server-key"
    mine = registry.store_settings("s3", "ann")
    assert (mine["fs.s3a.access.key"], mine["fs.s3a.secret.key"], mine["fs.s3a.endpoint.region"]) == ("ann-key", "hush", "eu-west-1")
    assert "server-key" not in repr(server) and "hush" not in repr(vars(server))
    assert registry.catalog_settings("s3")["spark.sql.catalog.lake.warehouse"] == "s3://bucket/path"
    with pytest.raises(options.OptionError):
        options.catalogs("lake")
    with pytest.raises(RuntimeError, match="withheld"):
        registry.execute("s3", "CREATE TABLE x OPTIONS (secret_access_key 'abc')")
    assert [options.truth(x) for x in ("on", "0", True, None)] == [True, False, True, False]


def test_session(registry):
    assert "Spark" in registry.version()
    assert json.loads(registry.session_info())["spark.sql.session.timeZone"] == "UTC"


def test_quoting():
    assert quote_name("a`b") == "`a``b`" and quote_path("a", "b.c") == "`a`.`b.c`"
    assert quote_text("it's \\") == "'it\\'s \\\\'"
    assert is_simple_name("a_1") and not is_simple_name("1a") and not is_simple_name("a b") and not is_simple_name("")
    for bad in ("a; b", "a -- b", "/* x", "a\x00", " "):
        with pytest.raises(UnsafeSqlError):
            checked_fragment(bad)
    assert redacted("plain") == "plain" and "abc" not in redacted("TOKEN abc")


def test_names_and_relations(spark):
    assert name_parts('db."my.schema".t') == ["db", "my.schema", "t"] and name_parts('"a""b"') == ['a"b']
    for bad in ("", "a.", ".a", 'a"b', 'a."b"c'):
        with pytest.raises(RelationError):
            name_parts(bad)
    assert [r[0] for r in resolve(spark, "range(2, 8, 3)").collect()] == [2, 5]
    assert [r[0] for r in resolve(spark, "generate_series(1, 3)").collect()] == [1, 2, 3]
    with pytest.raises(UnsafeSqlError):
        resolve(spark, "(SELECT 1; SELECT 2)")


def test_csv_options_and_lists(spark, tmp_path):
    for name, text in (("a.csv", "x|y\n1|NA\n"), ("b.csv", "x|y\n2|q\n"), ("t.tsv", "x\ty\n3\tz\n")):
        (tmp_path / name).write_text(text)
    base = str(tmp_path)
    rows = lambda source: sorted(tuple(r) for r in resolve(spark, source, base).collect())
    assert rows("read_csv('a.csv', delim='|', nullstr='NA')") == [(1, None)]
    assert rows("read_csv(['a.csv', 'b.csv'], sep = '|')") == [(1, "NA"), (2, "q")]
    assert rows("read_csv('b.csv', delim='|', header=false)") == [("2", "q"), ("x", "y")]
    assert rows("t.tsv") == [(3, "z")]
    assert resolve(spark, f"read_parquet(['{SF}/nation.parquet', '{SF}/nation.parquet'])").count() == 50
    for bad in ("read_csv('a.csv', nosuch=1)", "read_csv(a.csv)", "read_parquet('x.parquet', delim='|')"):
        with pytest.raises(RelationError):
            resolve(spark, bad, base)


@pytest.mark.parametrize(
    ("name", "kind"),
    [
        ("integer", T.IntegerType()), ("HUGEINT", T.DecimalType(38, 0)), ("TINYINT", T.ShortType()), ("DECIMAL(10, 2)", T.DecimalType(10, 2)), ("NUMERIC", T.DecimalType(18, 3)),
        ("TIMESTAMP WITH TIME ZONE", T.TimestampType()), ("TIMESTAMP", T.TimestampNTZType()), ("FLOAT[3]", T.ArrayType(T.FloatType())), ("INT[][]", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ("VARCHAR(10)", T.StringType()), ("MAP(VARCHAR, DECIMAL(4,1))", T.MapType(T.StringType(), T.DecimalType(4, 1))), ("whatever", T.StringType()), ("BLOB", T.BinaryType()),
        ('STRUCT(a INTEGER, "b" VARCHAR[])', T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.ArrayType(T.StringType()))])),
    ],
)
def test_type_names(name, kind):
    assert spark_type(name) == kind
    assert struct_type({"x": name}).fields[0].dataType == kind
