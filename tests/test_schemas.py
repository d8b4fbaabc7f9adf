"""Evolution, casts and type names: pure functions on schemas, and the casts' guards on rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from lakeweave import casting, evolution
from lakeweave.errors import CastingError, SchemaEvolutionError
from lakeweave.types import from_logical, table_schema, table_type, to_logical

pytestmark = pytest.mark.usefixtures("spark")


def schema(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize("old, new, ok", [("int", "bigint", True), ("float", "double", True), ("decimal(10,2)", "decimal(12,2)", True), ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(10,4)", False), ("decimal(10,2)", "decimal(8,2)", False), ("bigint", "int", False), ("int", "string", False), ("double", "float", False), ("int", "double", False), ("struct<a:int>", "struct<a:bigint,b:string>", True), ("struct<a:int,b:int>", "struct<a:int>", False), ("array<int>", "array<bigint>", True), ("map<string,int>", "map<string,string>", False)])
def test_promotion(old, new, ok):
    assert evolution.can_promote(schema(f"x {old}")["x"].dataType, schema(f"x {new}")["x"].dataType) is ok


def test_evolution_adds_and_promotes_and_never_drops():
    new, changed = evolution.evolve(schema("a int, b string"), schema("a bigint, c date"))
    assert changed and new.simpleString() == "struct<a:bigint,b:string,c:date>"
    assert evolution.evolve(schema("a int, b string"), schema("a int")) == (schema("a int, b string"), False)
    assert evolution.evolve(schema("a int, b string"), schema("a int"), allow_drops=True)[0] == schema("a int")


def test_evolution_errors():
    with pytest.raises(SchemaEvolutionError, match="a: bigint to int.*b: string to int"):
        evolution.evolve(schema("a bigint, b string"), schema("a int, b int"))
    with pytest.raises(SchemaEvolutionError, match="required columns are missing: id"):
        evolution.evolve(schema("id int not null, a bigint"), schema("a int"))  # before types are looked at
    with pytest.raises(SchemaEvolutionError, match="can't be required"):
        evolution.evolve(schema("a int"), schema("a int, b int not null"))
    assert evolution.evolve(schema("a int"), schema("a int, b int not null"), empty=True)[1]
    assert evolution.evolve(schema("a bigint"), schema("a int"), allow_upcast=True) == (schema("a bigint"), False)


def test_comments_change():
    old, new = table_schema(schema("a int"), {"a": {"description": "Old"}}), table_schema(schema("a int"), {"a": {"description": "New"}})
    out, changed = evolution.evolve(old, new)
    assert changed and out["a"].metadata == {"comment": "New"}
    assert evolution.evolve(old, table_schema(schema("a int"))) == (old, False)


@pytest.mark.parametrize("a, b, errors, warnings", [("int", "bigint", 0, 0), ("bigint", "int", 1, 0), ("double", "bigint", 1, 0), ("timestamp_ntz", "timestamp", 0, 1), ("timestamp", "timestamp_ntz", 1, 0), ("decimal(10,2)", "decimal(8,2)", 1, 0), ("decimal(10,4)", "decimal(10,2)", 1, 0), ("binary", "string", 0, 1), ("string", "binary", 0, 0), ("string", "int", 1, 0), ("int", "map<string,int>", 1, 0), ("double", "float", 0, 1)])
def test_cast_rules(a, b, errors, warnings):
    r = casting.validate(schema(f"x {a}"), schema(f"x {b}"))
    assert (len(r.errors), len(r.warnings)) == (errors, warnings)


def test_cast_columns():
    r = casting.validate(schema("a int, extra int"), schema("a int, b int, c int not null"))
    assert r.errors and r.warnings and r.missing_required == ["c"] and not r.safe


@pytest.mark.parametrize("a, b, good, bad", [("double", "bigint", 2.0, 1.5), ("bigint", "int", 5, 1 << 40), ("string", "int", "12", "x"), ("decimal(10,2)", "decimal(10,1)", Decimal("1.50"), Decimal("1.25")), ("bigint", "double", 1 << 53, (1 << 53) + 1), ("binary", "string", b"ok", b"\xff\xfe"), ("double", "int", -7.0, float("inf"))])
def test_lossy_values_fail_even_without_strict(spark, a, b, good, bad):
    from lakeweave.errors import translate

    rows = lambda v: casting.cast_frame(spark.createDataFrame([(v,), (None,)], f"x {a}"), schema(f"x {b}"), strict=False)
    assert rows(good).collect()[1][0] is None and float(rows(good).collect()[0][0]) == float(good) if b != "string" else rows(good).collect()[0][0] == "ok"
    with pytest.raises(Exception) as e:
        rows(bad).collect()
    assert isinstance(translate(e.value), CastingError)
    with pytest.raises(CastingError) if (a, b) not in (("bigint", "double"), ("binary", "string")) else pytest.raises(Exception):
        casting.cast_frame(spark.createDataFrame([(bad,)], f"x {a}"), schema(f"x {b}")).collect()


def test_reorder_fill_and_required(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = casting.cast_frame(df, schema("c int, b int, a int, d string"), strict=True)
    assert out.columns == ["c", "b", "a", "d"] and out.first() == (3, 2, 1, None)
    with pytest.raises(CastingError, match="required columns are missing: z"):
        casting.cast_frame(df, schema("a int, z int not null"), strict=False)


def test_aware_timestamps_become_utc(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00 America/New_York' AS t")
    assert casting.cast_frame(df, schema("t timestamp_ntz"), strict=False).first()[0] == dt.datetime(2024, 1, 1, 15)


def test_type_names():
    assert [from_logical(x).simpleString() for x in ("text", "BIGINT", "smallint", "decimal", "json", "what", "timestamptz")] == ["string", "bigint", "int", "decimal(38,9)", "string", "string", "timestamp"]
    assert [to_logical(schema(f"x {t}")["x"].dataType) for t in ("bigint", "string", "double", "boolean", "timestamp_ntz", "date", "array<int>")] == ["bigint", "text", "double", "bool", "timestamp", "date", "json"]
    assert table_type(schema("x struct<a:tinyint,b:array<smallint>>")["x"].dataType).simpleString() == "struct<a:int,b:array<int>>"
