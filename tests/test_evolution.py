"""The lattice of types, and tables whose batches differ in columns and types."""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from costlake.sources.evolution import EvolvingTable, common_schema, common_type

pytestmark = pytest.mark.usefixtures("spark")  # types are parsed by a session

ORDERED = ["tinyint", "smallint", "int", "bigint"]


def t(text):
    return T.StructType.fromDDL(f"c {text}")["c"].dataType


@pytest.mark.parametrize(("a", "b", "joined"), [
    ("int", "bigint", "bigint"), ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(18,4)", "decimal(23,4)"),
    ("decimal(10,4)", "decimal(12,1)", "decimal(15,4)"), ("float", "double", "double"), ("int", "float", "double"), ("decimal(9,2)", "double", "double"),
    ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("boolean", "int", "string"), ("date", "int", "string"), ("void", "date", "date"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,date>", "map<string,timestamp>", "map<string,timestamp>"),
    ("struct<a:int,b:string>", "struct<a:bigint,c:date>", "struct<a:bigint,b:string,c:date>")])
def test_joins(a, b, joined):
    assert common_type(t(a), t(b)).simpleString() == common_type(t(b), t(a)).simpleString().replace("struct<a:bigint,c:date,b:string>", joined) == joined


def test_lattice_laws():
    types = [t(x) for x in (*ORDERED, "decimal(7,3)", "decimal(12,0)", "float", "double", "date", "timestamp", "string", "boolean", "void")]
    for a, b, c in itertools.product(types, repeat=3):
        assert common_type(a, a) == a and common_type(a, b) == common_type(b, a)
        assert common_type(common_type(a, b), a) == common_type(a, b)
        one, two = common_type(common_type(a, b), c), common_type(a, common_type(b, c))
        assert one == two or {type(one), type(two)} == {T.StringType}


def test_no_common_type():
    for a, b in (("array<int>", "int"), ("decimal(38,0)", "decimal(38,10)")):
        with pytest.raises(TypeError):
            common_type(t(a), t(b))


def test_batches_of_all_kinds(spark, tmp_path):
    table = EvolvingTable(spark, f"file://{tmp_path}/t")
    day, time = dt.date(2024, 1, 2), dt.datetime(2024, 1, 3, 4, 5)
    table.append(spark.createDataFrame([(1, 2147483647, day, (1, "x"), [1])], "k int, n int, d date, s struct<a:int,b:string>, l array<int>"))
    table.append(spark.createDataFrame([(2, 9223372036854775807, time, None, [None, 5])], "k int, n bigint, d timestamp, s struct<a:int,b:string>, l array<bigint>"))
    table.append(spark.createDataFrame([(3, Decimal("0.25"), (7, 2.5), "new")], "k int, N decimal(6,2), s struct<a:bigint,c:double>, extra string"))
    table.append(spark.createDataFrame([(4, 5, day, None, None)], "k int, n int, d date, s struct<a:int,b:string>, l array<int>"))
    table.append(spark.createDataFrame([], "k int, n int, other boolean"))
    assert len(table.batches()) == 4
    df = table.read()
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {
        "k": "int", "n": "decimal(21,2)", "d": "timestamp", "s": "struct<a:bigint,b:string,c:double>", "l": "array<bigint>", "extra": "string", "other": "boolean"}
    rows = {r.k: r.asDict(recursive=True) for r in df.collect()}
    midnight = dt.datetime(2024, 1, 2)
    assert rows[1] == {"k": 1, "n": Decimal("2147483647.00"), "d": midnight, "s": {"a": 1, "b": "x", "c": None}, "l": [1], "extra": None, "other": None}
    assert rows[2] | {"s": 0} == {"k": 2, "n": Decimal("9223372036854775807.00"), "d": time, "s": 0, "l": [None, 5], "extra": None, "other": None}
    assert rows[3] == {"k": 3, "n": Decimal("0.25"), "d": None, "s": {"a": 7, "b": None, "c": 2.5}, "l": None, "extra": "new", "other": None}
    assert rows[2]["s"] is None and rows[4]["l"] is None


def test_common_schema_keeps_the_first_order():
    schemas = [T.StructType.fromDDL(x) for x in ("b int, A date", "c string, a timestamp, B bigint")]
    assert [(f.name, f.dataType.simpleString()) for f in common_schema(schemas)] == [("b", "bigint"), ("A", "timestamp"), ("c", "string")]
