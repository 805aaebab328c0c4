"""Append-only tables whose batches may differ in columns and types: read at the least type that holds them all.

A new export delivers a column as DECIMAL that older ones had as INT, or a TIMESTAMP in place of a DATE; files of both
can't be read with one merged schema. Here every batch keeps its own schema in a manifest beside the data. A reader
joins the schemas in a lattice of types, reads the batches of each distinct schema with that schema, casts them to the join
and unites them: as many scans as there are schemas, however many batches. Columns are never dropped; a batch without
one reads NULL there.

The lattice: BYTE < SHORT < INT < LONG < DECIMAL, with digits and scale for both sides; FLOAT < DOUBLE; integers of up
to 32 bits and floats join in DOUBLE, and so do LONG and DECIMAL with floats, where digits beyond a double's are lost, as in
Spark's own union; DATE < TIMESTAMP; structs, arrays and maps join part by part; all else joins in STRING.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
FLOATS = (T.FloatType, T.DoubleType)
NESTED = (T.StructType, T.ArrayType, T.MapType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if isinstance(a, NESTED) or isinstance(b, NESTED):
        raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    digits = [INTEGERS.get(type(t)) for t in (a, b)]
    if None not in digits:
        return a if digits[0] >= digits[1] else b
    exact = [isinstance(t, T.DecimalType) or type(t) in INTEGERS for t in (a, b)]
    floating = [isinstance(t, FLOATS) for t in (a, b)]
    if all(exact):
        whole, scale = 0, 0
        for t in (a, b):
            own = t.scale if isinstance(t, T.DecimalType) else 0
            whole, scale = max(whole, (t.precision - own) if isinstance(t, T.DecimalType) else INTEGERS[type(t)]), max(scale, own)
        if whole + scale > T.DecimalType(38, 0).precision:
            raise TypeError(f"no decimal holds {a.simpleString()} and {b.simpleString()}")
        return T.DecimalType(whole + scale, scale)
    if all(e or f for e, f in zip(exact, floating, strict=True)):
        return T.DoubleType()
    return T.StringType()


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns in the order in which they first appear (names without regard to case), each at its common type."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            old = found.get(f.name.lower())
            found[f.name.lower()] = T.StructField(old.name, common_type(old.dataType, f.dataType)) if old else T.StructField(f.name, f.dataType)
    return T.StructType(list(found.values()))


def conformed(c: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A column at a type that holds it; fields that a struct lacks are NULL."""
    if own == wanted:
        return c
    if isinstance(wanted, T.StructType):
        fields = {f.name.lower(): f for f in own.fields}
        parts = [conformed(c.getField(f.name), fields[f.name.lower()].dataType, f.dataType).alias(f.name) if f.name.lower() in fields
                 else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(wanted, T.ArrayType) and isinstance(own, T.ArrayType):
        return F.transform(c, lambda x: conformed(x, own.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType) and isinstance(own, T.MapType):
        keys = F.transform(F.map_keys(c), lambda x: conformed(x, own.keyType, wanted.keyType))
        return F.map_from_arrays(keys, F.transform(F.map_values(c), lambda x: conformed(x, own.valueType, wanted.valueType)))
    return c.cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of a common schema, in its order."""
    own = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[
        (conformed(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


class EvolvingTable:
    """Batches under ``path/data`` and their schemas under ``path/manifest``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def append(self, batch: DataFrame) -> None:
        """Add a batch of any columns. It counts once its row is in the manifest, so a write that fails leaves nothing behind."""
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"  # in order of writing
        batch.write.parquet(f"{self.path}/data/{name}")
        self.spark.createDataFrame([(name, batch.schema.json())], "batch string, schema string").coalesce(1).write.mode("append").parquet(
            f"{self.path}/manifest")

    def batches(self) -> dict[str, list[str]]:
        """Names of batches by their schema's JSON text, in order of writing; one small row for each batch."""
        out: dict[str, list[str]] = {}
        for r in self.spark.read.parquet(f"{self.path}/manifest").orderBy("batch").collect():
            out.setdefault(r.schema, []).append(r.batch)
        return out

    def read(self) -> DataFrame:
        """All rows at the common schema."""
        groups = [(T.StructType.fromJson(json.loads(text)), names) for text, names in self.batches().items()]
        wanted = common_schema([schema for schema, _ in groups])
        parts = [conform(self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{n}" for n in names]), wanted) for schema, names in groups]
        return reduce(DataFrame.unionByName, parts)
