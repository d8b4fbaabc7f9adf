"""Logical type names and table schemas."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import types as T

log = logging.getLogger("lakeweave")

#: Logical name -> Spark type (fixed values).
LOGICAL: Mapping[str, T.DataType] = {
    "text": T.StringType(), "varchar": T.StringType(), "string": T.StringType(), "json": T.StringType(),
    "bigint": T.LongType(), "integer": T.IntegerType(), "int": T.IntegerType(), "smallint": T.IntegerType(),
    "double": T.DoubleType(), "float": T.FloatType(), "decimal": T.DecimalType(38, 9),
    "bool": T.BooleanType(), "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(),
    "date": T.DateType(), "binary": T.BinaryType(),
}


def from_logical(name: str) -> T.DataType:
    """The Spark type of a logical name, in any case; unknown names are strings. ``time`` needs Spark's TIME type."""
    name = name.lower()
    if name == "time":
        return T.TimeType() if hasattr(T, "TimeType") else T.StringType()
    return LOGICAL.get(name, T.StringType())


def to_logical(kind: T.DataType) -> str:
    names = [(T.StringType, "text"), (T.LongType, "bigint"), (T.IntegerType, "bigint"), (T.ShortType, "bigint"), (T.ByteType, "bigint"), (T.DoubleType, "double"), (T.FloatType, "double"), (T.DecimalType, "decimal"), (T.BooleanType, "bool"), (T.TimestampNTZType, "timestamp"), (T.TimestampType, "timestamp"), (T.DateType, "date"), (T.BinaryType, "binary"), (T.ArrayType, "json"), (T.MapType, "json"), (T.StructType, "json")]
    return "time" if type(kind).__name__ == "TimeType" else next((n for c, n in names if isinstance(kind, c)), "text")


def table_type(kind: T.DataType) -> T.DataType:
    """The type in which a table keeps a column: small ints as int, nested types element by element, what tables don't know
    (intervals, void, variants) as string."""
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(kind, (T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(table_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(table_type(kind.keyType), table_type(kind.valueType), kind.valueContainsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, table_type(f.dataType), f.nullable, f.metadata) for f in kind])
    kept = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(kind, kept) or type(kind).__name__ == "TimeType":
        return kind
    log.warning("type %s is kept as string", kind.simpleString())
    return T.StringType()


def table_schema(batch: T.StructType, columns: Mapping[str, Mapping] | None = None) -> T.StructType:
    """A batch's schema as a table's: the batch decides types, the declared columns nullability and comments."""
    declared = columns or {}
    fields = []
    for f in batch:
        hint = declared.get(f.name, {})
        doc = hint.get("description") or f.metadata.get("comment")
        fields.append(T.StructField(f.name, table_type(f.dataType), bool(hint.get("nullable", True)), {"comment": doc} if doc else {}))
    return T.StructType(fields)


def comment(field: T.StructField) -> str | None:
    return (field.metadata or {}).get("comment")
