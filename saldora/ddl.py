"""Schema shorthand that needs no running session."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(), "long": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "float": T.FloatType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "smallint": T.ShortType(), "tinyint": T.ByteType(),
    "array<bigint>": T.ArrayType(T.LongType()), "array<double>": T.ArrayType(T.DoubleType()),
}


def data_type(name: str) -> T.DataType:
    return _TYPES[name]


def struct(text: str) -> T.StructType:
    """``"a int, `b.c` double"`` as a StructType."""
    fields = []
    for part in text.split(","):
        name, kind = part.strip().rsplit(maxsplit=1)
        fields.append(T.StructField(name.strip("`"), _TYPES[kind]))
    return T.StructType(fields)
