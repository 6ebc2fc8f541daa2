"""Schemas that drift: one that holds the values of all versions, and frames cast to it."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import named

# Digits of whole numbers, and the largest that a binary fraction holds without rounding.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
EXACT = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}
SCALARS = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_decimal(kind: T.DataType) -> tuple[int, int] | None:
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    digits = DIGITS.get(type(kind))
    return None if digits is None else (digits, 0)


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both as it is.

    Whole numbers, decimals and binary fractions widen among themselves where nothing is rounded, a date to a zone-free
    timestamp; other scalars meet as text. Structs, arrays and maps widen part by part; a nested and a flat
    type, or a timestamp with and one without a zone, have no common type and raise.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widened(a.keyType, b.keyType), widened(a.valueType, b.valueType))
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda t: DIGITS[type(t)])
    for one, other in ((a, b), (b, a)):
        if type(other) in EXACT.get(type(one), ()):
            return one
        if isinstance(one, T.DateType) and isinstance(other, T.TimestampNTZType):
            return other
    # An int and a float meet in a double, which holds both.
    if {type(a), type(b)} == {T.FloatType, T.IntegerType}:
        return T.DoubleType()
    first, second = _as_decimal(a), _as_decimal(b)
    if first and second:
        scale = max(first[1], second[1])
        whole = max(first[0] - first[1], second[0] - second[1])
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    zoned = {type(a), type(b)} & {T.TimestampType}
    local = {type(a), type(b)} & {T.TimestampNTZType, T.DateType}
    if isinstance(a, SCALARS) and isinstance(b, SCALARS) and not (zoned and local):
        return T.StringType()
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of both, those of ``a`` first, each wide enough for both; every one may be NULL."""
    second = {f.name: f.dataType for f in b.fields}
    fields = [T.StructField(f.name, widened(f.dataType, second.get(f.name, f.dataType))) for f in a.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])


def _cast(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    if kind == wanted:
        return value
    if isinstance(kind, T.StructType) and isinstance(wanted, T.StructType):
        parts = [
            (_cast(value.getField(f.name), kind[f.name].dataType, f.dataType) if f.name in kind.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _cast(x, kind.elementType, wanted.elementType))
    if isinstance(kind, T.MapType) and isinstance(wanted, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                _cast(e["key"], kind.keyType, wanted.keyType).alias("key"), _cast(e["value"], kind.valueType, wanted.valueType).alias("value")
            ),
        )
        return F.map_from_entries(entries)
    return value.cast(wanted)


def conformed(df: DataFrame, schema: T.StructType, more: Mapping[str, Column] | None = None) -> DataFrame:
    """The columns of ``schema`` in its order and types, NULL where the frame has none; behind them ``more``, by name."""
    columns = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            (_cast(named(f.name)[0], columns[f.name], f.dataType) if f.name in columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ),
        *(c.alias(name) for name, c in (more or {}).items()),
    )


def read_versions(
    spark: SparkSession, folders: Mapping[str, T.StructType], schema: T.StructType, more: Mapping[str, Column] | None = None
) -> DataFrame:
    """Parquet folders, each read by the schema it was written with and cast to ``schema``; one scan per version. ``more`` adds
    columns worked out where the files are read, such as from their paths."""
    versions: dict[str, list[str]] = {}
    for folder, written in folders.items():
        versions.setdefault(written.json(), []).append(folder)
    frames = []
    for text, paths in versions.items():
        read = spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(*paths)
        frames.append(conformed(read, schema, more))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)
