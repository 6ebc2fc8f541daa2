"""Documents as variants: listed fields as columns of their types, and those nobody listed found and kept."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import named, utc_second

# The fields of a quote, by the type each column has.
QUOTE = {"price": "double", "change": "double", "change_percent": "double", "volume": "bigint"}


def as_variant(text: str, name: str = "document") -> Column:
    """JSON text parsed once, as a generated column; NULL where it is none."""
    return F.explode(F.array(F.try_parse_json(F.col(text)))).alias(name)


def field(document: str | Column, path: str, kind: str) -> Column:
    """What lies at a path, as a type; NULL where there is nothing or it does not fit."""
    return F.try_variant_get(document, f"$.{path}" if path else "$", kind)


def _value(document: str, name: str, kind: str) -> Column:
    """A field of an object, whatever its name is made of: a path quotes a name one way or the other, and has none that holds both."""
    for mark in "'\"":
        if mark not in name:
            return F.try_variant_get(F.col(document), f"$[{mark}{name}{mark}]", kind)
    entries = F.from_json(F.to_json(F.col(document)), T.MapType(T.StringType(), T.StringType()))
    return F.try_element_at(entries, F.lit(name)).try_cast(kind)


def found_fields(df: DataFrame, column: str) -> dict[str, str]:
    """Every field that some row's object has, by name, with the type that holds its values: whole numbers, other numbers as
    doubles, booleans and texts as such, and JSON text (``string``) for nested ones and those of several types.

    One pass over the documents; one schema, merged over all rows, comes to the driver.
    """
    merged = df.agg(F.schema_of_variant_agg(column)).first()[0]
    if not merged or not merged.startswith("OBJECT<"):
        return {}
    # The same words as a type of Spark's, but for the name of an object.
    struct = T.StructType.fromDDL(f"c {merged.replace('OBJECT<', 'STRUCT<')}")["c"].dataType
    return {f.name: _kept(f.dataType) for f in struct.fields}


def _kept(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return "double"
    return "boolean" if isinstance(kind, T.BooleanType) else "string"


def with_fields_of(df: DataFrame, column: str, listed: Mapping[str, str]) -> DataFrame:
    """The listed fields of an object as columns of their types, then every other field that any row has, by name; the
    object itself goes. A field that has the name of a column beside it is left in none and gets ``_field`` behind its name."""
    others = {n: k for n, k in sorted(found_fields(df, column).items()) if n not in listed}
    beside = [c for c in df.columns if c != column]
    columns = []
    for name, kind in {**listed, **others}.items():
        clash = {c.lower() for c in beside}
        value = _value(column, name, kind)
        columns.append(value.alias(f"{name}_field" if name.lower() in clash else name))
    return df.select(*named(*beside), *columns)


def flatten_series(bodies: DataFrame, body: str = "body") -> DataFrame:
    """A row per quote of each answer: ``symbol, type, last_update_utc``, the fields of a quote, and whatever further fields the quotes have.

    Answers that are no JSON, and those without a series, give no rows. A moment that does not read as one is NULL.
    """
    parsed = bodies.select(as_variant(body))
    data = parsed.select(
        field("document", "data.symbol", "string").alias("symbol"),
        field("document", "data.type", "string").alias("type"),
        field("document", "data.time_series", "variant").alias("series"),
    )
    entries = data.lateralJoin(data.sparkSession.tvf.variant_explode(F.col("series").outer()))
    quotes = entries.where(F.col("key").isNotNull()).select("symbol", "type", utc_second(F.col("key")).alias("last_update_utc"), "value")
    return with_fields_of(quotes, "value", QUOTE)


def first_users(bodies: DataFrame, listed: Mapping[str, str], body: str = "body") -> DataFrame:
    """The first result of each user document: the listed fields, and whatever further fields the results have."""
    parsed = bodies.select(as_variant(body))
    users = parsed.select(field("document", "results[0]", "variant").alias("user"))
    return with_fields_of(users.where("user is not null"), "user", listed)
