"""JSON documents to flat rows: quote time series and user records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import utc_second
from sluicegate.functions.parsing import parse_once
from sluicegate.session import land

# The fields of a quote answer and, further below, of a user document.
# Prices as DOUBLE and volumes as BIGINT: narrower types would round the first and lose the second.
QUOTE = T.StructType(
    [
        T.StructField("price", T.DoubleType()),
        T.StructField("change", T.DoubleType()),
        T.StructField("change_percent", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)
QUOTE_BODY = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("symbol", T.StringType()),
                    T.StructField("type", T.StringType()),
                    T.StructField("time_series", T.MapType(T.StringType(), QUOTE)),
                ]
            ),
        )
    ]
)


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


USER = T.StructType(
    [
        T.StructField("name", _strings("first", "last")),
        T.StructField("gender", T.StringType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("street", _strings("number", "name")),
                    *_strings("city", "state", "country", "postcode").fields,
                ]
            ),
        ),
        T.StructField("email", T.StringType()),
        T.StructField("login", _strings("username")),
        T.StructField("dob", _strings("date")),
        T.StructField("registered", _strings("date")),
        T.StructField("phone", T.StringType()),
        T.StructField("picture", _strings("medium")),
    ]
)
USER_BODY = T.StructType([T.StructField("results", T.ArrayType(USER))])


def flatten_quotes(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per entry of each body's time series; a body without entries gives none.

    A missing volume is NULL, as is a timestamp that does not read as one.
    """
    parsed = bodies.select(parse_once(F.col(body), QUOTE_BODY).alias("response"))
    entries = parsed.select(
        F.col("response.data.symbol").alias("symbol"),
        F.col("response.data.type").alias("type"),
        F.explode("response.data.time_series").alias("moment", "feature"),
    )
    return entries.select(
        "symbol", "type", utc_second(F.col("moment")).alias("last_update_utc"), "feature.*"
    )


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit("None"))


def user_records(documents: DataFrame, body: str = "body") -> DataFrame:
    """The first result of each document as a flat record; a document without results gives no row.

    In the address a part that is null reads ``None``.
    """
    parsed = documents.select(parse_once(F.col(body), USER_BODY).alias("document"))
    users = parsed.select(F.get("document.results", F.lit(0)).alias("r"))
    street, place = "r.location.street", "r.location"
    address = F.concat_ws(
        ", ",
        F.concat(_text(f"{street}.number"), F.lit(" "), _text(f"{street}.name")),
        _text(f"{place}.city"),
        _text(f"{place}.state"),
        _text(f"{place}.country"),
    )
    return (
        users.where(F.col("r").isNotNull())
        .select(
            F.col("r.name.first").alias("first_name"),
            F.col("r.name.last").alias("last_name"),
            F.col("r.gender").alias("gender"),
            address.alias("address"),
            F.col("r.location.postcode").alias("post_code"),
            F.col("r.email").alias("email"),
            F.col("r.login.username").alias("username"),
            F.col("r.dob.date").alias("dob"),
            F.col("r.registered.date").alias("registered_date"),
            F.col("r.phone").alias("phone"),
            F.col("r.picture.medium").alias("picture"),
        )
    )


def assign_ids(records: DataFrame, path: str, name: str = "id") -> DataFrame:
    """Random ids, given once: the records are landed at ``path``, so no later job draws new ones."""
    return land(records.select(F.uuid().alias(name), "*"), path)
