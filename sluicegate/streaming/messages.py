"""JSON messages: encode, decode, and part the malformed ones; the same for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import is_uuid, named
from sluicegate.functions.parsing import parse_once

# The fields of a user message, all text.
USER_FIELDS = (
    "id",
    "first_name",
    "last_name",
    "gender",
    "address",
    "post_code",
    "email",
    "username",
    "dob",
    "registered_date",
    "phone",
    "picture",
)
USER_MESSAGE = T.StructType([T.StructField(n, T.StringType()) for n in USER_FIELDS])

CORRUPT = "_corrupt_record"
# Microseconds survive the way through JSON; the formats Spark takes by itself stop at milliseconds.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def encode_messages(records: DataFrame, key: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Each record as UTF-8 JSON in ``value``, one message per record; ``carry`` keeps further columns.

    Messages with one key stay in order on one topic partition.
    """
    columns = [F.encode(F.to_json(F.struct(*named(*records.columns)), TIME_FORMATS), "UTF-8").alias("value")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").cast("binary").alias("key"))
    return records.select(*columns, *carry)


def message_text(messages: DataFrame) -> DataFrame:
    return messages.selectExpr("CAST(value AS STRING) AS value")


def decode_messages(messages: DataFrame, schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """The fields of each message as columns; a message that does not parse gives NULLs."""
    parsed = parse_once(F.col("value").cast("string"), schema, TIME_FORMATS)
    return messages.select(parsed.alias("data"), *carry).select("data.*", *carry)


def split_messages(
    messages: DataFrame,
    schema: T.StructType,
    required: Sequence[str] = (),
    carry: Sequence[str] = (),
    uuids: Sequence[str] = (),
) -> DataFrame:
    """Decoded messages with a ``status`` and, for a rejected one, its text in ``rejected_text``.

    Rejected are messages that do not parse, fields of the wrong type, NULL in a required field, which
    would otherwise reach a sink that has it as its key, and a text in one of ``uuids`` that is none.
    One pass, no message lost.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = messages.select(
        parse_once(text, marked, {"columnNameOfCorruptRecord": CORRUPT, **TIME_FORMATS}).alias("data"),
        text.alias("_text"),
        *carry,
    )
    bad = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull()
    for name in required:
        bad = bad | F.col("data").getField(name).isNull()
    for name in uuids:
        bad = bad | F.coalesce(~is_uuid(F.col("data").getField(name)), F.lit(False))
    return parsed.select(
        F.when(bad, F.lit("rejected")).otherwise(F.lit("accepted")).alias("status"),
        *(F.col("data").getField(n).alias(n) for n in schema.names),
        F.when(bad, F.col("_text")).alias("rejected_text"),
        *carry,
    )
