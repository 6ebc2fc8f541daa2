"""Column expressions shared by batch and stream; all of them stay in the JVM."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicegate.plans.strategy import timestamp_text


def named(*names: str) -> list[Column]:
    """Columns by their whole name, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def typed_literal(df: DataFrame, column: str, value: datetime | date) -> Column:
    """A literal of the column's own type, so that the comparison reaches the scan uncast."""
    return F.lit(timestamp_text(value)).cast(df.schema[column].dataType)


def in_interval(
    df: DataFrame, column: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Rows from ``since`` on and, when given, before ``until``."""
    if since is not None:
        df = df.where(F.col(column) >= typed_literal(df, column, since))
    if until is not None:
        df = df.where(F.col(column) < typed_literal(df, column, until))
    return df


def hash_bucket(key: Column | str, buckets: int, method: str = "xxhash64") -> Column:
    """Bucket 0..n-1 of a key, NULL for a NULL key.

    ``xxhash64`` is the cheap form; ``md5`` gives numbers another engine can work out too. ``pmod``
    has no value it overflows on, unlike ``abs`` on the smallest integer.
    """
    key = F.col(key) if isinstance(key, str) else key
    if method == "xxhash64":
        hashed = F.xxhash64(key)
    elif method == "md5":
        hashed = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    else:
        raise ValueError(f"unknown hash method {method!r}")
    return F.when(key.isNotNull(), F.pmod(hashed, F.lit(buckets).cast("bigint")))


def files_for(rows: Column, rows_per_file: int) -> Column:
    return F.ceil(rows / F.lit(rows_per_file)).cast("bigint")


def utc_second(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a zone-free timestamp; any other text gives NULL, not an error."""
    shape = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
    return F.when(text.rlike(shape), text.try_cast("timestamp_ntz"))


def is_uuid(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
