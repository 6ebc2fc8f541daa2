"""Hash buckets of a key, and the bucketed full self join in counted form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.functions.columns import hash_bucket, named

BUCKET_COLUMN = "mod_hash_id"
# The rows of one key are dealt over so many tasks.
SALTS = 8


def with_bucket(df: DataFrame, key: str, buckets: int, method: str = "xxhash64") -> DataFrame:
    """The bucket as one more column: a projection, no join and no shuffle."""
    return df.withColumn(BUCKET_COLUMN, hash_bucket(key, buckets, method))


def with_group_size(df: DataFrame, key: str, name: str) -> DataFrame:
    """Each row with the number of rows that share its key; 1 for a NULL key, which equals no other.

    Rows are counted per key, reduced in each map task. The count of every key that comes more than once
    is repeated for each of ``SALTS`` salts, and rows are dealt by key and a drawn salt: whatever the
    number of keys and however hot one is, the plan is the same, and a key's rows meet its count in as
    many tasks as there are salts. Rows without a key are left aside.
    """
    columns = named(*df.columns)
    keyed = df.where(F.col(key).isNotNull())
    counts = keyed.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    counts = counts.select("_key", "_n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_part"))
    salted = keyed.withColumn("_salt", F.floor(F.rand(SALTS) * SALTS).cast("int"))
    met = salted.join(counts, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_part")), "left")
    without = df.where(F.col(key).isNull()).select(*columns, F.lit(1).cast("bigint").alias(name))
    return met.select(*columns, F.coalesce("_n", F.lit(1)).alias(name)).unionByName(without)


def self_join_counted(
    df: DataFrame, key: str, buckets: int, method: str = "xxhash64", copies: str = "copies"
) -> DataFrame:
    """``select bucket(u1.key), u2.* from t u1 full join t u2 on u1.key = u2.key`` with a multiplicity.

    The join gives each row of a k-fold key k times, each NULL-keyed row once with a NULL bucket, and
    once more as a row of NULLs. Here each row of the table comes once with its ``copies``, and the rows
    of NULLs as one, so the result is as large as the table while the join grows with the square of k.
    With unique keys, which is what the join is meant for, every ``copies`` is 1.
    """
    matched = with_group_size(df, key, copies).select(
        hash_bucket(key, buckets, method).alias(BUCKET_COLUMN),
        *named(*df.columns, copies),
    )
    empty = (
        df.where(F.col(key).isNull())
        .agg(F.count("*").alias(copies))
        .where(F.col(copies) > 0)
        .select(
            F.lit(None).cast("bigint").alias(BUCKET_COLUMN),
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields),
            F.col(copies),
        )
    )
    return matched.unionByName(empty)
