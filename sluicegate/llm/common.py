"""Helpers that several operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import named
from sluicegate.session import new_work_dir
from sluicegate.sources.storage import remove_folder


# Shuffle files of a finished write are removed at once: nothing reads them again.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write once below the cluster's shared folder and read back, which cuts the lineage.

    What several jobs read is then one state, whichever executor is lost, and is worked out once.
    """
    return _landed_at(df, f"{new_work_dir(df.sparkSession, label)}/rows")


class Passing:
    """Landed tables that go when the block ends, as what needs them has been landed by then."""

    def __enter__(self) -> Passing:
        self.paths: list[tuple[SparkSession, str]] = []
        return self

    def land(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{new_work_dir(df.sparkSession, label)}/rows"
        self.paths.append((df.sparkSession, path))
        return _landed_at(df, path)

    def __exit__(self, *_: object) -> None:
        for spark, path in self.paths:
            remove_folder(spark, path)


def _landed_at(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return named(name)[0]


def with_text(df: DataFrame, text: str, keep: tuple[str, ...]) -> tuple[DataFrame, int]:
    """The columns of ``keep`` and the text, which goes to Python once even where it is kept; and its place."""
    if text in keep:
        return df.select(*named(*keep)), keep.index(text)
    return df.select(*named(*keep), column(text).alias("_text")), len(keep)


def remainder(key: Column | str, divisor: int) -> Column:
    """CRC32 of a key's text, modulo ``divisor``; NULL for a NULL key."""
    key = column(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % F.lit(divisor)


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) fixed by the keys, to choose a sample that a recomputed task chooses again."""
    return F.pmod(F.xxhash64(*keys, F.lit(97)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def ceil_div(rows: int, per: int) -> int:
    return max(1, -(-int(rows) // int(per)))


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """A schema with more fields behind its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
