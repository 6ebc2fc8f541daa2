"""The same questions put to Parquet tables in one folder, ``{folder}/{table}.parquet``."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.columns import in_interval
from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import Bounds


class LakeSource:
    """Spark splits Parquet by bytes: there are no bounds to ask for, and buckets change nothing."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str, max_files: int | None = None) -> DataFrame:
        """The table as an unbounded source. The bracket makes the path a pattern: a table may be
        one file or a folder of files, and a stream takes a single file only through a pattern."""
        reader = self.spark.readStream.schema(self.table(name).schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(f"{self.folder}/{name}[.]parquet")

    def count_frame(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        return self._interval(spec, since, until).agg(F.count("*").alias("n"))

    def key_range_frame(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        key = spec.stride_column
        return self._interval(spec, since, until).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))

    def grouped_frame(
        self,
        spec: TableSpec,
        group: str | None,
        values: Mapping[str, str],
        where: str | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        df = self._interval(spec, since, until)
        if where is not None:
            df = df.where(where)
        groups = [] if group is None else [F.expr(group).alias("piece")]
        return df.groupBy(*groups).agg(*(F.expr(v).alias(n) for n, v in values.items()))

    def split(
        self,
        spec: TableSpec,
        total_rows: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> Bounds | None:
        return None

    def read(
        self,
        spec: TableSpec,
        bounds: Bounds | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        df = self._interval(spec, since, until)
        return df.select(*spec.columns) if spec.columns else df

    def _interval(self, spec: TableSpec, since: datetime | None, until: datetime | None) -> DataFrame:
        df = self.table(spec.table)
        if since is None and until is None:
            return df
        return in_interval(df, spec.last_update_column, since, until)
