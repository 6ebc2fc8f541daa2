"""Relational tables over JDBC: counts in the database, reads split by stride or by hash bucket."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from sluicegate.plans.spec import Connection, TableSpec
from sluicegate.plans.strategy import (
    TEXT_BUCKET_SQL,
    Bounds,
    bucket_predicates,
    interval_sql,
    date_bounds,
    file_count,
    read_strategy,
    stride_predicates,
)
from sluicegate.sources.base import count_rows, find_bounds
from sluicegate.sources.depth import equal_row_bounds


def url_dialect(url: str) -> str:
    """The database a URL names when its text hash is known, else the form for integer keys."""
    name = url.split(":")[1] if url.startswith("jdbc:") else ""
    return name if name in TEXT_BUCKET_SQL else "integer"


class JdbcSource:
    """One database of one connection.

    Every method that builds options or SQL text is apart from the one that hands it to Spark.
    """

    def __init__(
        self,
        spark: SparkSession,
        connection: Connection,
        database: str,
        dialect: str | None = None,
    ) -> None:
        self.spark = spark
        self.connection = connection
        self.database = database
        self.dialect = dialect or url_dialect(connection.url)

    def base_options(self) -> dict[str, str]:
        options = {
            "url": f"{self.connection.url}{self.database}",
            "user": self.connection.user,
            "fetchsize": str(self.connection.fetch_size),
            "preferTimestampNTZ": "true",
            **self.connection.extra,
        }
        password = self.connection.password()
        if password is not None:
            options["password"] = password
        if self.connection.driver:
            options["driver"] = self.connection.driver
        return options

    def count_query(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> str:
        return f"select count(*) as n from {spec.table}{self._where(spec, since, until)}"

    def key_range_query(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> str:
        key = spec.stride_column
        return f"select min({key}) as lo, max({key}) as hi from {spec.table}{self._where(spec, since, until)}"

    def grouped_query(
        self,
        spec: TableSpec,
        group: str | None,
        values: Mapping[str, str],
        where: str | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> str:
        columns = ", ".join(f"{v} as {n}" for n, v in values.items())
        text = self._where(spec, since, until)
        if where is not None:
            text = f"{text} and ({where})" if text else f" where {where}"
        if group is None:
            return f"select {columns} from {spec.table}{text}"
        return f"select {group} as piece, {columns} from {spec.table}{text} group by {group}"

    def table_text(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> str:
        """The table, or a subquery holding the interval: the database filters before it sends.

        Spark takes strides and predicates with a table text but not with ``query``.
        """
        where = self._where(spec, since, until)
        if not where and not spec.columns:
            return spec.table
        columns = ", ".join(spec.columns) or "*"
        return f"(select {columns} from {spec.table}{where}) src"

    def count_frame(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        return self._load(query=self.count_query(spec, since, until))

    def key_range_frame(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        return self._load(query=self.key_range_query(spec, since, until))

    def grouped_frame(
        self,
        spec: TableSpec,
        group: str | None,
        values: Mapping[str, str],
        where: str | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        return self._load(query=self.grouped_query(spec, group, values, where, since, until))

    def split(
        self,
        spec: TableSpec,
        total_rows: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> Bounds | None:
        """Bounds of the column that strides go by, or a plain number of pieces where a key is hashed.

        With ``bounds: rows`` the strides hold about equally many rows; a keyless table's key, such as a text, is then cut into
        ranges, which an index serves, instead of being hashed.
        """
        if spec.bounds == "rows" and (spec.partition_column or spec.split_key):
            return equal_row_bounds(self, spec, total_rows, since, until)
        if spec.partition_column:
            return find_bounds(self, spec, total_rows, since, until)
        if spec.split_key and (spec.num_partitions or read_strategy(spec) == "bucket"):
            pieces = spec.num_partitions or max(spec.buckets, file_count(total_rows or 0, spec.rows_per_file))
            return Bounds(0, pieces, pieces)
        if not spec.stride_column:
            return None
        rows = count_rows(self, spec, since, until) if total_rows is None else total_rows
        if file_count(rows, spec.rows_per_partition) < 2 and not spec.num_partitions:
            return None
        return date_bounds(spec, rows, tuple(self.key_range_frame(spec, since, until).first()))

    def read(
        self,
        spec: TableSpec,
        bounds: Bounds | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """By the pieces that ``split`` found; without them in one piece.

        Strides go by the split column, or by the date column of a dated table that names none. A table
        with neither is hashed by its key into as many pieces as its rows ask for; so is a dated one that names a key and
        ``num_partitions``. Each hashed piece scans the table in the database, so a number to
        split by is the better choice where there is one.
        """
        table = self.table_text(spec, since, until)
        if bounds is None or bounds.strides < 2:
            return self._load(dbtable=table)
        if bounds.cuts:
            return self._load_pieces(table, stride_predicates(spec.partition_column or spec.split_key, bounds))
        hashed = not spec.partition_column and spec.split_key and not bounds.moments
        if hashed:
            return self._load_pieces(table, bucket_predicates(spec.split_key, bounds.strides, self.dialect))
        return self._load_pieces(table, stride_predicates(spec.stride_column, bounds))

    def _where(self, spec: TableSpec, since: datetime | None, until: datetime | None) -> str:
        if since is None and until is None:
            return ""
        return f" where {interval_sql(spec.last_update_column, since, until)}"

    def _load_pieces(self, table: str, predicates: list[str]) -> DataFrame:
        options = self.base_options()
        return self.spark.read.jdbc(options.pop("url"), table, predicates=predicates, properties=options)

    def _load(self, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.base_options(), **options).load()
