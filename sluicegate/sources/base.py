"""What an extraction asks of a source, whichever way the rows are stored."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame

from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import Bounds, needs_key_range, needs_row_count, resolve_bounds


class Source(Protocol):
    def count_frame(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        """One row, one column ``n``."""

    def key_range_frame(
        self, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
    ) -> DataFrame:
        """One row, ``lo`` and ``hi`` of the split column."""

    def grouped_frame(
        self,
        spec: TableSpec,
        group: str | None,
        values: Mapping[str, str],
        where: str | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """One row per ``group`` (which comes first) or one in all, with aggregates by name; all are SQL texts."""

    def split(
        self,
        spec: TableSpec,
        total_rows: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> Bounds | None:
        """The bounds a read by the split column needs, or None where the source splits by itself."""

    def read(
        self,
        spec: TableSpec,
        bounds: Bounds | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """The rows, split for parallel reading; nothing is read yet."""


def count_rows(
    source: Source, spec: TableSpec, since: datetime | None = None, until: datetime | None = None
) -> int:
    return int(source.count_frame(spec, since, until).first()[0])


def find_bounds(
    source: Source,
    spec: TableSpec,
    total_rows: int | None = None,
    since: datetime | None = None,
    until: datetime | None = None,
) -> Bounds:
    """Bounds of the split column; asks the source only for what the spec leaves open.

    The range is that of the rows to be read: new rows tend to have the highest keys, and strides over
    all keys would leave them to the last one.
    """
    if needs_key_range(spec):
        lo, hi = source.key_range_frame(spec, since, until).first()
        return resolve_bounds(spec, 0, (lo, hi))
    if needs_row_count(spec) and total_rows is None:
        total_rows = count_rows(source, spec)
    return resolve_bounds(spec, total_rows or 0)
