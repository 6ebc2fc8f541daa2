"""Decisions taken on the driver from a spec and a count: read strategy, bounds, file count, paths."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timezone
from numbers import Number

from sluicegate.plans.spec import TableSpec, check_identifier

def read_strategy(spec: TableSpec) -> str:
    """A dated table is read since a start, a keyed one by strides, any other by hash bucket."""
    if spec.last_update_column:
        return "incremental"
    return "stride" if spec.partition_column else "bucket"


def layout(spec: TableSpec) -> str:
    """Only the bucket read has a bucket to lay its directories out by, given a key to hash."""
    return "bucketed" if read_strategy(spec) == "bucket" and spec.bucket_key else "sized"


def file_count(rows: int, rows_per_file: int = 1_000_000) -> int:
    return -(-rows // rows_per_file)


@dataclass(frozen=True)
class Bounds:
    """Ends of a split column, numbers or moments; or the very cuts between strides, numbers or texts."""

    lower: int | datetime
    upper: int | datetime
    partitions: int
    cuts: tuple[int | str, ...] = ()

    @property
    def moments(self) -> bool:
        return isinstance(self.lower, datetime)

    @property
    def strides(self) -> int:
        if self.cuts:
            return len(self.cuts) + 1
        if self.moments:
            return self.partitions
        return max(1, min(self.partitions, self.upper - self.lower))

def _is_word(value: object, word: str) -> bool:
    return value is None or (isinstance(value, str) and value.lower() == word)


def needs_key_range(spec: TableSpec) -> bool:
    open_end = _is_word(spec.lower_bound, "min") or _is_word(spec.upper_bound, "max")
    return spec.bounds == "minmax" and open_end


def needs_row_count(spec: TableSpec) -> bool:
    return spec.bounds == "count" and _is_word(spec.upper_bound, "max")


def _end(value: object) -> int | datetime:
    """A bound as a number, or as the moment it stands for."""
    if isinstance(value, datetime):
        return utc(value)
    if isinstance(value, Number):
        return int(value)
    text = str(value)
    return int(text) if text.lstrip("-").isdigit() else utc(datetime.fromisoformat(text))


def resolve_bounds(
    spec: TableSpec, total_rows: int, key_range: tuple | None = None
) -> Bounds:
    """Turn ``min`` / ``max`` / null into numbers.

    With ``bounds='count'`` the open upper end is the row count and the open lower end 0; with
    ``minmax`` they are the true ends of the key, so that sparse keys do not pile up in one stride.
    Either way the bounds only place the cuts: no row is left out. A date or timestamp column is cut
    into ``num_partitions`` strides, which its spec then has to name. An open end that falls on the
    wrong side of a fixed one is moved to it; two fixed ends the wrong way round are an error.
    """
    low_key, high_key = (0, total_rows)
    if spec.bounds == "minmax" and key_range and key_range[0] is not None:
        low_key, high_key = (_end(k) for k in key_range)
        if not isinstance(high_key, datetime):
            high_key += 1
    lower = low_key if _is_word(spec.lower_bound, "min") else _end(spec.lower_bound)
    upper = high_key if _is_word(spec.upper_bound, "max") else _end(spec.upper_bound)
    if isinstance(lower, datetime) != isinstance(upper, datetime):
        raise ValueError(f"{spec.table}: one bound is a date and the other is not")
    if isinstance(lower, datetime) and spec.num_partitions is None:
        raise ValueError(f"{spec.table}: a date column is split into a given number of partitions")
    if lower > upper and not (_is_word(spec.lower_bound, "min") or _is_word(spec.upper_bound, "max")):
        raise ValueError(f"{spec.table}: lower bound {lower} is above upper bound {upper}")
    upper = max(lower, upper)
    if spec.num_partitions is None:
        partitions = max(1, -(-(upper - lower) // spec.rows_per_partition))
    else:
        partitions = max(1, spec.num_partitions)
    return Bounds(lower, upper, partitions)


def date_bounds(spec: TableSpec, total_rows: int, moments: tuple | None) -> Bounds | None:
    """Bounds of the date column itself, for a dated table that names no other split: as many strides as
    its rows ask for. None where all rows have one moment, or none."""
    if not moments or moments[0] is None or moments[0] == moments[1]:
        return None
    pieces = spec.num_partitions or max(1, file_count(total_rows, spec.rows_per_partition))
    return Bounds(_end(moments[0]), _end(moments[1]), pieces)


# How each database hashes a text key to a bucket number.
TEXT_BUCKET_SQL = {
    "postgresql": "mod(abs(cast(hashtext(cast({key} as text)) as bigint)), {n})",
    "mysql": "mod(crc32({key}), {n})",
}


def bucket_predicates(key: str, buckets: int, dialect: str = "integer") -> list[str]:
    """One WHERE text per bucket and one for NULL keys; together they cover every row once.

    Integer keys work in any database: a negative key has a remainder of -(n-1)..0, so bucket i
    takes both i and i - n.
    """
    check_identifier(key)
    predicates = []
    for i in range(buckets):
        if dialect == "integer":
            text = f"mod({key}, {buckets}) in ({i}, {i - buckets})"
        else:
            text = f"{TEXT_BUCKET_SQL[dialect].format(key=key, n=buckets)} = {i}"
        predicates.append(text)
    return [*predicates, f"{key} is null"]


def utc(moment: datetime) -> datetime:
    """A moment with a zone as the UTC time it stands for, without one as it is."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def timestamp_text(moment: datetime | date) -> str:
    """The text of a moment; only date objects get this far, never strings from outside."""
    if isinstance(moment, datetime):
        return utc(moment).isoformat(sep=" ")
    return f"{moment.isoformat()} 00:00:00"


def quoted(text: str) -> str:
    """A text as it stands in a statement."""
    return "'" + text.replace("'", "''") + "'"


def _literal(cut: int | str | datetime) -> str:
    if isinstance(cut, datetime):
        return f"timestamp '{timestamp_text(cut)}'"
    return quoted(cut) if isinstance(cut, str) else str(cut)


def stride_cuts(bounds: Bounds) -> list[int | str | datetime]:
    """Where one stride ends and the next begins: the cuts found before, or the span in equal parts, numbers rounded down."""
    if bounds.cuts:
        return list(bounds.cuts)
    span, n = bounds.upper - bounds.lower, bounds.strides
    return [bounds.lower + (span * i / n if bounds.moments else span * i // n) for i in range(1, n)]


def stride_predicates(column: str, bounds: Bounds) -> list[str]:
    """One WHERE text per stride of a number, text, date or timestamp column, and one for its NULLs.

    Strides are half-open; the first has no lower end and the last no upper one, so together they cover
    every row once. The read sends these very texts: what is tested of them holds for it.
    """
    check_identifier(column)
    cuts = stride_cuts(bounds)
    if not cuts:
        return ["1 = 1"]
    ends = [_literal(c) for c in cuts]
    inner = [f"{column} >= {a} and {column} < {b}" for a, b in zip(ends, ends[1:])]
    return [f"{column} < {ends[0]}", *inner, f"{column} >= {ends[-1]}", f"{column} is null"]


def interval_sql(column: str, since: datetime | None, until: datetime | None) -> str:
    """``since`` belongs to the interval, ``until`` does not; without ``until`` it stays open."""
    check_identifier(column)
    parts = []
    if since is not None:
        parts.append(f"{column} >= timestamp '{timestamp_text(since)}'")
    if until is not None:
        parts.append(f"{column} < timestamp '{timestamp_text(until)}'")
    return " and ".join(parts)


def date_tag(day: date | datetime) -> str:
    """``yyyyMMdd``, with the time behind it where there is one, so that runs within a day keep apart."""
    if not isinstance(day, datetime):
        return day.strftime("%Y%m%d")
    moment = utc(day)
    if moment.microsecond:
        raise ValueError(f"a run starts at a whole second, not at {moment.isoformat()}")
    return moment.strftime("%Y%m%d%H%M%S" if moment.time() != time.min else "%Y%m%d")


def table_root(root: str, spec: TableSpec) -> str:
    """Source and database are part of the path: equal table names must not meet."""
    return "/".join([root.rstrip("/"), spec.source, spec.database, spec.table])


def snapshot_path(root: str, spec: TableSpec, day: date | datetime) -> str:
    return f"{table_root(root, spec)}/{spec.job}={date_tag(day)}"
