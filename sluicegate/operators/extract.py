"""Extraction of one table, or of every table in a list, into dated snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from sluicegate.operators.buckets import with_bucket
from sluicegate.operators.commits import new_version, publish
from sluicegate.operators.runs import missing, record_run, whole_seconds
from sluicegate.operators.snapshot import has_earlier_date, write_rows, write_snapshot
from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import date_tag, file_count, layout, read_strategy, snapshot_path, table_root
from sluicegate.sources.base import Source, count_rows


@dataclass(frozen=True)
class ExtractResult:
    spec: TableSpec
    strategy: str
    layout: str
    first_run: bool
    written: bool
    rows: int
    files: int
    path: str | None


def extract_table(
    spark: SparkSession,
    source: Source,
    spec: TableSpec,
    start: datetime,
    root: str,
    end: datetime | None = None,
    hash_method: str = "xxhash64",
) -> ExtractResult:
    """Read the table as its spec asks and replace the snapshot of the start date.

    A run is the first one while no earlier date is complete: it takes the whole table, unless the
    spec says ``since_start``. So a rerun of the first date takes the whole table again, and a date
    that broke off is not mistaken for history. With an ``end`` the intervals of successive runs are
    disjoint, the first one reaching back without limit. One count decides emptiness and file count;
    an empty extract writes nothing.
    """
    first = not has_earlier_date(spark, table_root(root, spec), spec.job, date_tag(start))
    path = snapshot_path(root, spec, start)
    result = _extract(source, spec, start, end, first, path, path, write_snapshot, hash_method)
    _record(spark, root, start, end, result)
    return result


def extract_days(
    spark: SparkSession,
    source: Source,
    spec: TableSpec,
    starts: Sequence[datetime],
    root: str,
    end: datetime | None = None,
    hash_method: str = "xxhash64",
) -> list[ExtractResult]:
    """Several dates of a table, each up to the next one's start and the last up to ``end``, published at once.

    Readers see all of them or, until then and after a failure, what there was before: none of the dates is visible
    by itself. A date without rows keeps what it had.
    """
    folder, staged, results = table_root(root, spec), {}, []
    earlier = has_earlier_date(spark, folder, spec.job, date_tag(min(starts)))
    for start, until in zip(sorted(starts), [*sorted(starts)[1:], end]):
        path = snapshot_path(root, spec, start)
        name = path.rpartition("/")[2]
        target = new_version(folder, name)
        result = _extract(source, spec, start, until, not earlier, path, target, write_rows, hash_method)
        results.append(result)
        if result.written:
            staged[name], earlier = target, True
    if staged:
        publish(spark, folder, staged)
    for start, until, result in zip(sorted(starts), [*sorted(starts)[1:], end], results):
        _record(spark, root, start, until, result)
    return results


def extract_missing(
    spark: SparkSession,
    source: Source,
    spec: TableSpec,
    low: datetime,
    high: datetime,
    root: str,
    hash_method: str = "xxhash64",
) -> list[ExtractResult]:
    """Whatever of ``low`` to ``high`` no run has read yet, an interval a date: gaps that runs left or lost, and what has come since.

    The ledger of runs says what is missing (``runs.missing``); where nothing is, nothing is read.
    """
    if read_strategy(spec) != "incremental":
        raise ValueError(f"{spec.table}: only a dated table has intervals that can be missing")
    open_ = [whole_seconds(i) for i in missing(spark, root, spec, low, high)]
    return [extract_table(spark, source, spec, since, root, until, hash_method) for since, until in open_]


def _record(spark: SparkSession, root: str, start: datetime, end: datetime | None, result: ExtractResult) -> None:
    """Enter a dated table's run. One without rows is entered too: its interval has been read."""
    if result.strategy != "incremental":
        return
    since = None if result.first_run and result.spec.initial == "all" else start
    record_run(spark, root, result.spec, start, since, end, result.rows)


def _extract(
    source: Source,
    spec: TableSpec,
    start: datetime,
    end: datetime | None,
    first: bool,
    path: str,
    target: str,
    write: Callable,
    hash_method: str,
) -> ExtractResult:
    """One date, read as its spec asks and written to ``target``."""
    strategy, shape = read_strategy(spec), layout(spec)
    whole = strategy != "incremental" or (first and spec.initial == "all")
    since = None if whole else start
    until = end if strategy == "incremental" else None

    rows = count_rows(source, spec, since, until)
    files = file_count(rows, spec.rows_per_file)
    if files == 0:
        return ExtractResult(spec, strategy, shape, first, False, 0, 0, None)

    # Strides of a split column may go by the size of the whole table, other pieces by what is read.
    total = rows if not spec.partition_column or (since is None and until is None) else None
    df = source.read(spec, source.split(spec, total, since, until), since, until)
    if shape == "bucketed":
        df = with_bucket(df, spec.bucket_key, spec.buckets, hash_method)
        written = write(df, target, files, spec.rows_per_file, spec.buckets)
    else:
        filtered = since is not None or until is not None
        written = write(df, target, files, spec.rows_per_file, filtered=filtered)
    return ExtractResult(spec, strategy, shape, first, True, written, files, path)


def extract_all(
    spark: SparkSession,
    source_of: Callable[[TableSpec], Source],
    specs: Iterable[TableSpec],
    start: datetime,
    root: str,
    end: datetime | None = None,
    at_once: int = 4,
    hash_method: str = "xxhash64",
) -> list[ExtractResult]:
    """Extract every table, a few at a time on one session; results in the order of the list.

    The threads only submit Spark jobs. A table that fails does not stop the others; it raises once
    they have finished.
    """
    specs = list(specs)
    places = [(table_root(root, s), s.job) for s in specs]
    if len(set(places)) < len(places):
        raise ValueError("a table is listed twice: its snapshots would replace each other")

    def run(spec: TableSpec) -> ExtractResult:
        return extract_table(spark, source_of(spec), spec, start, root, end, hash_method)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        pending = [pool.submit(inheritable_thread_target(spark)(run), spec) for spec in specs]
    failed = {spec.table: p.exception() for spec, p in zip(specs, pending) if p.exception()}
    if failed:
        raise RuntimeError(f"not extracted: {', '.join(failed)}") from next(iter(failed.values()))
    return [p.result() for p in pending]
