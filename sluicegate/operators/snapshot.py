"""Dated Parquet snapshots: sized or bucketed, one folder per date, each date rewritten alone."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.schemas import conformed, merged
from sluicegate.operators.buckets import BUCKET_COLUMN
from sluicegate.operators.commits import VERSION, date_folders, new_version, publish, published, versions_root
from sluicegate.sources.storage import child_names, exists, is_complete, remove_folder, replace_folder

LOG = logging.getLogger(__name__)


def sized(df: DataFrame, files: int, filtered: bool = False) -> DataFrame:
    """About ``files`` output files, by the kind of read and not by its size.

    A whole read writes what it reads: it is coalesced, which moves no rows. A ``filtered`` one, such as a day out of a
    long history, reads far more than it writes: its result is rebalanced, and the scan behind it keeps its width.
    """
    return df.hint("rebalance") if filtered else df.coalesce(max(1, files))


def write_rows(
    df: DataFrame,
    target: str,
    files: int,
    rows_per_file: int = 1_000_000,
    buckets: int | None = None,
    filtered: bool = False,
    skip_empty: bool = False,
) -> int:
    """Write a folder that is not there yet; returns the rows, measured during the write.

    Rows are counted after the last shuffle, where a task repeated for a lost executor counts once. Nothing is left of
    a write that breaks off, nor with ``skip_empty`` of one without rows. ``maxRecordsPerFile`` holds the file size whatever
    the task sizes are. Buckets are brought together by a rebalance, which AQE splits again where one bucket is
    too large for a task.
    """
    df = df.hint("rebalance", F.col(BUCKET_COLUMN)) if buckets is not None else sized(df, files, filtered)
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = df.write.option("maxRecordsPerFile", rows_per_file)
    if buckets is not None:
        writer = writer.partitionBy(BUCKET_COLUMN)
    try:
        writer.parquet(target)
    except BaseException:
        remove_folder(df.sparkSession, target)
        raise
    rows = int(written.get["rows"])
    if skip_empty and rows == 0:
        remove_folder(df.sparkSession, target)
    return rows


def write_snapshot(
    df: DataFrame,
    path: str,
    files: int,
    rows_per_file: int = 1_000_000,
    buckets: int | None = None,
    filtered: bool = False,
    skip_empty: bool = False,
) -> int:
    """Replace the snapshot at ``path``; returns the rows written (see ``write_rows``).

    A date that is not there yet is written in its place and counts from its ``_SUCCESS`` on. One that is there stays as it is:
    the new version gets a folder of its own, and a manifest says that the date is read from there (``publish``). No
    data is renamed, and whatever breaks off, the date is the old version or the new one. ``skip_empty`` leaves all
    as it was where there are no rows. A path that is no date (without ``name=``) changes places with the old one instead.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    if "=" not in name:
        beside = f"{parent}/_writing-{name}-{uuid.uuid4().hex}"
        rows = write_rows(df, beside, files, rows_per_file, buckets, filtered, skip_empty)
        if rows or not skip_empty:
            replace_folder(spark, beside, path)
        return rows
    first = name not in published(spark, parent)[1] and not exists(spark, path)
    target = path if first else new_version(parent, name)
    rows = write_rows(df, target, files, rows_per_file, buckets, filtered, skip_empty)
    if not first and (rows or not skip_empty):
        publish(spark, parent, {name: target})
    return rows


def completed_dates(spark: SparkSession, folder: str, job: str) -> list[str]:
    """Date tags whose snapshot was written to the end; those left out are logged."""
    found, unfinished = date_folders(spark, folder, job)
    if unfinished:
        LOG.warning("not complete, left out: %s", ", ".join(f"{folder}/{n}" for n in unfinished))
    return [name.split("=", 1)[1] for name in found]


def has_earlier_date(spark: SparkSession, folder: str, job: str, tag: str) -> bool:
    """Is any date before ``tag`` complete? Looks from the latest back and stops at the first."""
    named, limit = published(spark, folder)[1], f"{job}={tag}"
    if any(p and n.startswith(f"{job}=") and n < limit for n, p in named.items()):
        return True
    earlier = [n for n in child_names(spark, folder, f"{job}=") if n < limit and n not in named]
    return any(is_complete(spark, f"{folder}/{n}") for n in reversed(earlier))


def _read(spark: SparkSession, base: str, folders: list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("basePath", base)
    return (reader if schema is None else reader.schema(schema)).parquet(*folders)


def read_snapshots(
    spark: SparkSession,
    folder: str,
    job: str,
    dates: Iterable[str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The completed snapshots of a table as one frame; the date tag is a bigint and any bucket an int.

    ``merge_schema`` reads each date by the schema it was written with (one footer a date) and casts it to one that holds the
    values of all; it is only needed when columns came, went or widened between dates.
    """
    folder = folder.rstrip("/")
    chosen = completed_dates(spark, folder, job) if dates is None else list(dates)
    if not chosen:
        raise FileNotFoundError(f"no completed snapshot below {folder}")
    named = published(spark, folder)[1]
    plain, versions = [], []
    for name in (f"{job}={d}" for d in chosen):
        (versions if named.get(name) else plain).append(named.get(name) or f"{folder}/{name}")
    places = [(folder, plain), (versions_root(folder), versions)]
    if not merge_schema:
        frames = [_read(spark, base, folders).drop(VERSION) for base, folders in places if folders]
    else:
        with ThreadPoolExecutor(16) as pool:
            found = {base: list(pool.map(lambda f, base=base: _read(spark, base, [f]).schema, folders)) for base, folders in places}
        # The tag and the bucket are read off the folders' names, as whole numbers of whatever width.
        added = (job, BUCKET_COLUMN, VERSION)
        kinds = [T.StructType([f for f in s.fields if f.name not in added]) for schemas in found.values() for s in schemas]
        resolved = reduce(merged, kinds)
        frames = []
        for base, folders in places:
            groups: dict[str, list[int]] = {}
            for i, schema in enumerate(found[base]):
                groups.setdefault(schema.json(), []).append(i)
            for places_ in groups.values():
                df = _read(spark, base, [folders[i] for i in places_], found[base][places_[0]]).drop(VERSION)
                partition = [f for f in df.schema.fields if f.name in added]
                frames.append(conformed(df, T.StructType([*resolved.fields, *partition])))
    numbered = {job: "bigint", BUCKET_COLUMN: "int"}
    frames = [f.withColumns({c: F.col(c).cast(t) for c, t in numbered.items() if c in f.columns}) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=merge_schema), frames)
