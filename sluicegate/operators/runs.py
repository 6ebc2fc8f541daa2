"""Which intervals of a dated table have been extracted: the ledger of runs, and what follows from it."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.intervals import gaps, islands, overlaps
from sluicegate.operators.commits import date_folders
from sluicegate.operators.latest import latest_state
from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import date_tag, table_root, timestamp_text, utc
from sluicegate.sources.storage import child_names, create_text

SCHEMA = "tag string, since timestamp_ntz, until timestamp_ntz, rows bigint, recorded timestamp_ntz, number string"
# Before any row.
BEGINNING = "0001-01-01 00:00:00"


def runs_root(root: str, spec: TableSpec) -> str:
    return table_root(f"{root.rstrip('/')}/_runs", spec)


def record_run(
    spark: SparkSession, root: str, spec: TableSpec, start: datetime, since: datetime | None, until: datetime | None, rows: int
) -> None:
    """Enter what a run has read: from ``since`` (None: from the beginning) to ``until`` (None: whatever there was).

    It is entered when its date has been published. A driver lost in between leaves an interval that counts as
    missing, and reading it once more replaces that date.
    """
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    entry = {
        "tag": date_tag(start),
        "since": timestamp_text(since) if since else BEGINNING,
        "until": timestamp_text(until) if until else None,
        "rows": rows,
        "recorded": now.isoformat(sep=" "),
        "number": uuid.uuid4().hex,
    }
    create_text(spark, f"{runs_root(root, spec)}/{entry['tag']}-{entry['number']}.json", json.dumps(entry))


def runs(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The last run of each date that is still there, or that found no rows: ``tag, since, until, rows``.

    A run without an end counts up to the moment it was entered.
    """
    folder = runs_root(root, spec)
    names = [n for n in child_names(spark, folder, "") if n.endswith(".json")]
    if not names:
        return spark.createDataFrame([], "tag string, since timestamp_ntz, until timestamp_ntz, rows bigint")
    # By file: Spark takes two reads of one folder for the same, also when entries have come in between.
    reader = spark.read.schema(SCHEMA).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    entered = reader.json([f"{folder}/{n}" for n in names])
    last = latest_state(entered, ["tag"], ["recorded", "number"])
    there = [n.split("=", 1)[1] for n in date_folders(spark, table_root(root, spec), spec.job)[0]]
    last = last.where(F.col("tag").isin(there) | (F.col("rows") == 0))
    return last.select("tag", "since", F.coalesce("until", "recorded").alias("until"), "rows")


def covered(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """What has been extracted: disjoint intervals, and how many runs each is made of."""
    return islands(runs(spark, root, spec))


def read_twice(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """What more than one date holds, and how many do."""
    return overlaps(runs(spark, root, spec))


def missing(spark: SparkSession, root: str, spec: TableSpec, low: datetime, high: datetime) -> list[tuple[datetime, datetime]]:
    """The intervals from ``low`` to ``high`` that no run covers, in order; all of it where there has been none."""
    found = runs(spark, root, spec)
    if found.isEmpty():
        return [(utc(low), utc(high))] if utc(low) < utc(high) else []
    ends = (F.lit(timestamp_text(m)).cast("timestamp_ntz") for m in (low, high))
    return sorted((r["since"], r["until"]) for r in gaps(found, *ends).collect())


def next_interval(spark: SparkSession, root: str, spec: TableSpec, low: datetime, high: datetime) -> tuple[datetime, datetime] | None:
    """The first missing interval up to ``high``: a gap where there is one, else what has come since the last run."""
    open_ = missing(spark, root, spec, low, high)
    return open_[0] if open_ else None


def whole_seconds(interval: tuple[datetime, datetime]) -> tuple[datetime, datetime]:
    """The interval with its ends moved outwards to whole seconds, which dates are named by."""
    since, until = interval
    begin = since.replace(microsecond=0)
    end = until.replace(microsecond=0)
    return begin, end if end == until else end + timedelta(seconds=1)
