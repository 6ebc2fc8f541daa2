"""The current rows of a table, kept up by what its dates change."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.functions.columns import named
from sluicegate.operators.buckets import BUCKET_COLUMN
from sluicegate.operators.commits import date_folders
from sluicegate.operators.keyed_base import Manifest, fold, manifest, read_runs
from sluicegate.operators.latest import MOMENT, latest_order, latest_state, with_moment
from sluicegate.operators.snapshot import read_snapshots
from sluicegate.plans.spec import TableSpec
from sluicegate.plans.strategy import table_root
from sluicegate.sources.storage import modified, remove_folder

#: The version of the date that a row came with, as it is numbered in the ledger.
VERSION = "_version"
NOTHING: Mapping[str, Any] = {"dates": {}, "numbers": {}, "next": 0, "dead": []}


def base_root(root: str, spec: TableSpec) -> str:
    return table_root(f"{root.rstrip('/')}/_latest", spec)


def _identities(spark: SparkSession, folder: str, job: str) -> dict[str, str]:
    """By date name, what tells one version of it from another: its folder and when that was completed."""
    found = date_folders(spark, folder, job)[0]

    def identity(path: str) -> str:
        return f"{path.removeprefix(folder)}@{modified(spark, f'{path}/_SUCCESS')}"

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(found, pool.map(identity, found.values())))


def _versions(spark: SparkSession, folder: str, job: str, numbers: Mapping[str, int], names: Iterable[str]) -> DataFrame:
    """The rows of some dates with the moment and the version they came with."""
    tags = [n.split("=", 1)[1] for n in names]
    rows = with_moment(read_snapshots(spark, folder, job, tags, merge_schema=True).drop(BUCKET_COLUMN), job)
    of = F.create_map(*(F.lit(x) for t in tags for x in (int(t), numbers[f"{job}={t}"])))
    return rows.withColumn(VERSION, of[F.col(job)]).drop(job)


def refresh_latest(spark: SparkSession, root: str, spec: TableSpec, remove: bool = False, **levels: Any) -> list[str]:
    """Fold the dates of a table that are new, rewritten or withdrawn into its current rows; their names.

    A ledger says which version of each date has been folded. A new date is read and merged into the buckets its keys
    belong to (``fold``, which takes ``levels``); no other date is read. Of a date that has been rewritten or
    withdrawn, the rows that are current are looked up in the base, and their keys alone are worked out anew
    over the other dates. The result equals ``latest_table`` (see ``read_latest``). One refresh of a table runs at a time; a second one raises.
    With ``remove`` the folders no longer needed go, which readers that began before would still be reading.
    """
    if not spec.primary_key:
        raise ValueError(f"{spec.table}: the latest rows are by primary key, and the table names none")
    folder, path, job = table_root(root, spec), base_root(root, spec), spec.job
    keys, order = list(spec.primary_key), latest_order(spec)
    before = manifest(spark, path)
    ledger = dict(NOTHING) | dict(before.covered)
    now, known = _identities(spark, folder, job), ledger["dates"]
    redone = [n for n in known if now.get(n) != known[n]]
    fresh = [n for n in now if n not in known or n in redone]
    if not fresh and not redone:
        return []
    numbers = {n: k for n, k in ledger["numbers"].items() if n in now and n not in redone}
    same = list(numbers)
    numbers |= {n: ledger["next"] + i for i, n in enumerate(fresh)}
    dead = [*ledger["dead"], *(ledger["numbers"][n] for n in redone)]
    covered = {"dates": now, "numbers": numbers, "next": ledger["next"] + len(fresh), "dead": dead}

    changes = _versions(spark, folder, job, numbers, fresh) if fresh else None
    stale = gone = None
    if redone:
        # A row that is not current may stay: what outdoes it would have to go first, and then its bucket is merged whole.
        gone = F.col(VERSION).isin(dead)
        stale = latest_state(_slim(spark, path, before, keys, order), keys, order).where(gone).select(*named(*keys))
        if same:
            rows = _versions(spark, folder, job, numbers, same)
            anew = rows.join(stale.distinct(), [rows[k].eqNullSafe(stale[k]) for k in keys], "left_semi")
            changes = anew if changes is None else changes.unionByName(anew, allowMissingColumns=True)
    if changes is None:
        changes = read_runs(spark, path, before, keys).limit(0)
    _, free = fold(spark, path, changes, keys, order, covered, gone=gone, rebuilt=stale, **levels)
    for unused in free if remove else ():
        remove_folder(spark, unused)
    return sorted({*fresh, *redone})


def _slim(spark: SparkSession, path: str, found: Manifest, keys: list[str], order: list[str]) -> DataFrame:
    """Of the base only what says which rows are current, and which version they came with."""
    return read_runs(spark, path, found, keys).select(*named(*dict.fromkeys([*keys, *order, VERSION])))


def read_latest(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The current rows as of the last refresh."""
    path = base_root(root, spec)
    found = manifest(spark, path)
    if found.generation < 0:
        raise FileNotFoundError(f"no refresh below {path}")
    keys = list(spec.primary_key)
    return latest_state(read_runs(spark, path, found, keys), keys, latest_order(spec)).drop(MOMENT, VERSION)
