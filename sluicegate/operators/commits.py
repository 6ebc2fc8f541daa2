"""Which folder holds each date of a table: numbered manifests, each made once and whole."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from sluicegate.sources.storage import child_names, completed, create_text, modified, read_text, remove_folder

VERSION = "version"
KEPT = 10


def _side(folder: str) -> str:
    """Manifests and rewritten dates lie beside the table's folder, which holds dates as they were first written."""
    parent, _, name = folder.rstrip("/").rpartition("/")
    return f"{parent}/_snapshots/{name}"


def _log(folder: str) -> str:
    return f"{_side(folder)}/log"


def versions_root(folder: str) -> str:
    return f"{_side(folder)}/versions"


def new_version(folder: str, name: str) -> str:
    """A folder of its own for one more version of a date; nothing is created yet."""
    return f"{versions_root(folder)}/{name}/{VERSION}={uuid.uuid4().hex}"


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in child_names(spark, _log(folder), "") if n.endswith(".json")]


def published(spark: SparkSession, folder: str) -> tuple[int, dict[str, str | None]]:
    """The number of the newest manifest (-1 for none) and the folder of each date it names; None for one withdrawn."""
    names = _manifests(spark, folder)
    if not names:
        return -1, {}
    found = json.loads(read_text(spark, f"{_log(folder)}/{names[-1]}"))
    parent = folder.rstrip("/").rpartition("/")[0]
    return int(names[-1].removesuffix(".json")), {n: p and f"{parent}/{p}" for n, p in found.items()}


def publish(spark: SparkSession, folder: str, changes: Mapping[str, str | None]) -> int:
    """Let dates be read from other folders from now on, all of them at once; the manifest's number.

    A manifest holds all that the one before it says and the changes. It is made only if nobody else made one of
    its number; otherwise the changes are laid over that one. Until it is there, readers see every date as it was.
    """
    parent = folder.rstrip("/").rpartition("/")[0] + "/"
    short = {n: p and p.removeprefix(parent) for n, p in changes.items()}
    while True:
        number, named = published(spark, folder)
        known = {n: p and p.removeprefix(parent) for n, p in named.items()}
        text = json.dumps(known | short, sort_keys=True)
        if create_text(spark, f"{_log(folder)}/{number + 1:012d}.json", text):
            return number + 1


def date_folders(spark: SparkSession, folder: str, job: str) -> tuple[dict[str, str], list[str]]:
    """The folder of each date that is there, by its name in order; and those names whose write was not finished."""
    _, named = published(spark, folder)
    plain = [n for n in child_names(spark, folder, f"{job}=") if n not in named]
    whole = completed(spark, folder, plain)
    found = {n: f"{folder}/{n}" for n in whole}
    found |= {n: p for n, p in named.items() if p is not None and n.startswith(f"{job}=")}
    return dict(sorted(found.items())), [n for n in plain if n not in found]


def clean(spark: SparkSession, folder: str, older_than_hours: float = 24.0) -> list[str]:
    """Remove what no reader asks for any more: versions that the newest manifest does not name, dates it has replaced or withdrawn,
    writes that were not finished, and all but the last manifests. What has changed within the given hours stays:
    its writer may be at work, and readers that began before may be reading it. Returns what was removed."""
    number, named = published(spark, folder)
    used = {p for p in named.values() if p}
    root = versions_root(folder)
    found = [f"{root}/{n}/{v}" for n in child_names(spark, root, "") for v in child_names(spark, f"{root}/{n}", f"{VERSION}=")]
    plain = [n for n in child_names(spark, folder, "") if "=" in n]
    whole = set(completed(spark, folder, plain))
    found += [f"{folder}/{n}" for n in plain if n in named or n not in whole]
    names = _manifests(spark, folder)
    found += [f"{_log(folder)}/{n}" for n in names[:-KEPT]]
    found += [f"{_log(folder)}/{n}" for n in child_names(spark, _log(folder), "_new-")]
    latest = time.time() * 1000 - older_than_hours * 3_600_000
    old = [p for p in found if p not in used and modified(spark, p) <= latest]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda p: remove_folder(spark, p), old))
    return old
