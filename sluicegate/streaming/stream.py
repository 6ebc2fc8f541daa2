"""Streaming sinks: an append log, and a keyed log with its latest-per-key view."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluicegate.functions.columns import named
from sluicegate.functions.schemas import conformed, merged, read_versions
from sluicegate.operators.keyed_base import fold, manifest, read_runs
from sluicegate.operators.latest import latest_state
from sluicegate.session import land
from sluicegate.sources.storage import child_names, completed, create_text, read_text, remove_folder
from sluicegate.streaming.messages import split_messages

# Within a batch's folder, the number of the schema it was written with.
SCHEMA = "_schema-"


def append_stream(
    stream: DataFrame,
    path: str | None,
    checkpoint: str,
    trigger: Mapping[str, Any] | None = None,
    partition_by: Sequence[str] = (),
    sink: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append rows as they come. Each query has a checkpoint of its own, and a restart goes on from it.

    Without a trigger micro-batches follow one another until the query is stopped;
    ``{"availableNow": True}`` takes what is there and ends. ``sink`` may be any streaming sink on
    the class path, with its ``options``; one that is not made of files takes no ``path``.
    """
    writer = stream.writeStream.format(sink).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.options(**(options or {}))
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def sink_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    rejected: str,
    columns: Sequence[str],
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Append the accepted of split messages, in ``columns``, to any sink that takes batches; keep the others below ``rejected``.

    Each micro-batch is read once. Rejected messages replace themselves when a batch is replayed; what the sink makes of
    a row it has got before is its own: a keyed table takes it as the same row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            wrong = batch.where(F.col("status") == "rejected").drop("status")
            wrong.write.mode("overwrite").parquet(f"{_rejected(rejected)}/query={query}/batch_id={batch_id:012d}")
            right = batch.where(F.col("status") == "accepted").select(*named(*columns))
            right.write.format(sink).mode("append").options(**(options or {})).save()
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _log(path: str) -> str:
    return f"{path}/log"


def _rejected(path: str) -> str:
    return f"{path}/rejected"


def _replayed(path: str) -> str:
    return f"{path}/replayed"


def _schemas(path: str) -> str:
    return f"{path}/schemas"


def _number(name: str) -> int:
    return int(name.split("=", 1)[1])


def schema_versions(spark: SparkSession, path: str) -> list[T.StructType]:
    """The ledger: every schema that batches were written with so far, in the order they came up."""
    names = [n for n in child_names(spark, _schemas(path), "version=") if n.endswith(".json")]
    return [T.StructType.fromJson(json.loads(read_text(spark, f"{_schemas(path)}/{n}"))) for n in names]


def schema_version(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """The number of a schema in the ledger, where it is entered if it is new."""
    while True:
        known = schema_versions(spark, path)
        if schema in known:
            return known.index(schema)
        create_text(spark, f"{_schemas(path)}/version={len(known):06d}.json", schema.json())


def _keep(rows: DataFrame, path: str, name: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Write the newest row per key as a batch of the log, with the mark of its schema."""
    spark, folder = rows.sparkSession, f"{_log(path)}/{name}"
    state = latest_state(rows, keys, order)
    state.write.mode("overwrite").parquet(folder)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in state.schema.fields])
    create_text(spark, f"{folder}/{SCHEMA}{schema_version(spark, path, nullable):06d}", "")


def keyed_upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Keep the last write per key, without a table format.

    Each micro-batch is reduced to one row per key and written as ``log/query=ID/batch_id=N``. The write
    replaces that folder, so a batch replayed after a failure replaces itself. The id is the query's, which
    its checkpoint holds: with a new checkpoint batches count from 0 again, below another id. Of messages that went
    through ``split_messages`` the rejected ones are written whole to ``rejected/query=ID/batch_id=N``.
    A query started anew may bring other columns or wider types: each batch says which entry of the schema ledger it has.
    """
    split = {"status", "rejected_text"} <= set(stream.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"query={query}/batch_id={batch_id:012d}"
        if not split:
            _keep(batch, path, folder, keys, order)
            return
        batch.persist()
        try:
            _keep(batch.where(F.col("status") == "accepted").drop("status", "rejected_text"), path, folder, keys, order)
            rejected = batch.where(F.col("status") == "rejected").drop("status")
            rejected.write.mode("overwrite").parquet(f"{_rejected(path)}/{folder}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def _batches(spark: SparkSession, folder: str, covered: Mapping[str, int] | None = None) -> dict[str, int]:
    """Complete batches of all queries beyond the ``covered`` ones: folder name and number."""
    names = []
    for query in child_names(spark, folder, "query="):
        done = (covered or {}).get(query, -1)
        names += [f"{query}/{b}" for b in child_names(spark, f"{folder}/{query}", "batch_id=") if _number(b) > done]
    return {n: _number(n.rpartition("/")[2]) for n in completed(spark, folder, names)}


def _written_with(spark: SparkSession, path: str, folders: Sequence[str]) -> dict[str, T.StructType]:
    """By batch folder, the schema it was written with: by its mark, or from its files where a driver was lost before it
    could set one."""
    known = schema_versions(spark, path)

    def schema(folder: str) -> T.StructType:
        marks = child_names(spark, folder, SCHEMA)
        return known[int(marks[0].removeprefix(SCHEMA))] if marks else spark.read.parquet(folder).schema

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(folders, pool.map(schema, folders)))


def _changes(spark: SparkSession, path: str, batches: Sequence[str]) -> DataFrame:
    """The rows of some batches under one schema that holds the values of all of them."""
    folders = _written_with(spark, path, [f"{_log(path)}/{b}" for b in batches])
    return read_versions(spark, folders, reduce(merged, folders.values()))


def current_state(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row per key over everything written so far, by whatever queries and under whatever schemas."""
    found = manifest(spark, path)
    log = _batches(spark, _log(path), found.covered)
    if not log and found.generation < 0:
        raise FileNotFoundError(f"no completed batch below {path}")
    folders = _written_with(spark, path, [f"{_log(path)}/{b}" for b in log])
    schema = reduce(merged, [*(found.schemas[g] for g in sorted(found.schemas)), *folders.values()])
    rows = read_versions(spark, folders, schema)
    if found.generation >= 0:
        rows = rows.unionByName(conformed(read_runs(spark, path, found, keys), schema))
    return latest_state(rows, keys, order)


def _rejects(spark: SparkSession, path: str) -> DataFrame:
    """Every rejected message with the query and the batch it came in."""
    batches = _batches(spark, _rejected(path))
    if not batches:
        raise FileNotFoundError(f"no completed batch below {_rejected(path)}")
    reader = spark.read.option("basePath", _rejected(path)).option("mergeSchema", True)
    return reader.parquet(*(f"{_rejected(path)}/{b}" for b in batches))


def rejected_messages(spark: SparkSession, path: str) -> DataFrame:
    """Every rejected message so far, with the text it came as."""
    return _rejects(spark, path).drop("query", "batch_id")


def open_rejects(spark: SparkSession, path: str, place: Sequence[str]) -> DataFrame:
    """The rejected messages that no replay has folded back, each known by query, batch and ``place`` (such as its offset)."""
    found, known = _rejects(spark, path), ["query", "batch_id", *place]
    replays = [n for n in completed(spark, _replayed(path), child_names(spark, _replayed(path), "replay="))]
    if not replays:
        return found
    done = spark.read.parquet(*(f"{_replayed(path)}/{n}" for n in replays))
    same = [found[c].eqNullSafe(done[c]) for c in known]
    return found.join(done, same, "left_anti")


def replay_rejects(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    schema: T.StructType,
    repair: Callable[[Column], Column],
    place: Sequence[str],
    required: Sequence[str] = (),
    uuids: Sequence[str] = (),
) -> int:
    """Mend the texts of rejected messages and fold those that are accepted now into the keyed log; how many there were.

    A mended message keeps the order columns it came with, so it does not beat a write that came after it. A ledger
    names the messages that were folded back, by query, batch and ``place``: none is taken twice. The rows are written before
    the ledger; a driver lost in between folds the same rows in once more, which changes nothing. Messages that
    are still rejected stay open.
    """
    carry = ["query", "batch_id", *dict.fromkeys([*place, *order])]
    open_ = open_rejects(spark, path, place)
    texts = open_.select(repair(F.col("rejected_text")).alias("value"), *named(*carry))
    split = split_messages(texts, schema, required, carry, uuids).where("status = 'accepted'").drop("status", "rejected_text")
    name, number = uuid.uuid4().hex, 0
    mended = land(split, f"{_replayed(path)}/_mended-{name}")
    try:
        number = mended.count()
        if number:
            rows = mended.select(*named(*schema.names, *(c for c in order if c not in schema.names)))
            _keep(rows, path, f"query=replay-{name}/batch_id={0:012d}", keys, order)
            mended.select("query", "batch_id", *named(*place)).write.parquet(f"{_replayed(path)}/replay={name}")
    finally:
        remove_folder(spark, f"{_replayed(path)}/_mended-{name}")
    return number


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = 64,
    remove: bool = False,
    **levels: Any,
) -> int:
    """Fold the batches so far into the base; returns its generation.

    The base holds the state by hash bucket of the key, each bucket as runs sorted by key that are merged by size (``fold``,
    which takes ``levels``: ``target_rows``, ``ratio`` and ``least_rows``). A manifest says which runs make up each bucket and up to
    which batch of each query the log is folded, so the work follows the change and not the state. Nothing is overwritten while it is
    read: readers change over with the manifest. ``buckets`` counts for the first compaction; later ones split buckets as the state
    grows. Batches whose columns differ are folded under one schema that holds them all.
    With ``remove`` the folders no longer needed go, which readers that began before would still be
    reading. One compaction runs at a time; a second one raises.
    """
    before = manifest(spark, path)
    log = _batches(spark, _log(path), before.covered)
    if not log:
        if before.generation < 0:
            raise FileNotFoundError(f"no completed batch below {path}")
        return before.generation
    covered = dict(before.covered)
    for name, number in log.items():
        query = name.partition("/")[0]
        covered[query] = max(number, covered.get(query, -1))
    after, free = fold(spark, path, _changes(spark, path, list(log)), keys, order, covered, buckets, **levels)
    if remove:
        for folder in [f"{_log(path)}/{b}" for b in log] + free:
            remove_folder(spark, folder)
    return after.generation
