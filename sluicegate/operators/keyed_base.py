"""One row per key, folded from changes: buckets that split as the table grows, each of sorted runs that merge by size."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import named
from sluicegate.functions.schemas import conformed, merged, read_versions
from sluicegate.operators.latest import latest_state
from sluicegate.sources.storage import child_names, create_text, read_text

BUCKET, GENERATION = "_bucket", "_generation"
#: Buckets up to this many are named in a filter, more are joined.
LISTED = 1000
#: Beyond so many folders a fold deals small buckets together, until a folder holds so many rows.
FOLDERS = 256
FOLDER_ROWS = 100_000
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Run:
    """Rows of one bucket that one fold wrote, sorted by key, one per key.

    The folder is that of the bucket they were written for, or of one it descends from (``folders_for``). A bucket that
    came of a split shares its parent's runs until they are merged: what lies in them of other buckets is passed over.
    """

    generation: int
    folder: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    """What the table consists of after a fold."""

    generation: int = -1
    first_buckets: int = 0
    buckets: int = 0
    #: By bucket, the newest run first.
    runs: Mapping[int, tuple[Run, ...]] = field(default_factory=dict)
    #: By generation, the schema it was written with, and by how many buckets its folders were dealt.
    schemas: Mapping[int, T.StructType] = field(default_factory=dict)
    counts: Mapping[int, int] = field(default_factory=dict)
    #: What has been folded, in the words of whoever folds.
    covered: Mapping[str, object] = field(default_factory=dict)
    #: Rows written by all folds so far.
    written: int = 0

    @property
    def rows(self) -> int:
        """Rows in all runs; a key that several runs hold counts in each, a shared run by its share."""
        return sum(r.rows for runs in self.runs.values() for r in runs)

    def to_text(self) -> str:
        kinds: list[str] = []
        written_with = {}
        for generation, schema in self.schemas.items():
            text = schema.json()
            if text not in kinds:
                kinds.append(text)
            written_with[generation] = kinds.index(text)
        return json.dumps(
            {
                "generation": self.generation,
                "first_buckets": self.first_buckets,
                "buckets": self.buckets,
                "runs": {b: [[r.generation, r.folder, r.rows] for r in runs] for b, runs in self.runs.items()},
                "schemas": [json.loads(k) for k in kinds],
                "written_with": written_with,
                "counts": dict(self.counts),
                "covered": dict(self.covered),
                "written": self.written,
            }
        )


def _manifest_folder(path: str) -> str:
    return f"{path}/manifest"


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest one; an empty one where nothing has been folded yet."""
    names = [n for n in child_names(spark, _manifest_folder(path), "") if n.endswith(".json")]
    if not names:
        return Manifest()
    found = json.loads(read_text(spark, f"{_manifest_folder(path)}/{names[-1]}"))
    kinds = [T.StructType.fromJson(k) for k in found["schemas"]]
    return Manifest(
        found["generation"],
        found["first_buckets"],
        found["buckets"],
        {int(b): tuple(Run(*r) for r in runs) for b, runs in found["runs"].items()},
        {int(g): kinds[k] for g, k in found["written_with"].items()},
        {int(g): n for g, n in found["counts"].items()},
        found["covered"],
        found["written"],
    )


def bucket_of(keys: Sequence[str], first: int, buckets: int) -> Column:
    """The bucket of a key by linear hashing: with one bucket more, one bucket's keys are dealt anew and no other's.

    Keys are hashed by their text, so that a whole number which widens stays where it is.
    """
    low = _round(first, buckets)
    hashed = F.xxhash64(*(c.cast("string") for c in named(*keys)))
    place = F.pmod(hashed, F.lit(2 * low).cast("bigint"))
    return F.when(place >= buckets, place - low).otherwise(place).cast("int")


def _round(first: int, buckets: int) -> int:
    """How many buckets there were when the current round of splits began."""
    low = first
    while 2 * low <= buckets:
        low *= 2
    return low


def parent_of(bucket: int, first: int) -> int:
    """The bucket whose keys the new ``bucket`` takes over in part."""
    return bucket - _round(first, bucket)


def ancestors(first: int, count: int, buckets: int) -> list[int]:
    """By bucket, the one that held its keys when there were ``count`` buckets."""
    out = list(range(count))
    for bucket in range(count, buckets):
        out.append(out[parent_of(bucket, first)])
    return out


def folders_for(rows: int, first: int, count: int) -> int:
    """By how many buckets to deal the folders of a fold that writes so many rows. Each bucket has its own up to
    ``FOLDERS``; beyond that, buckets of few rows share the folder of the one they descend from, as if they had been split off since:
    files then grow in number with the rows and not with the buckets."""
    return min(count, max(first, FOLDERS, -(-rows // FOLDER_ROWS)))


def split(runs: Mapping[int, tuple[Run, ...]], first: int, buckets: int, wanted: int) -> dict[int, tuple[Run, ...]]:
    """The runs by bucket when there are ``wanted`` buckets instead of ``buckets``. No row is written: a new bucket
    takes its parent's runs over, each counted by half from then on."""
    out = dict(runs)
    for bucket in range(buckets, wanted):
        parent = parent_of(bucket, first)
        if parent in out:
            halves = tuple(Run(r.generation, r.folder, -(-r.rows // 2)) for r in out[parent])
            out[parent] = out[bucket] = halves
    return out


def merging(rows: int, runs: Sequence[Run], ratio: float, least_rows: int) -> int:
    """How many of a bucket's newest runs the new rows are merged with: each that is no more than ``ratio`` times what is merged
    so far, or small. A row is then written anew only when its run grows by a share, so the logarithm of the table's size often."""
    taken, size = 0, rows
    for run in runs:
        if run.rows > max(ratio * size, least_rows):
            break
        taken, size = taken + 1, size + run.rows
    return taken


def _folder(path: str, generation: int, folder: int) -> str:
    return f"{path}/base/generation={generation:012d}/{BUCKET}={folder}"


def _holders(found: Manifest) -> dict[tuple[int, int], set[int]]:
    """By folder, the buckets whose keys can lie in it: its own, and those that share it or have been split off since."""
    out = {(r.generation, r.folder): {r.folder} for runs in found.runs.values() for r in runs}
    by_count: dict[int, list[int]] = {}
    for generation in {g for g, _ in out}:
        by_count.setdefault(found.counts[generation], []).append(generation)
    for count, generations in by_count.items():
        for bucket, folder in enumerate(ancestors(found.first_buckets, count, found.buckets)):
            for generation in generations:
                if (generation, folder) in out:
                    out[generation, folder].add(bucket)
    return out


def _rows_in(
    spark: SparkSession, path: str, found: Manifest, wanted: Mapping[tuple[int, int], set[int]], keys: Sequence[str], schema: T.StructType
) -> DataFrame:
    """The rows of some folders, of those buckets that are wanted of each. One that several buckets share may hold rows
    of buckets that have let go of it; a filter is laid over such folders alone, by generation and bucket."""
    holders = _holders(found)

    def read(chosen: Iterable[tuple[int, int]], more: Mapping[str, Column] | None = None) -> DataFrame:
        return read_versions(spark, {_folder(path, *f): found.schemas[f[0]] for f in chosen}, schema, more)

    shared = [f for f, buckets in wanted.items() if not holders[f] <= buckets]
    rows = read(f for f in wanted if f not in set(shared))
    if not shared:
        return rows
    allowed = sorted({(f[0], b) for f in shared for b in wanted[f]})
    place = F.regexp_extract("_metadata.file_path", rf"/generation=(\d+)/{BUCKET}=\d+/[^/]*$", 1).cast("bigint")
    some = read(shared, {GENERATION: place}).withColumn(BUCKET, bucket_of(keys, found.first_buckets, found.buckets))
    if len(allowed) <= LISTED:
        by_generation: dict[int, list[int]] = {}
        for generation, bucket in allowed:
            by_generation.setdefault(generation, []).append(bucket)
        named_ = [(F.col(GENERATION) == g) & F.col(BUCKET).isin(of) for g, of in by_generation.items()]
        some = some.where(reduce(Column.__or__, named_))
    else:
        listed = spark.createDataFrame(allowed, f"{GENERATION} bigint, {BUCKET} int")
        some = some.join(listed, [GENERATION, BUCKET], "left_semi")
    return rows.unionByName(some.drop(GENERATION, BUCKET))


def _resolved(found: Manifest, *more: T.StructType) -> T.StructType:
    """One schema for all runs and whatever is to be folded."""
    schemas = [found.schemas[g] for g in sorted(found.schemas)] + list(more)
    out = schemas[0]
    for schema in schemas[1:]:
        out = merged(out, schema)
    return out


def read_runs(
    spark: SparkSession, path: str, found: Manifest, keys: Sequence[str], buckets: Iterable[int] | None = None
) -> DataFrame:
    """The rows in the runs of some buckets, or of all: one or more a key."""
    chosen = set(found.runs) if buckets is None else set(buckets) & set(found.runs)
    wanted: dict[tuple[int, int], set[int]] = {}
    for b in chosen:
        for r in found.runs[b]:
            wanted.setdefault((r.generation, r.folder), set()).add(b)
    return _rows_in(spark, path, found, wanted, keys, _resolved(found))


def fold(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    covered: Mapping[str, object],
    buckets: int = 64,
    target_rows: int = 1_000_000,
    ratio: float = 2.0,
    least_rows: int = 10_000,
    gone: Column | None = None,
    rebuilt: DataFrame | None = None,
) -> tuple[Manifest, list[str]]:
    """Merge ``changes`` into the table below ``path``; the new manifest, and the folders it no longer needs.

    Per bucket the changes become a run, merged with those older runs that ``merging`` picks; other runs and buckets stay
    as they are, so the work follows the change. Beyond ``target_rows`` rows a bucket on average, buckets are
    split until they are below it, without writing anything. ``buckets`` counts for the first fold. Many small
    buckets are written to few folders (``folders_for``).
    Rows that ``gone`` holds for are dropped from all buckets that ``changes`` or the keys of ``rebuilt`` touch; these
    buckets are merged whole. Schemas are resolved: columns may come, go and widen; a key only among whole numbers.

    Nothing is overwritten while it is read: readers change over with the manifest, which is made if there is none of its number. Of two
    folds at once the later one raises and leaves the table as the first one made it.
    """
    before = manifest(spark, path)
    first = before.first_buckets or buckets
    count = before.buckets or buckets
    schema = _resolved(before, changes.schema)
    for key in keys:
        kinds = [s[key].dataType for s in (*before.schemas.values(), changes.schema)]
        if any(k != kinds[0] for k in kinds) and not all(type(k) in WHOLE for k in kinds):
            raise ValueError(f"key {key!r} changed from {kinds[0].simpleString()} to {kinds[-1].simpleString()}")
    changes = conformed(changes, schema)
    bucket = bucket_of(keys, first, count)
    touched = {b: n for b, n in changes.groupBy(bucket.alias(BUCKET)).count().collect()}
    if rebuilt is not None:
        for (b,) in rebuilt.select(bucket.alias(BUCKET)).distinct().collect():
            touched.setdefault(b, 0)
    generation = before.generation + 1
    taken = {}
    for b, rows in touched.items():
        runs = before.runs.get(b, ())
        taken[b] = merging(rows, runs, ratio, least_rows) if gone is None else len(runs)
    wanted_of: dict[tuple[int, int], set[int]] = {}
    for b, n in taken.items():
        for r in before.runs.get(b, ())[:n]:
            wanted_of.setdefault((r.generation, r.folder), set()).add(b)
    old = _rows_in(spark, path, before, wanted_of, keys, schema)
    if gone is not None:
        old = old.where(~F.coalesce(gone, F.lit(False)))
    written: dict[int, int] = {}
    at_most = sum(rows + sum(r.rows for r in before.runs.get(b, ())[: taken[b]]) for b, rows in touched.items())
    dealt_by = folders_for(at_most, first, count)
    if touched:
        state = latest_state(changes.unionByName(old), keys, order).withColumn(BUCKET, bucket_of(keys, first, dealt_by))
        folder = f"{path}/base/generation={generation:012d}"
        dealt = state.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *named(*keys))
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        if child_names(spark, folder, BUCKET):
            dealt = spark.read.schema(schema).parquet(folder)
            written = {b: n for b, n in dealt.groupBy(bucket.alias(BUCKET)).count().collect()}

    runs, folder_of = dict(before.runs), ancestors(first, dealt_by, count)
    for b, n in taken.items():
        new = (Run(generation, folder_of[b], written[b]),) if b in written else ()
        runs[b] = new + before.runs.get(b, ())[n:]
        if not runs[b]:
            del runs[b]
    total = sum(r.rows for of in runs.values() for r in of)
    wanted = max(count, -(-total // target_rows))
    runs = split(runs, first, count, wanted)
    used = {r.generation for of in runs.values() for r in of}
    used.add(generation)
    schemas = {g: s for g, s in (dict(before.schemas) | {generation: schema}).items() if g in used}
    counts = {g: n for g, n in (dict(before.counts) | {generation: dealt_by}).items() if g in used}
    after = Manifest(generation, first, wanted, runs, schemas, counts, dict(covered), before.written + sum(written.values()))
    if not create_text(spark, f"{_manifest_folder(path)}/{generation:012d}.json", after.to_text()):
        raise RuntimeError(f"another fold of {path} was faster")
    still = {(r.generation, r.folder) for of in runs.values() for r in of}
    free = {(r.generation, r.folder) for of in before.runs.values() for r in of} - still
    return after, [_folder(path, *f) for f in sorted(free)]


def rows_of(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The current rows of the keys in ``wanted``; reads only the buckets they belong to."""
    found = manifest(spark, path)
    bucket = bucket_of(keys, found.first_buckets, found.buckets)
    asked = wanted.select(*named(*keys)).distinct()
    touched = [r[0] for r in asked.select(bucket.alias(BUCKET)).distinct().collect()]
    rows = read_runs(spark, path, found, keys, touched)
    met = rows.join(asked, [rows[k].eqNullSafe(asked[k]) for k in keys], "left_semi")
    return latest_state(met, keys, order)
