"""Do two tables hold the same rows? Checksums of key ranges, taken apart only where they differ."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions.columns import named
from sluicegate.functions.schemas import conformed, merged

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
SUMS = ("n", "a", "b")


@dataclass(frozen=True)
class Round:
    """The ranges of a key, first and last, that differ, the rows of both sides in them, and whether rows without a key do."""

    ranges: tuple[tuple[int, int], ...]
    rows: int
    missing_keys: bool


def _plain(df: DataFrame) -> list[Column]:
    """Columns that can be hashed and grouped by: a map, which has no order of its own, as its sorted entries."""
    return [
        F.array_sort(F.map_entries(c)).alias(f.name) if isinstance(f.dataType, T.MapType) else c
        for f, c in zip(df.schema.fields, named(*df.columns))
    ]


def _digests(df: DataFrame) -> list[Column]:
    """Two hashes of a whole row, NULLs told apart by their places. Sums of them do not depend on the order of rows, and
    see a row that is there twice."""
    parts = [x for c in _plain(df) for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(i), *parts).cast("decimal(38,0)") for i in (1, 2)]


def _place(df: DataFrame, key: str) -> Column:
    """Where a row lies: a whole-number key itself, so that ranges reach the scan; any other key by its hash."""
    column = named(key)[0]
    if isinstance(df.schema[key].dataType, WHOLE):
        return column.cast("bigint")
    return F.when(column.isNotNull(), F.xxhash64(column))


def _within(df: DataFrame, key: str, ranges: Sequence[tuple[int, int]], missing_keys: bool) -> DataFrame:
    place = _place(df, key)
    inside = [(place >= a) & (place <= b) for a, b in ranges]
    return df.where(reduce(Column.__or__, inside + ([place.isNull()] if missing_keys else []), F.lit(False)))


def _sums(df: DataFrame, key: str, low: int, width: int) -> DataFrame:
    first, second = _digests(df)
    far = (_place(df, key).cast("decimal(38,0)") - F.lit(low).cast("decimal(38,0)")).cast("decimal(38,0)")
    # By where a range begins, as keys can lie further apart than a bigint holds.
    begin = (far - far % F.lit(width).cast("decimal(38,0)")).cast("decimal(38,0)")
    rows = df.select(begin.alias("at"), first.alias("_a"), second.alias("_b"))
    return rows.groupBy("at").agg(F.count("*").alias("n"), F.sum("_a").alias("a"), F.sum("_b").alias("b"))


def differing_ranges(
    source: DataFrame, snapshot: DataFrame, key: str, leaf_rows: int = 100_000, first: int = 256, radix: int = 16
) -> list[Round]:
    """The rounds of comparing checksums of key ranges, the last of which tells where the tables differ.

    The first round compares ``first`` ranges; each further one takes those apart that differ, by ``radix``, and reads no others, until
    they hold ``leaf_rows`` rows in all or are single keys, or a round has not halved what is left to read: damage that lies
    everywhere is not narrowed down any further. With a whole-number key ranges are filters on it that a scan or a database
    can use. The driver gets two numbers a differing range; more than 400 in one round are read as one range
    each from the first to the last of a stretch, which costs reading and loses nothing.
    """
    ends = [df.select(_place(df, key).alias("p")).agg(F.min("p"), F.max("p")).first() for df in (source, snapshot)]
    known = [e for e in ends if e[0] is not None]
    low, high = (min(e[0] for e in known), max(e[1] for e in known)) if known else (0, 0)
    width = -(-(high - low + 1) // first)
    ranges: list[tuple[int, int]] = [(low, high)]
    missing_keys, rounds = True, []
    while True:
        sums = [
            _sums(_within(df, key, ranges, missing_keys and not rounds), key, low, width).select("at", *(F.col(c).alias(f"{c}{i}") for c in SUMS))
            for i, df in enumerate((source, snapshot))
        ]
        met = sums[0].join(sums[1], sums[0]["at"].eqNullSafe(sums[1]["at"]), "full")
        same = reduce(Column.__and__, (F.col(f"{c}0").eqNullSafe(F.col(f"{c}1")) for c in SUMS))
        rows = F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))
        at = F.coalesce(sums[0]["at"], sums[1]["at"])
        unequal = met.where(~same).select(at.alias("at"), rows.alias("rows")).collect()
        wrong = sorted(low + int(r["at"]) for r in unequal if r["at"] is not None)
        if not rounds:
            missing_keys = any(r["at"] is None for r in unequal)
        ranges = _stretches([(w, min(high, w + width - 1)) for w in wrong])
        before = rounds[-1].rows if rounds else None
        rounds.append(Round(tuple(ranges), sum(r["rows"] for r in unequal if r["at"] is not None), missing_keys))
        read = rounds[-1].rows
        if not ranges or width == 1 or read <= leaf_rows or (before is not None and read > before / 2):
            return rounds
        width = max(1, width // radix)


def _stretches(ranges: list[tuple[int, int]], most: int = 400) -> list[tuple[int, int]]:
    """Neighbours as one; and where there are more than ``most``, those that lie closest together too."""
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and out[-1][1] + 1 == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    if len(out) <= most:
        return out
    apart = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1], reverse=True)
    begins = [0, *sorted(apart[: most - 1]), len(out)]
    return [(out[i][0], out[j - 1][1]) for i, j in zip(begins, begins[1:])]


def reconcile(
    source: DataFrame, snapshot: DataFrame, key: str, watch: Callable[[Round], None] | None = None, **rounds: int
) -> DataFrame:
    """The rows in which two tables differ, by key: ``kind``, how often the row is ``in_source`` and ``in_snapshot``, and the row.

    ``lost`` keys are in the source alone and ``extra`` ones in the snapshot alone. Of a key that both have, a row that comes on both
    sides but not as often is ``doubled`` or ``thinned``, and any other ``changed``. Only key ranges whose checksums differ are read
    row by row (``differing_ranges``, which takes ``rounds``); checksums are two sums of 64-bit hashes and a count. Columns are compared
    by name under one schema; a column that one side lacks is NULL there. Rows without a key are compared together. ``watch`` is told each round.
    """
    schema = merged(source.schema, snapshot.schema)
    source, snapshot = conformed(source, schema), conformed(snapshot, schema)
    found = differing_ranges(source, snapshot, key, **rounds)
    for r in found if watch else ():
        watch(r)
    last = found[-1]
    sides = []
    for side, df in enumerate((source, snapshot)):
        some = _within(df, key, last.ranges, last.missing_keys)
        sides.append(some.select(*_plain(some), F.lit(1 - side).alias("_s"), F.lit(side).alias("_t")))
    names = named(*schema.names)
    counted = sides[0].unionByName(sides[1]).groupBy(*names).agg(F.sum("_s").alias("in_source"), F.sum("_t").alias("in_snapshot"))
    unequal = counted.where("in_source <> in_snapshot")
    # Whether a key is on both sides is asked of all its rows, those that agree as well.
    keys = counted.groupBy(named(key)[0].alias("_key")).agg(F.sum("in_source").alias("_in"), F.sum("in_snapshot").alias("_out"))
    met = unequal.join(keys, unequal[f"`{key}`"].eqNullSafe(keys["_key"]))
    kind = (
        F.when(F.col("_out") == 0, "lost")
        .when(F.col("_in") == 0, "extra")
        .when((F.col("in_source") > 0) & (F.col("in_snapshot") > F.col("in_source")), "doubled")
        .when((F.col("in_snapshot") > 0) & (F.col("in_source") > F.col("in_snapshot")), "thinned")
        .otherwise("changed")
    )
    return met.select(kind.alias("kind"), "in_source", "in_snapshot", *names)
