"""Cuts of a split column between which about as many rows lie, found by counting bins finer and finer where they are full."""

from __future__ import annotations

import os.path
import re
from collections.abc import Iterator, Sequence
from datetime import datetime

from sluicegate.plans.spec import TableSpec, check_identifier
from sluicegate.plans.strategy import Bounds, file_count, quoted
from sluicegate.sources.base import Source, count_rows

#: A full bin is cut into so many.
RADIX = 16
#: A bin is full that holds more than this part of a stride.
PART = 4
#: So many ranges or sums are asked for in one statement.
AT_ONCE = 400
# Texts that stand in a statement as they are, whatever the database makes of backslashes and other letters.
PLAIN = re.compile(r"[A-Za-z0-9 _#.@:/+=,-]*")


def equal_row_bounds(
    source: Source, spec: TableSpec, total_rows: int | None = None, since: datetime | None = None, until: datetime | None = None
) -> Bounds | None:
    """Bounds whose strides hold about equally many rows, of a whole-number or text column; None without rows to split.

    No stride holds more rows than it would on average, but for single keys that do so by themselves: these are strides of their
    own. A text column has to be ordered as its bytes are, in the database too (``_check_order``).
    """
    column = check_identifier(spec.partition_column or spec.split_key)
    rows = count_rows(source, spec, since, until) if total_rows is None else total_rows
    pieces = spec.num_partitions or max(1, file_count(rows, spec.rows_per_partition))
    low, high = source.grouped_frame(spec, None, {"lo": f"min({column})", "hi": f"max({column})"}, None, since, until).first()
    if low is None or pieces < 2 or low == high:
        return None
    if isinstance(low, str):
        bins = _text_bins(source, spec, column, pieces, low, high, since, until)
    elif isinstance(low, int) and not isinstance(low, bool):
        bins = _number_bins(source, spec, column, pieces, low, high, since, until)
    else:
        raise ValueError(f"{spec.table}: strides of equally many rows need a whole-number or text column, not {type(low).__name__}")
    cuts = _cuts(bins, pieces)
    if isinstance(low, str):
        cuts = [c for c in cuts if PLAIN.fullmatch(c)]
        _check_order(source, spec, column, cuts, since, until)
    return Bounds(0, 0, len(cuts) + 1, tuple(cuts)) if cuts else None


def _full(rows: int, total: int, pieces: int) -> bool:
    return rows * PART * pieces > total


def _number_bins(
    source: Source, spec: TableSpec, column: str, pieces: int, low: int, high: int, since: datetime | None, until: datetime | None
) -> list[tuple[int, int, bool]]:
    """Where each bin begins, its rows, and whether it is a single key; in order. Each round counts, within the full
    bins of the last one, bins of a sixteenth of the width."""
    width = 1
    while (high - low) // width >= PART * 2 * RADIX * pieces:
        width *= RADIX
    settled: list[tuple[int, int, bool]] = []
    ranges, total = [(low, high + 1)], None
    while ranges:
        found: dict[int, int] = {}
        for some in _chunks(ranges):
            where = " or ".join(f"{column} >= {a} and {column} < {b}" for a, b in some)
            group = f"floor((cast({column} as decimal(20,0)) - ({low})) / {width})"
            for place, rows in source.grouped_frame(spec, group, {"n": "count(*)"}, where, since, until).collect():
                found[int(place)] = found.get(int(place), 0) + rows
        total = sum(found.values()) if total is None else total
        ranges = []
        for place, rows in sorted(found.items()):
            begin = low + place * width
            if width > 1 and _full(rows, total, pieces):
                if ranges and ranges[-1][1] == begin:
                    ranges[-1] = (ranges[-1][0], begin + width)
                else:
                    ranges.append((begin, begin + width))
            else:
                settled.append((begin, rows, width == 1))
        width //= RADIX
    return sorted(settled)


def _text_bins(
    source: Source, spec: TableSpec, column: str, pieces: int, low: str, high: str, since: datetime | None, until: datetime | None
) -> list[tuple[str, int, bool]]:
    """The same by beginnings of the text: each round takes the full ones some letters further, past what their keys share."""
    length = len(os.path.commonprefix([low, high])) + 1
    settled: list[tuple[str, int, bool]] = []
    wheres: list[str | None] = [None]
    total = None
    while wheres:
        found = []
        for where in wheres:
            values = {"n": "count(*)", "lo": f"min({column})", "hi": f"max({column})"}
            asked = f"{column} is not null" if where is None else where
            found += source.grouped_frame(spec, f"substr({column}, 1, {length})", values, asked, since, until).collect()
        total = sum(r[1] for r in found) if total is None else total
        full = []
        for prefix, rows, first, last in found:
            if _full(rows, total, pieces) and first != last and PLAIN.fullmatch(prefix):
                full.append((prefix, len(os.path.commonprefix([first, last])) + 1))
            else:
                settled.append((prefix, rows, first == last))
        wheres = [f"substr({column}, 1, {length}) in ({', '.join(quoted(p) for p, _ in some)})" for some in _chunks(full)]
        if full:
            length = max(length + 1, min(n for _, n in full))
    return sorted(settled)


def _cuts(bins: Sequence[tuple], pieces: int) -> list:
    """Where strides begin, but for the first: before the bin that would fill the last one, and around full single keys."""
    total = sum(rows for _, rows, _ in bins)
    cuts, held = [], 0
    for begin, rows, single in bins:
        alone = single and rows * pieces > total
        if held and (alone or (held + rows) * pieces > total):
            cuts.append(begin)
            held = 0
        # Whatever comes after a full single key begins a stride.
        held = total if alone else held + rows
    return cuts


def _check_order(
    source: Source, spec: TableSpec, column: str, cuts: Sequence[str], since: datetime | None, until: datetime | None
) -> None:
    """Does the database order the cuts as they are ordered here? Fewer rows must lie above each than above the one before:
    where they do, half-open ranges between them hold every row once, in whatever order the database has."""
    above = []
    for some in _chunks(cuts):
        sums = {f"c{i}": f"sum(case when {column} >= {quoted(c)} then 1 else 0 end)" for i, c in enumerate(some)}
        above += list(source.grouped_frame(spec, None, sums, None, since, until).first())
    if any(b >= a for a, b in zip(above, above[1:])):
        raise ValueError(f"{spec.table}: {column} is not ordered by its bytes; read it by hash")


def _chunks(items: Sequence) -> Iterator[Sequence]:
    for begin in range(0, len(items), AT_ONCE):
        yield items[begin : begin + AT_ONCE]
