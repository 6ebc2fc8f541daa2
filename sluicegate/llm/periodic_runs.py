"""Periodic runs of words: match lengths along the diagonals of a text against itself, kept for a few diagonals only."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicegate.llm.common import column, with_fields

#: Words of the first window: a run of a period up to 16 matches itself over 16 words or more.
WINDOW = 16
#: Words that are worked on at a time; a longer text is worked on by itself.
CHUNK = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(earlier: np.ndarray, later: np.ndarray) -> np.ndarray:
    """The hash of a window from those of its halves."""
    return _mixed(earlier * np.uint64(0x9E3779B97F4A7C15) + _mixed(later))


def _occurrences(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last one before it with the same hash, or -1, and whether any other has it. Places ascend."""
    order = np.argsort(hashes, kind="stable")
    again = hashes[order[1:]] == hashes[order[:-1]]
    before, several = np.full(len(places), -1, dtype=np.int64), np.zeros(len(places), dtype=bool)
    before[order[1:][again]] = places[order[:-1][again]]
    several[order[1:][again]] = several[order[:-1][again]] = True
    return before, several


def open_diagonals(words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (place of a word, lag) through which every run's diagonal passes; ``begin`` is the first place of each word's text.

    Words an earlier occurrence apart match along the diagonal of that lag. A run of period q matches over max(24 - q, 2 q)
    words or more. So of the occurrences of a word only that counts whose window of L words recurs as a whole, for L
    the power of two with L / 2 < q <= L (16 for any q below): the run holds such a window and its copy q words before,
    and none nearer, as a nearer one would give the run a smaller period. One earlier occurrence of
    each window is enough, where all occurrences of all words would be the square of a text's length.
    """
    n = len(words)
    place = np.arange(n)
    hashes = _mixed(words.astype(np.uint64) + (begin.astype(np.uint64) << np.uint64(32)) + np.uint64(1))
    size = 1
    while size < WINDOW:
        hashes = np.concatenate([hashes[:size], _doubled(hashes[:-size], hashes[size:])]) if n > size else hashes
        size *= 2
    whole = place[place - begin >= WINDOW - 1]
    if not len(whole):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    cells, lags = [], []
    at, h = whole, hashes[whole]
    while len(at):
        before, several = _occurrences(h, at)
        lag = at - before
        near = (before >= 0) & (lag <= size) & ((lag > size // 2) | (size == WINDOW))
        cells.append(at[near])
        lags.append(lag[near])
        # A window that recurs, earlier or later, has halves that do; the others need not be looked at any more.
        at, h = at[several], h[several]
        half = np.searchsorted(at, at - size)
        both = (at[half] == at - size) & (at - begin[at] >= 2 * size - 1)
        at, h, size = at[both], _doubled(h[half[both]], h[both]), 2 * size
    return np.concatenate(cells), np.concatenate(lags)


def _smallest(words: np.ndarray, start: int, length: int, period: int) -> bool:
    """Has the stretch no smaller period? One would divide ``period``, as the stretch is three times as long."""
    left, factor, primes = period, 2, []
    while factor * factor <= left:
        if left % factor == 0:
            primes.append(factor)
            while left % factor == 0:
                left //= factor
        factor += 1
    primes += [left] if left > 1 else []
    stretch = words[start : start + 2 * period]
    return not any((stretch[period // f :] == stretch[: -(period // f)]).all() for f in primes)


def find_runs(words: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """All runs (place, length, period), by place and period, of texts laid one behind the other.

    Each diagonal that was opened in a text is followed word by word: equal words lengthen its match, others end it,
    and a match that ends long enough is a run, unless the stretch has a smaller period.
    """
    cells, lags = open_diagonals(words, begin)
    first = begin[cells] if len(cells) else cells
    runs = []
    for b, lag in sorted(set(zip(first.tolist(), lags.tolist()))):
        text = words[b : end[b]]
        broken = np.flatnonzero(text[lag:] != text[:-lag])
        edges = np.concatenate([[-1], broken, [len(text) - lag]])
        matched = np.diff(edges) - 1
        for k in np.flatnonzero(matched >= max(least - lag, (times - 1) * lag)):
            start, length = int(edges[k]) + 1, int(matched[k]) + lag
            if _smallest(text, start, length, lag):
                runs.append((b + start, length, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _texts(batch: pa.RecordBatch, place: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows whose texts have some CHUNK words together, four bytes a word at a guess."""
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > begin and total + size > 4 * CHUNK:
            yield begin, row
            begin, total = row, 0
        total += size
    if len(sizes):
        yield begin, len(sizes)


def _runs(place: int, least: int, times: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in _texts(batch, place):
                yield _judged(batch.slice(low, high - low), place, least, times)

    return run


def _judged(batch: pa.RecordBatch, place: int, least: int, times: int) -> pa.RecordBatch:
    texts = batch.column(place)
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    if isinstance(split, pa.ChunkedArray):
        split = split.combine_chunks()
    values, owner = split.flatten(), pc.list_parent_indices(split)
    filled = pc.greater(pc.binary_length(values), 0)
    values, owner = values.filter(filled), owner.filter(filled).to_numpy(zero_copy_only=False)
    counts = np.bincount(owner, minlength=len(batch))
    ends = np.cumsum(counts)
    codes = pc.dictionary_encode(values).indices.to_numpy(zero_copy_only=False)
    begin = np.repeat(ends - counts, counts)
    runs = find_runs(codes, begin, np.repeat(ends, counts), least, times)

    dropped = np.zeros(len(codes) + 1, dtype=np.int64)
    found: list[list] = [[] for _ in range(len(batch))]
    for start, length, period in runs:
        found[owner[start]].append({"start": start - int(begin[start]), "length": length, "period": period})
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.cumsum(dropped)[:-1] == 0
    left = np.bincount(owner[kept], minlength=len(batch))
    offsets = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32() if left.sum() < 2**31 else pa.int64())
    lists = pa.ListArray if offsets.type == pa.int32() else pa.LargeListArray
    # Arrow joins strings of 32-bit offsets: a chunk is small unless one text is larger than that.
    joined = pc.binary_join(lists.from_arrays(offsets, values.filter(pa.array(kept))), pa.scalar(" ", pa.large_string()))
    columns = [*batch.columns[:place], pa.array(counts, pa.int64()), pa.array(found, pa.list_(RUN)), joined.cast(pa.string())]
    names = [*batch.schema.names[:place], "n_words", "runs", "collapsed"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def collapse_runs(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: int = 24, times: int = 3
) -> DataFrame:
    """The columns of ``keep`` and per row ``n_words``, ``runs`` (array of start, length, period; by start, then period) and
    ``collapsed``, the words outside the repetitions of runs, joined by one space.

    Words are what lies between spaces, tabs and line ends (0x20, 0x09 to 0x0D), numbered from 0. A run is a stretch with smallest
    period q (words q apart are identical) of ``least`` words and ``times`` periods or more that no
    neighbouring word extends; a word is dropped if any run holds it after its first q words. ``times`` is 3 or more: then
    periods of a stretch divide one another, and each run is on a diagonal that is opened (``open_diagonals``).

    Each row is judged by itself, in the task that reads it: nothing is shuffled. Whole texts are compared word by word; a
    hash only opens diagonals. Some 200 bytes a word of the longest text are held, whatever its periods.
    A NULL text counts as an empty one: no words, no runs, an empty ``collapsed``; so does one of blanks. Repeated rows and NULL keys come out
    each as they came in. An empty table gives no rows. Columns beyond ``keep`` are left out, whatever their names.
    """
    if times < 3 or least < 3 * (WINDOW // 2):
        raise ValueError("runs have three periods and 24 words or more")
    rows = docs.select(*(column(c).alias(f"_k{i}") for i, c in enumerate(keep)), column(text).alias("_text"))
    schema = with_fields(rows.drop("_text").schema, "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    found = rows.mapInArrow(_runs(len(keep), least, times), schema)
    return found.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "n_words", "runs", "collapsed")
